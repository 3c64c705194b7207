"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from riskloom.llm import decontamination, licenses, quality_rules

_SPACE = r"[\x20\x09-\x0D]"


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of shares."""
    half = "CASE WHEN {x} > 0 THEN {x} * log2({x} / ((z[1] + z[2]) / 2)) ELSE 0 END"
    both = f"({half.format(x='z[1]')} + {half.format(x='z[2]')}) / 2"
    pairs = f"list_transform(range(1, len({p}) + 1), lambda i: [{p}[i], {q}[i]])"
    return f"sqrt(greatest(0.0, list_sum(list_transform({pairs}, lambda z: {both}))))"


def _shares(counts: str) -> str:
    return f"list_transform({counts}, lambda x: CASE WHEN list_sum({counts}) > 0 THEN x / list_sum({counts}) ELSE 0.0 END)"


def quality_sql() -> str:
    q = quality_rules
    steps = []
    for k, pattern in enumerate(q._CLASSES):
        pattern = pattern.replace("'", "''")
        steps.append(f"regexp_replace({'text' if not k else f'r{k}'}, '{pattern}', '', 'g') AS r{k + 1}")
    n = len(q._CLASSES)
    layers = "SELECT *, " + steps[0] + " FROM w"
    for step in steps[1:]:
        layers = f"SELECT *, {step} FROM ({layers}) l"
    sizes = ["text"] + [f"r{k + 1}" for k in range(n)]
    counts = [f"CAST(length({a}) - length({b}) AS DOUBLE)" for a, b in zip(sizes, sizes[1:])]
    counts.append(f"CAST(length({sizes[-1]}) AS DOUBLE)")
    sums = ", ".join(f"sum(classes[{k + 1}])" for k in range(n + 1))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE[1:-1]}]')) AS lines FROM d),
c AS (SELECT rid, doc_id, lang, words, len(words) AS n_words, lines, [{', '.join(counts)}] AS classes, length(text) AS size
  FROM ({layers}) l),
grams AS (SELECT rid, k, words[k:k + 4] AS gram FROM (SELECT rid, words, unnest(range(1, n_words - 3)) AS k FROM c) g),
twice AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, gram) AS m FROM grams) g WHERE m > 1),
covered AS (SELECT rid, count(DISTINCT k + j) AS n_repeat_words FROM twice, range(0, 5) o(j) GROUP BY rid),
long AS (SELECT * FROM c WHERE n_words >= {q.MIN_WORDS}),
langs AS (SELECT lang FROM long WHERE lang IS NOT NULL GROUP BY lang ORDER BY sum(n_words) DESC, lang LIMIT {q.LANGUAGES}),
tongues AS (SELECT '=' || lang AS tongue, words, classes FROM long WHERE lang IN (SELECT lang FROM langs)
  UNION ALL SELECT '{q.ALL}', words, classes FROM long),
shapes AS (SELECT tongue, [{sums}] AS classes FROM tongues GROUP BY tongue),
counted AS (SELECT tongue, word, count(*) AS n FROM (SELECT tongue, unnest(words) AS word FROM tongues) u GROUP BY tongue, word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tongue ORDER BY n DESC, word) AS nth,
  sum(n) OVER (PARTITION BY tongue) AS total FROM counted),
tops AS (SELECT tongue, list(word ORDER BY nth) AS terms,
  list_append(list(CAST(n AS DOUBLE) ORDER BY nth), CAST(max(total) - sum(n) AS DOUBLE)) AS bins
  FROM ranked WHERE nth <= {q.TERMS} GROUP BY tongue),
refs AS (SELECT tongue, terms, {_shares('bins')} AS word_shares, {_shares('classes')} AS class_shares
  FROM tops JOIN shapes USING (tongue)),
j AS (SELECT c.*, coalesce(n_repeat_words, 0) AS n_repeat_words, r.* EXCLUDE (tongue),
  list_transform(r.terms, lambda t: CAST(len(list_filter(c.words, lambda x: x = t)) AS DOUBLE)) AS hits
  FROM c LEFT JOIN covered USING (rid)
  LEFT JOIN refs r ON r.tongue = CASE WHEN '=' || c.lang IN (SELECT tongue FROM refs) THEN '=' || c.lang ELSE '{q.ALL}' END),
k AS (SELECT *, list_append(hits, CAST(n_words AS DOUBLE) - list_sum(hits)) AS doc_bins,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM j),
m AS (SELECT *,
  CASE WHEN n_words >= {q.MIN_WORDS} THEN {_distance(_shares('classes'), 'class_shares')} END AS char_distance,
  CASE WHEN n_words >= {q.MIN_WORDS} THEN {_distance(_shares('doc_bins'), 'word_shares')} END AS word_distance FROM k)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(size - classes[2] AS BIGINT) AS word_chars,
 CAST(classes[7] AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
 CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
 NOT base_failed AND coalesce(char_distance <= {q.MAX_CHAR_DISTANCE}, true)
  AND coalesce(word_distance <= {q.MAX_WORD_DISTANCE}, true) AS kept,
 round(char_distance, 6) + 0.0 AS char_distance, round(word_distance, 6) + 0.0 AS word_distance FROM m"""


def license_sql() -> str:
    rows = []
    texts = [(label, text, True) for label, text in licenses.PHRASES]
    texts += [(label, text, False) for label, text in licenses.NOTICES]
    for no, (label, text, exact) in enumerate(texts):
        words = text.split()
        grams = len(words) - licenses.GRAM + 1
        rows += [
            f"({no}, '{label}', {str(exact).lower()}, {grams}, {k}, {words[k : k + licenses.GRAM]!r})"
            for k in range(grams)
        ]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH t(template, label, exact, grams, place, gram) AS (VALUES {', '.join(rows)}),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT rid, k - 1 AS pos, words[k:k + {licenses.GRAM - 1}] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - {licenses.GRAM - 2})) AS k FROM d) u),
votes AS (SELECT rid, template, label, exact, grams, pos - place AS diagonal, list(DISTINCT place) AS places
  FROM g JOIN t USING (gram) GROUP BY ALL),
begun AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o > CASE WHEN exact THEN 0 ELSE {licenses.NEIGHBOUR} END
   OR lag(diagonal) OVER o IS NULL THEN 1 ELSE 0 END AS begins
  FROM votes WINDOW o AS (PARTITION BY rid, template ORDER BY diagonal)),
spans AS (SELECT *, sum(begins) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM begun),
found AS (SELECT rid, label, exact, min(diagonal) AS first, len(list_distinct(flatten(list(places)))) / grams AS share
  FROM spans GROUP BY rid, template, label, exact, grams, span),
kept AS (SELECT * FROM found WHERE CASE WHEN exact THEN share = 1 ELSE share >= {licenses.LEAST} END),
by_text AS (SELECT rid, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word,
  max(first) FILTER (exact) AS last_word, list_sort(list(DISTINCT label) FILTER (exact)) AS base,
  list_sort(list(DISTINCT label)) AS every, max(share) AS score FROM kept GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
 CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
 coalesce(array_to_string(base, ','), '') AS base_labels, coalesce(array_to_string(every, ','), '') AS labels,
 coalesce(score, 0.0) AS score FROM d LEFT JOIN by_text USING (rid)"""


def leak_sql() -> str:
    """Windows and items that reach the similarity, found without fingerprints."""
    d = decontamination
    split = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH items AS (SELECT DISTINCT item_id, words, len(words) AS item_words, least({d.SHINGLE}, len(words)) AS width,
  len(words) - least({d.SHINGLE}, len(words)) + 1 AS places FROM (SELECT item_id, {split} AS words FROM benchmark) b
  WHERE len(words) > 0),
held AS (SELECT row_number() OVER () AS no, * FROM items),
item_grams AS (SELECT no, width, places, words[k:k + width - 1] AS gram, count(*) AS n
  FROM (SELECT *, unnest(range(1, places + 1)) AS k FROM held) h GROUP BY no, width, places, gram),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {split} AS words FROM documents),
grams AS (SELECT rid, width, k - 1 AS pos, words[k:k + width - 1] AS gram FROM (
  SELECT rid, words, width, unnest(range(1, len(words) - width + 2)) AS k
  FROM docs, (SELECT DISTINCT width FROM held) w) u),
hits AS (SELECT DISTINCT rid, no, places, pos FROM grams JOIN item_grams USING (width, gram)),
starts AS (SELECT a.rid, a.no, a.pos AS start FROM hits a JOIN hits b ON a.rid = b.rid AND a.no = b.no
  AND b.pos BETWEEN a.pos AND a.pos + a.places - 1
  GROUP BY a.rid, a.no, a.pos, a.places HAVING count(*) >= ceil({d.LEAST} * a.places)),
counted AS (SELECT s.rid, s.no, s.start, g.gram, count(*) AS n FROM starts s JOIN held h USING (no)
  JOIN grams g ON g.rid = s.rid AND g.width = h.width AND g.pos BETWEEN s.start AND s.start + h.places - 1
  GROUP BY s.rid, s.no, s.start, g.gram),
sums AS (SELECT c.rid, c.no, c.start, sum(c.n) AS own, sum(least(c.n, coalesce(i.n, 0))) AS common
  FROM counted c LEFT JOIN item_grams i ON i.no = c.no AND i.gram = c.gram GROUP BY c.rid, c.no, c.start),
scored AS (SELECT rid, no, start, common / (own + places - common) AS similarity FROM sums JOIN held USING (no)),
best AS (SELECT *, row_number() OVER (PARTITION BY rid, no ORDER BY similarity DESC, start) AS nth FROM scored
  WHERE similarity >= {d.LEAST})
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start_word, CAST(item_words AS BIGINT) AS item_words, similarity
FROM best JOIN docs USING (rid) JOIN held USING (no) WHERE nth = 1"""


def search_sql() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH asked AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({lower}, '{term}') AS words FROM benchmark),
times AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(words) AS term FROM asked) u GROUP BY q, term),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({lower}, '{term}') AS words FROM documents),
sized AS (SELECT rid, doc_id, len(words) AS n FROM d WHERE len(words) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
post AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(words) AS term FROM d) u
  WHERE term IN (SELECT term FROM times) GROUP BY rid, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM post GROUP BY term) g, totals),
parts AS (SELECT rid, doc_id, term,
  w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))) AS part
  FROM post JOIN sized USING (rid) JOIN weights USING (term), totals),
scored AS (SELECT q, rid, doc_id, CAST(sum(times * part) AS BIGINT) AS score
  FROM times JOIN parts USING (term) GROUP BY q, rid, doc_id HAVING sum(times * part) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN asked USING (q) WHERE rank <= 20
"""


def negatives_sql() -> str:
    return """
WITH e AS (SELECT row_number() OVER () AS rid, vec_id,
  CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label, embedding
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT rid, vec_id, label, unnest(range(1, len(embedding) + 1)) AS d,
  unnest(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM e),
products AS (SELECT a.rid AS a, c.rid AS c, CAST(sum(a.v * c.v) AS BIGINT) AS score
  FROM parts a JOIN parts c USING (d) WHERE a.vec_id % 100 = 0 AND a.rid <> c.rid GROUP BY a.rid, c.rid),
scored AS (SELECT a, c, score, o.vec_id AS anchor_id, r.vec_id AS other_id, o.label = r.label AS same
  FROM products JOIN e o ON o.rid = a JOIN e r ON r.rid = c),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id NULLS LAST) AS nth
  FROM scored WHERE same) s WHERE nth <= 5),
pairs AS (SELECT p.a, p.nth, p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
  p.score AS positive_score, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.a, p.nth ORDER BY n.score DESC, n.other_id NULLS LAST) AS rank
  FROM near p JOIN scored n ON p.a = n.a AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM pairs WHERE rank <= 10
"""
