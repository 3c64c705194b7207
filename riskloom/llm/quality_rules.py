"""Quality rules by distribution divergence, in DataFrame functions only.

Each document gets two histograms: shares of character classes, and shares of its language's
commonest words (with one bin for all others). Both are compared to the language's reference, taken
over all its documents, by Jensen-Shannon distance (base 2, from 0 to 1). Documents shorter than
``min_words`` are left to the plain rules, since short histograms diverge by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, stored, table

#: Commonest words of a language that make its histogram; all others share one bin.
TERMS = 24
SHARES = 32
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.50
#: References kept: the languages with most documents; others are held against all texts together.
LANGUAGES = 200
ALL = "(all)"

# Character classes, removed from a text one after the other; what is left is a class.
_CLASSES = [
    "[a-z]+", f"{SPACE}+", "[A-Z]+", r"\p{L}+", "[0-9]+", r"[.,;:!?'\"()\-]+", r"[#*$%&|<>]+",
]


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with ``words`` and the plain measures of column ``text`` (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("text", text).withColumn(
        "words", F.array_remove(F.split("text", f"{SPACE}+"), "")
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    df = df.withColumn("n_words", F.size("words").cast("long")).withColumn("lines", lines)
    df = df.withColumn(
        "windows",
        F.when(
            F.size("words") >= 5,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - 4),
                lambda k: F.xxhash64(F.slice("words", k, 5)),
            ),
        ),
    )
    df = df.withColumn(
        "ranked",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(
                F.transform("windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))
            ),
        ),
    )
    h = lambda k: F.get(F.col("ranked"), k)["h"]
    twice = F.transform(
        "ranked",
        lambda s, k: F.when(
            F.coalesce(h(k - 1) == s["h"], F.lit(False)) | F.coalesce(h(k + 1) == s["h"], F.lit(False)),
            s["k"],
        ),
    )
    df = df.withColumn("twice", F.array_sort(F.filter(twice, lambda k: k.isNotNull())))
    covered = F.aggregate(
        F.transform("twice", lambda p, k: F.least(F.lit(5), F.get(F.col("twice"), k + 1) - p)),
        F.lit(0),
        lambda total, step: total + step,
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    return df.drop("lines", "windows", "ranked", "twice")


def with_classes(df: DataFrame) -> DataFrame:
    """Add ``classes``: characters of each class, and the contract's ``word_chars`` and ``n_symbols``."""
    df = df.withColumn("_r0", F.coalesce(F.col("text"), F.lit("")))
    for k, pattern in enumerate(_CLASSES):
        df = df.withColumn(f"_r{k + 1}", F.regexp_replace(f"_r{k}", pattern, ""))
    size = [F.length(f"_r{k}") for k in range(len(_CLASSES) + 1)]
    counts = [a - b for a, b in zip(size, size[1:])] + [size[-1]]
    df = df.withColumn("classes", F.array(*[c.cast("double") for c in counts]))
    df = df.withColumn("word_chars", (size[0] - counts[1]).cast("long"))
    df = df.withColumn("n_symbols", counts[6].cast("long"))
    return df.drop(*[f"_r{k}" for k in range(len(_CLASSES) + 1)])


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def common_words(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``tongue, terms, word_shares`` of each language and of all texts, at most ``LANGUAGES`` + 1 rows.

    All documents of at least ``min_words`` words count. Equal counts order by word or language.
    """
    split = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), f"{SPACE}+"), "")
    words = stored(
        docs.select("lang", split.alias("words"))
        .where(F.size("words") >= min_words)
        .select("lang", F.explode("words").alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    most = words.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    most = most.orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    own = words.join(F.broadcast(most), "lang", "left_semi").select(
        F.concat(F.lit("="), F.col("lang")).alias("tongue"), "word", "n"
    )
    pooled = words.groupBy("word").agg(F.sum("n").alias("n"))
    every = own.union(pooled.select(F.lit(ALL).alias("tongue"), "word", "n"))
    # the best of each hash share first, so that a language's last ranking has SHARES * TERMS rows,
    # however many tasks there were; bounded row numbers also cut each task before the shuffle
    share = F.pmod(F.xxhash64("word"), F.lit(SHARES))
    order = [F.desc("n"), "word"]
    within = F.row_number().over(Window.partitionBy("tongue", "share").orderBy(*order))
    top = every.withColumn("share", share).withColumn("nth", within).where(F.col("nth") <= TERMS)
    overall = F.row_number().over(Window.partitionBy("tongue").orderBy(*order))
    top = top.withColumn("nth", overall).where(F.col("nth") <= TERMS)
    total = every.groupBy("tongue").agg(F.sum("n").alias("total"))
    listed = top.groupBy("tongue").agg(
        F.array_sort(F.collect_list(F.struct("nth", "word", "n"))).alias("top")
    )
    inside = F.aggregate("top.n", F.lit(0).cast("long"), lambda a, n: a + n)
    rest = F.array((F.col("total") - inside).cast("double"))
    return listed.join(total, "tongue").select(
        "tongue",
        F.col("top.word").alias("terms"),
        _shares(F.concat(F.transform("top.n", lambda n: n.cast("double")), rest)).alias("word_shares"),
    )


def judge(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_char: float = MAX_CHAR_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """One row per document with its measures, both distances and ``kept``.

    Null and empty texts have no words and fail the plain rules. A null or rare ``lang`` is held
    against all texts together. Distances are null under ``min_words`` or where no document reaches
    it. Equal five-word windows are recognised by 64-bit hashes. Repeated rows are kept; columns
    other than ``doc_id``, ``text`` and ``lang`` are not read.
    """
    docs = docs.select("doc_id", "text", "lang")
    held = common_words(docs, min_words).collect()
    known = [r.tongue for r in held]
    own = F.concat(F.lit("="), F.col("lang"))
    own = F.when(own.isin(known), own).otherwise(F.lit(ALL))
    words = F.broadcast(
        docs.sparkSession.createDataFrame(
            held, "tongue string, terms array<string>, word_shares array<double>"
        )
    )
    every_term = sorted({w for r in held for w in r.terms})
    long_enough = F.col("n_words") >= min_words
    df = with_classes(with_measures(docs)).withColumn("tongue", own).join(words, "tongue", "left")
    common = F.filter("words", lambda w: w.isin(every_term) if every_term else F.lit(False))
    df = df.withColumn("common", F.when(long_enough, common))
    times = F.transform(
        "terms",
        lambda t: (F.size("common") - F.size(F.array_remove(F.col("common"), t))).cast("double"),
    )
    df = df.withColumn("times", F.when(long_enough, times))
    # one pass over the texts: what follows reads numbers only
    df = stored(
        df.select(
            "doc_id", "tongue", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "classes", "times", "word_shares",
        )
    )
    sums = [F.sum(F.get("classes", F.lit(k))).alias(f"c{k}") for k in range(len(_CLASSES) + 1)]
    counted = F.array(*[f"c{k}" for k in range(len(_CLASSES) + 1)])
    by_tongue = stored(df.where(long_enough).groupBy("tongue").agg(*sums).select("tongue", counted.alias("sums")))
    shapes = by_tongue.where(F.col("tongue") != ALL).union(
        by_tongue.select(F.lit(ALL), F.posexplode("sums").alias("k", "c"))
        .groupBy("k")
        .agg(F.sum("c").alias("c"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda e: e["c"]))
        .select(F.lit(ALL), "*")
    )
    df = df.join(F.broadcast(shapes), "tongue", "left")
    rest = F.col("n_words") - F.aggregate("times", F.lit(0.0), lambda a, x: a + x)
    bins = F.concat("times", F.array(rest))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    df = df.withColumn(
        "char_distance",
        F.when(long_enough, divergence(_shares(F.col("classes")), _shares(F.col("sums")))),
    ).withColumn(
        "word_distance", F.when(long_enough, divergence(_shares(bins), F.col("word_shares")))
    )
    close = F.coalesce(F.col("char_distance") <= max_char, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= max_word, F.lit(True)
    )
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & close).alias("kept"),
        "char_distance", "word_distance",
    )


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) + 0.0 for c in ("char_distance", "word_distance")})
