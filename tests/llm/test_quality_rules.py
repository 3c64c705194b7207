from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from riskloom.llm import quality_rules as q
from tests.llm.cases import awkward, corpus, row, table

SPACE = r"[\x20\x09-\x0D]"


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    counts = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if counts[x] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w),
    )


def distance(p, q_):
    total = 0.0
    for x, y in zip(p, q_):
        m = (x + y) / 2
        total += sum(v * math.log2(v / m) / 2 for v in (x, y) if v > 0)
    return math.sqrt(max(0.0, total))


@pytest.fixture(scope="module")
def docs():
    out = awkward() + corpus(n=80)
    out += [
        row(30, "### " + " ".join(f"{w}%%%" for w in corpus(n=1)[0][1].split() * 3)),
        row(31, "a line of words\n" * 9), row(32, corpus(seed=5, n=1)[0][1].upper() + " X" * 40),
        row(33, "one two three four five six seven eight nine ten one two three four five"),
    ]
    return out


def test_plain_rules_match_brute_force(spark, docs):
    got = q.judge(table(spark, docs)).collect()
    mine = sorted(
        (r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in got
    )
    assert mine == sorted((d[0] or -1, *plain(d[1])) for d in docs)


def test_distances_match_brute_force(spark, docs):
    got = {r.doc_id: r for r in q.judge(table(spark, docs)).collect()}
    long = [(d, re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in docs]
    long = [(d, w) for d, w in long if len(w) >= q.MIN_WORDS]
    total = Counter()
    by_lang: dict = {}
    for d, w in long:
        by_lang.setdefault(d[2], Counter()).update(w)
        total.update(w)
    for d, w in long:
        counts = by_lang[d[2]]
        top = [x for x, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[: q.TERMS]]
        share = lambda c: [c[x] / sum(c.values()) for x in top] + [1 - sum(c[x] for x in top) / sum(c.values())]
        assert got[d[0]].word_distance == pytest.approx(distance(share(Counter(w)), share(counts)), abs=1e-6)
    short = [d for d in docs if d[0] is not None and len((d[1] or "").split()) < 10]
    assert all(got[d[0]].word_distance is None and got[d[0]].char_distance is None for d in short)


def test_clean_prose_stays_and_odd_text_goes(spark, docs):
    got = {r.doc_id: r for r in q.judge(table(spark, docs)).collect()}
    clean = [d[0] for d in corpus(n=80)]
    assert sum(got[k].kept for k in clean) >= 0.98 * len(clean)
    assert not got[30].kept and not got[31].kept and not got[32].kept and not got[33].kept


def test_divergence_is_zero_to_one(spark):
    rows = [([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.2, 0.8], [0.6, 0.4])]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>")
    got = [r[0] for r in df.select(q.divergence(df.p, df.q)).collect()]
    assert got == pytest.approx([1.0, 0.0, distance(*rows[2])])


def test_empty_table(spark):
    assert q.judge(table(spark, [])).collect() == []
