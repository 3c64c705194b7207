from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from riskloom.llm import lexical, oracles
from tests.llm.cases import awkward, corpus, prose, row, table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, rank string, key string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs, items, k=20):
    """Every document scored for every item, one term after the other."""
    held = [(r[0], Counter(words(r[1]))) for r in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text, *_ in items:
        scores = []
        for d, c, n in held:
            m = 75 + (25 * n * n_docs) // n_terms
            score = 0
            for t in words(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scores)[:k]):
            out.append((item_id, rank + 1, None if none else d, -score))
    return sorted(map(repr, out))


def items_of(docs, seed=2):
    rng = random.Random(seed)
    items = []
    for i in range(25):
        text = rng.choice(docs)[1] or ""
        part = text.split()[: rng.randrange(1, 40)]
        items.append((i, " ".join(part + part[:3]), "r", "k"))
    items += [(3, "the of and", "r", "k"), (3, "the of and", "r", "k"), (None, "Der die, DAS!", "r", "k")]
    return items + [(90, None, "r", "k"), (91, "", None, None), (92, "qqq zzz", "r", "k"), (93, "x" * 5000, "r", "k")]


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("postings, documents", [(1_000_000, 65_536), (200, 65_536), (1_000_000, 7)])
def test_against_plain_scores(spark, monkeypatch, postings, documents):
    monkeypatch.setattr(lexical, "POSTINGS", postings)
    monkeypatch.setattr(lexical, "DOCUMENTS", documents)
    docs = awkward() + corpus(n=150) + [row(5000 + i, "the of and to in") for i in range(40)]
    items = items_of(docs)
    got = lexical.search(table(spark, docs), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == plain(docs, items)


def test_items_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 6)
    docs = corpus(n=60)
    items = items_of(docs, 4)
    got = lexical.search(table(spark, docs), spark.createDataFrame(items, ITEMS), k=3)
    assert rows_of(got) == plain(docs, items, 3)


def test_empty_tables(spark):
    docs, items = table(spark, corpus(n=8)), spark.createDataFrame([(1, "the", "r", "k")], ITEMS)
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []


def test_against_sql(spark):
    docs, items = awkward() + corpus(n=80), items_of(corpus(n=80))
    con = duckdb.connect()
    con.register("documents", table(spark, docs).toPandas())
    con.register("benchmark", spark.createDataFrame(items, ITEMS).toPandas())
    con.execute("CREATE TABLE d AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM documents")
    con.unregister("documents")
    con.execute("ALTER TABLE d RENAME TO documents")
    want = con.execute(oracles.search_sql()).fetchall()
    got = lexical.search(table(spark, docs), spark.createDataFrame(items, ITEMS)).collect()
    key = lambda r: (-1 if r[0] is None or r[0] != r[0] else int(r[0]), r[1], r[2] is None, r[2] or 0, r[3])
    assert sorted(map(key, want)) == sorted(map(key, got))


def block_of(rng, n_docs, n_terms):
    """An index block of random postings in which every two terms have a joint list."""
    weight = np.array([rng.randrange(0, 3000) for _ in range(n_terms)], np.int64)
    postings = [np.array(sorted(rng.sample(range(n_docs), rng.randrange(1, n_docs))), "<u2") for _ in weight]
    parts = [np.array([rng.randrange(1, 900_000) for _ in p], "<i4") for p in postings]
    pairs = [(a, b) for a in range(n_terms) for b in range(a + 1, n_terms)]
    both, joint = [], []
    for a, b in pairs:
        shared, i, j = np.intersect1d(postings[a], postings[b], return_indices=True)
        both.append(shared)
        sums = parts[a][i].astype(np.int64) * weight[a] + parts[b][j].astype(np.int64) * weight[b]
        joint.append(int(sums.max()) if len(sums) else 0)
    packed = {
        "docs": list(range(n_docs)), "terms": np.arange(n_terms, dtype="<i4").tobytes(),
        "ends": np.cumsum([len(p) for p in postings]).astype("<i8").tobytes(),
        "places": np.concatenate(postings).tobytes(), "parts": np.concatenate(parts).tobytes(),
        "pair": np.arange(len(pairs), dtype="<i4").tobytes(), "joint": np.array(joint, "<i8").tobytes(),
        "both_ends": np.cumsum([len(b) for b in both]).astype("<i8").tobytes(),
        "both": np.concatenate(both).astype("<u2").tobytes(),
    }
    return lexical._IndexBlock(packed, weight, pairs), postings, parts, weight


def test_bounds_skip_nothing_and_pairs_tighten_them():
    rng = random.Random(9)
    tighter = 0
    for _ in range(60):
        block, postings, parts, weight = block_of(rng, 60, 6)
        terms = [(t, rng.randrange(1, 4)) for t in rng.sample(range(6), 4)]
        scores = np.zeros(60, np.int64)
        for t, n in terms:
            scores[postings[t]] += n * weight[t] * parts[t].astype(np.int64)
        groups = lexical._groups(block, terms)
        alone = sum(n * block.largest[t] for t, n in terms)
        bound = sum(g.bound for g in groups)
        assert scores.max() <= bound <= alone
        tighter += bound < alone
        for least in [0, *rng.sample(scores.tolist(), 5), int(scores.max()), int(scores.max()) + 1]:
            places, got = block.best(terms, least)
            want = np.flatnonzero(scores >= max(least, 1))
            assert places.tolist() == want.tolist() and got.tolist() == scores[want].tolist()
    assert tighter > 30
