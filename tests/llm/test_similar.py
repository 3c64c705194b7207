"""The pipeline's near-duplicate stage against the similarity of all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import similar, simhash
from tests.llm.cases import awkward, prose, row, table


def runs(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def edited():
    rng = random.Random(3)
    out = []
    for i in range(40):
        words = [f"{w}{rng.randrange(50)}" for w in prose(rng, "en", 150).split()]
        out.append(row(1000 + i, " ".join(words)))
        for k in range(rng.randrange(1, 6)):
            words[20 * k + rng.randrange(15)] = f"other{k}"
        out.append(row(2000 + i, " ".join(words)))
    return out


@pytest.mark.parametrize("group", [4096, 1])
def test_stage_drops_all_pairs_at_the_similarity(spark, monkeypatch, group):
    monkeypatch.setattr(similar, "GROUP", group)
    docs = edited()
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, table(spark, docs), "").collect()}
    text = {d[0]: runs(d[1]) for d in docs}
    near = [len(text[1000 + i] & text[2000 + i]) / len(text[1000 + i] | text[2000 + i]) for i in range(40)]
    assert kept == {1000 + i for i in range(40)} | {2000 + i for i in range(40) if near[i] < 0.8}
    assert 5 < sum(s >= 0.8 for s in near) < 35


def test_rows_and_columns(spark):
    docs = table(spark, awkward() + [row(1, "one two three four five six"), row(2, "ONE two  three four five six")])
    kept = similar.without_similar(docs)
    assert kept.columns == docs.columns
    rows = [r for r in kept.collect() if (r.text or "").lower().startswith("one two")]
    assert [r.doc_id for r in rows] == [1]
    assert similar.without_similar(table(spark, [])).collect() == []


def families(seed):
    """Variants of a few texts at similarities on both sides of the bound, in chains, and a very long pair."""
    rng = random.Random(seed)
    out, at = [], 3000
    for _ in range(4):
        base = [f"{w}{rng.randrange(60)}" for w in prose(rng, "en", 120).split()]
        for _ in range(18):
            words = list(rng.choice([base, base, out[-1][1].split() if out else base]))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            out.append(row(at, " ".join(words)))
            at += 1
    long = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    for k in (0, 300, 900, 6000):
        words = list(long)
        for p in rng.sample(range(len(words)), k):
            words[p] = "x"
        out.append(row(at, " ".join(words)))
        at += 1
    return out


@pytest.mark.parametrize("group", [4096, 7])
def test_stage_against_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(similar, "GROUP", group)
    docs = families(5)
    sets = {d[0]: runs(d[1]) for d in docs}
    root = {d[0]: d[0] for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {r.doc_id for r in similar.without_similar(table(spark, docs)).collect()}
    assert kept == {find(x) for x in root} and 10 < len(kept) < len(root) - 10


def test_unlike_components_of_one_group_are_compared():
    """Links from nearest members alone would miss two components that meet elsewhere."""
    codes = [1, 2, 3, 4]
    sketches = similar.np.zeros((4, 160), similar.np.uint8)
    sketches[2:, :30] = 1
    sets = [similar.np.arange(100, dtype=similar.np.uint64)] * 2 + [similar.np.arange(5, 105, dtype=similar.np.uint64)] * 2
    roots = similar.np.array([1, 1, 3, 3])
    assert similar.unsettled(codes, sketches, roots, 0.8) == codes
    assert similar.unsettled(codes, sketches, similar.np.array([1, 1, 1, 1]), 0.8) == []
    links = dict(similar.group_links(codes, sketches, sets, 0.8, roots))
    assert links == {2: 1, 3: 1, 4: 1}


def test_fingerprints_propose_as_op10_links_them(spark, monkeypatch):
    """The stage goes through op10's index; its proposals join what its components join."""
    texts = [" ".join(f"w{(k * 7 + j) % 400}" for j in range(60)) for k in range(12)]
    texts += [f"{t} {t}" for t in texts[:6]] + [t + " end" for t in texts[:6]]
    rows = spark.createDataFrame(list(enumerate(texts)), "code long, text string")
    links = similar.fingerprint_links(rows, 5).collect()
    root = {r.u: r.v for r in simhash.component_roots(spark.createDataFrame(links, "u long, v long")).collect()}
    want = simhash.near_duplicates(rows.select(F.col("code").alias("doc_id"), "text"), words=5).collect()
    assert links and {r.doc_id: r.component_id for r in want} == {k: root.get(k, k) for k in range(len(texts))}
    asked = []
    monkeypatch.setattr(similar, "star_links", lambda codes: asked.append(codes.count()) or simhash.star_links(codes))
    similar.similar_links(rows, 5, 0.8).collect()
    assert asked == [len({r.code for r in want})]


def test_no_text_is_written_or_shuffled_where_few_rows_go(spark, monkeypatch):
    """Hand-over tables hold sketches and shingles of proposed texts, and their size does not follow the texts'."""
    rng, kinds = random.Random(9), []
    write = similar.stored
    monkeypatch.setattr(similar, "stored", lambda df: kinds.append(df.dtypes) or write(df))
    docs = [row(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))) for k in range(60)]
    kept = similar.without_similar(table(spark, docs + [row(90, docs[3][1])]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    assert kinds and not any("text" in dict(kind) for kind in kinds)
    assert "SortMergeJoin" not in plan


def test_groups_propose_all_pairs_or_are_named():
    """Sparse groups give every pair that may be similar, dense ones are named; random members give nothing."""
    rng = similar.np.random.default_rng(4)
    unlike = rng.integers(0, 256, (300, 20), similar.np.uint8)
    unlike[70] = unlike[3]
    alike = similar.np.repeat(unlike[:1], 9, axis=0)
    bits = similar.np.concatenate([unlike, unlike[[5, 5]], unlike[5:8], alike])
    rows = similar.pd.DataFrame({
        "g": [1] * 300 + [2] * 2 + [3] * 3 + [4] * 9, "a": 0, "b": 0,
        "code": range(len(bits)), "sketch": [b.tobytes() for b in bits],
    })
    found = similar.group_proposals(rows, 0.8)
    links = found[~found["dense"]]
    assert sorted(zip(links["u"], links["v"])) == [(3, 70), (300, 301)]
    assert found[found["dense"]]["g"].tolist() == [4]
