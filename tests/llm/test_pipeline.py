"""The pipeline against plain versions of what each stage must do, and the registry around it."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from riskloom.llm import packing, queries
from riskloom.llm.common import drop_stored, encoded
from tests.llm.cases import awkward, corpus, prose, row, table
from tests.llm.test_decontamination import plain_leaks

INSULT = "zorgle"


def roots_by_shingles(texts):
    """Components of texts that share four fifths of their five-word shingles, all pairs looked at."""
    sets = {}
    for t in texts:
        w = encoded(t).split()
        sets[t] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {()}
    root = {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    listed = sorted(sets)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return {t: find(t) for t in sets}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus with toxic, leaking and copied documents, in the layout of the given tables."""
    rng = random.Random(31)
    at = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus(n=300), []
    for i in range(500):
        bad = i % 3 == 0
        words = prose(rng, ["en", "fr"][i % 2], rng.randrange(15, 60)).split()
        if bad:
            words.insert(rng.randrange(len(words)), INSULT)
        docs.append(row(2000 + i, " ".join(words), ["en", "fr"][i % 2]))
        labels.append((2000 + i, 1, int(bad)))
    items = [(i, " ".join(d[1].split()[:30])) for i, d in enumerate(corpus(seed=91, n=6))]
    docs += [row(4000 + i, f"{prose(rng, 'en', 40)} {text} {prose(rng, 'en', 40)}") for i, text in items]
    docs += [row(5000 + i, docs[i][1], docs[i][2]) for i in range(30)]
    docs += awkward()
    table(spark, docs).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, docs, items


def test_stages_keep_what_they_must(spark, folder):
    at, rows, items = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, at)
        if k == len(corpus_pipeline.STAGES) - 1:
            break
        assert out.columns == columns
        path = f"{at}/stage-{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        before, kept = kept, [(r.doc_id, r.text) for r in docs.collect()]
        assert not Counter(kept) - Counter(before)
        gone = list((Counter(before) - Counter(kept)).elements())
        if name == "language_id":
            assert all(not any(c.isalpha() for c in t or "") for _, t in gone) and len(gone) == 5
        elif name == "toxicity":
            clean = [t for _, t in gone if INSULT not in (t or "")]
            left = [t for _, t in kept if INSULT in (t or "")]
            assert len(clean) <= 0.02 * len(before) and len(left) <= 5
        elif name == "near_duplicates":
            roots = roots_by_shingles({t for _, t in before})
            best = {}
            for doc_id, t in before:
                best.setdefault(roots[t], []).append((doc_id is None, doc_id or 0))
            assert sorted((d is None, d or 0) for d, _ in kept) == sorted(min(v) for v in best.values())
        else:
            leaking = {d for d, _ in plain_leaks([(d, t) for d, t in before if len(t) < 50_000], items)}
            assert {d for d, _ in gone} == leaking and len(leaking) >= 5
    packed = out.collect()
    encode = packing.WordEncoder(packing.public_tokenizers.path(packing.VOCABULARY)).ids
    assert sum(r.length for r in packed) == sum(len(encode(t)) // 4 + 1 for _, t in kept)
    assert {r.doc_id for r in packed} == {d for d, _ in kept}


def test_run_applies_all_stages(spark, folder):
    at, rows, _ = folder
    packed = corpus_pipeline.run(spark, at).collect()
    ids = {r.doc_id for r in packed}
    assert 1000 in ids and not {5000, 5001, 4000, 1, 2, 3, 6} & ids
    drop_stored(spark)


def test_all_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES if q != "pipeline"}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
