from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import simhash
from riskloom.llm.common import encoded
from tests.llm.cases import awkward, corpus, row, table


def plain_fingerprint(text, words=4):
    w = encoded(text).split()
    runs = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(codes, radius):
    parent = {c: c for c in codes}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    codes = sorted(parent)
    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def clustered_codes(rng, n):
    """Random codes, chains of near ones, and a dense ball."""
    codes = {rng.getrandbits(64) for _ in range(n)} | {0, 1, (1 << 64) - 1}
    for centre in rng.sample(sorted(codes), 8):
        at = centre
        for _ in range(12):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6)))
            codes.add(at)
    ball = rng.getrandbits(64)
    codes |= {ball ^ rng.getrandbits(9) << 20 for _ in range(150)}
    return sorted(codes)


def test_fingerprints():
    for r in awkward() + corpus(n=10):
        if r[1] is None or len(r[1]) < 10_000:
            assert simhash.fingerprint(r[1]) == plain_fingerprint(r[1])


def test_gray_neighbours_differ_in_one_bit():
    codes = np.array([k ^ k >> 1 for k in range(1000)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(1000))


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_all_near_codes(seed):
    rng = random.Random(seed)
    codes = clustered_codes(rng, 200 * seed + 10)
    tree = simhash.GrayTree(np.array(codes, np.uint64))
    who, near = tree.near(0, len(codes), 4)
    got = set(zip(who.tolist(), near.tolist()))
    held = tree.codes.tolist()
    want = {
        (i, j) for i, a in enumerate(held) for j, b in enumerate(held) if (a ^ b).bit_count() <= 4
    }
    assert got == want


@pytest.mark.parametrize("group", [4096, 5])
def test_components_match_brute_force_however_groups_are_divided(spark, group):
    codes = clustered_codes(random.Random(9), 300)
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    links = simhash.star_links(spark.createDataFrame(signed, "code long"), 4, group)
    got = {c: c for (c,) in signed}
    got.update({r.u: r.v for r in simhash.component_roots(links).collect()})
    want = plain_roots(codes, 4)
    groups = lambda pairs: {frozenset(v) for v in pairs.values()}
    mine, plain = {}, {}
    for c, (s,) in zip(codes, signed):
        mine.setdefault(got[s], set()).add(c)
        plain.setdefault(want[c], set()).add(c)
    assert groups(mine) == groups(plain)


def near_copies():
    docs = corpus(n=40)
    text = " ".join(d[1] for d in docs[:6])
    docs += [row(1, text), row(500, text), row(501, text), row(2, text + " tail")]
    docs += [row(600 + i, text.replace("the", f"the w{i}", 1)) for i in range(5)]
    return docs


def test_documents_get_their_smallest_linked_id(spark):
    docs = near_copies() + [r for r in awkward() if r[0] not in (1, 2)]
    got = simhash.near_duplicates(table(spark, docs)).collect()
    assert len(got) == len(docs)
    codes = {d: plain_fingerprint(d) for d in {r[1] for r in docs}}
    roots = plain_roots(codes.values(), 4)
    smallest = {}
    for r in docs:
        if r[0] is not None:
            root = roots[codes[r[1]]]
            smallest[root] = min(smallest.get(root, r[0]), r[0])
    want = sorted((r[0] or -1, smallest.get(roots[codes[r[1]]], -1)) for r in docs)
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == want


def test_one_document_of_each_component_stays_with_all_columns(spark):
    docs = table(spark, near_copies() + [r for r in awkward() if r[0] not in (1, 2)])
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    found = simhash.near_duplicates(docs)
    assert len(rows) == found.select("component_id", F.when(F.col("component_id").isNull(), F.col("code"))).distinct().count()
    ids = [r.doc_id for r in rows]
    assert 1 in ids and 500 not in ids and len(ids) == len(set(ids))


def test_empty_table(spark):
    assert simhash.near_duplicates(table(spark, [])).collect() == []
    assert simhash.without_near_duplicates(table(spark, [])).collect() == []
