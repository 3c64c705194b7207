from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from riskloom.llm import decontamination as d
from tests.llm.cases import awkward, corpus, row, table


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def runs(w, width):
    return [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]


def plain_leaks(docs, items):
    """All windows of all documents against all items."""
    out = {}
    for doc in docs:
        w = words(doc[1])
        for no, text in items:
            q = words(text)
            if not q:
                continue
            width = min(5, len(q))
            want = Counter(runs(q, width))
            have = runs(w, width)
            for start in range(len(have)):
                got = Counter(have[start : start + sum(want.values())])
                both = sum((want & got).values())
                value = both / sum((want | got).values())
                if value >= 0.8:
                    out[doc[0], no] = max(out.get((doc[0], no), 0), value)
    return out


@pytest.fixture(scope="module")
def bench():
    rng = random.Random(8)
    texts = [d[1] for d in corpus(seed=77, n=12)]
    items = [(i, " ".join(t.split()[: rng.randrange(15, 50)])) for i, t in enumerate(texts)]
    return items + [(50, "only three words"), (51, "again " * 20), (52, ""), (53, None), (None, texts[0])]


@pytest.fixture(scope="module")
def docs(bench):
    rng = random.Random(4)
    out = corpus(n=40)
    for k, (no, text) in enumerate(bench[:12]):
        w = text.split()
        filler = corpus(seed=100 + k, n=1)[0][1]
        loud = text if "ß" in text else text.upper()
        out.append(row(310 + k, f"{filler} {loud} {filler}"))
        out.append(row(340 + k, f"{filler}, {' - '.join(w[:-2])} changed end"))
        w[rng.randrange(len(w))] = "changed"
        out.append(row(370 + k, f"{' '.join(w)} {filler}"))
        out.append(row(400 + k, " ".join(text.split()[: len(w) // 2])))
    out += [row(200, "here are only three words"), row(201, "again " * 50), row(202, bench[0][1])]
    out += [row(202, bench[0][1])]
    return out


def test_leaks_match_brute_force(spark, docs, bench):
    rows = docs + [r for r in awkward() if r[0] is not None and r[0] not in (7, 8)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = d.contaminated(table(spark, rows), items).collect()
    want = plain_leaks(rows, bench)
    mine = {(r.doc_id, r.item_id): r.similarity for r in got}
    # the fingerprints' radius may leave out windows that barely reach the similarity
    assert mine.keys() <= want.keys()
    assert all(k in mine for k, v in want.items() if v >= 0.9)
    assert len(mine) >= 0.9 * len(want)
    assert all(abs(v - want[k]) < 1e-9 for k, v in mine.items())
    assert sum(r.doc_id == 202 and r.item_id == 0 for r in got) == 2


def test_windows_that_barely_reach_the_similarity_are_found(spark):
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(13))) for i in range(300)]
    # eight of nine shingles are the item's: similarity 8 / 10
    rows = [row(i, text.rsplit(" ", 1)[0] + " changed") for i, text in items]
    got = d.contaminated(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sum(r.doc_id == r.item_id for r in got.collect()) == len(items)


def test_filter_keeps_clean_rows_and_columns(spark, docs, bench):
    items = spark.createDataFrame(bench, "item_id long, text string")
    rows = docs + awkward()
    kept = d.without_leaks(table(spark, rows), items)
    assert kept.columns == table(spark, rows).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert not {310, 311, 312, 200, 201, 202} & ids.keys()
    assert ids[7] == ids[8] == 1 and ids[9] == 2 and ids[None] == 1 and ids[1000] == 1


def test_search_finds_every_pair_within_the_radius(spark):
    rng = random.Random(2)
    codes = [rng.getrandbits(64) for _ in range(30)]
    near = [
        c ^ sum(1 << b for b in rng.sample(range(64), k)) for c in codes for k in (0, 1, 8, 15, 16, 17)
    ]
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    items = spark.createDataFrame([(i, 5, 9, signed(c)) for i, c in enumerate(codes)],
                                  "item_id int, width int, places int, code long")
    windows = spark.createDataFrame([(i, 5, 9, signed(c)) for i, c in enumerate(near)],
                                    "cid int, width int, places int, code long")
    got = {(r.cid, r.item_id) for r in d.within_radius(windows, items, 15).collect()}
    want = {
        (i, j) for i, a in enumerate(near) for j, b in enumerate(codes) if (a ^ b).bit_count() <= 15
    }
    assert got == want


def test_empty_tables(spark, bench):
    items = spark.createDataFrame(bench, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(table(spark, []), items).collect() == []
    assert d.contaminated(table(spark, corpus(n=4)), none).collect() == []
    assert d.without_leaks(table(spark, corpus(n=4)), none).count() == 4


def test_fingerprints_are_counted_inside_the_row(spark):
    """The same bits as plain counting, ties and the sign bit included, without an aggregation of 64 sums."""
    rng = random.Random(12)
    lists = [[rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)] for n in (1, 2, 3, 8, 41)]
    lists += [[-1, 0], [-(1 << 63)] * 3, [7] * 4 + [0] * 3]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, shingles array<long>")
    coded = rows.select("k", d.fingerprint_of(rows.shingles).alias("code"))
    got = {r.k: r.code % (1 << 64) for r in coded.collect()}
    for k, x in enumerate(lists):
        assert got[k] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in x) > len(x))
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
