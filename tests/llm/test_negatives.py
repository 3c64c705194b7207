from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import negatives, oracles

SCHEMA = "id long, label int, vector array<float>, score double, key int, planes string"


def plain(rows, n_positives=5, n_negatives=10):
    """Every anchor against every row, one pair after the other."""
    used = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, label, v, *_ in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    late = lambda i: 2**63 if i is None else i
    out = []
    for at, (anchor, label, a) in enumerate(used):
        if anchor is None or anchor % 100:
            continue
        others = [
            (-sum(x * y for x, y in zip(a, v)), late(i), other == label)
            for k, (i, other, v) in enumerate(used) if k != at
        ]
        for p, i, _ in sorted(o for o in others if o[2])[:n_positives]:
            near = sorted(o for o in others if not o[2] and 30 * -p <= 100 * -o[0] <= 90 * -p)
            for rank, (s, j, _) in enumerate(near[:n_negatives]):
                out.append((anchor, *(None if x == 2**63 else x for x in (i,)), rank + 1, None if j == 2**63 else j, -p, -s))
    return sorted(map(repr, out))


def vectors(seed, n, dims=20, scale=0.3, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        vector = [c + rng.gauss(0.05, scale) for c in centres[label]]
        if i % 9 == 0:
            vector = [round(x, 1) for x in vector]  # ties
        rows.append((i * 5, label, vector, 0.0, 1, "p"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(repr(tuple(r)) for r in df.collect())


def test_lookups_are_inner_products():
    rng = np.random.default_rng(3)
    for dims, most in ((1, 4), (8, 200), (13, 3), (64, 300), (20, 1 << 24), (3, 1)):
        a, c = rng.integers(-most, most, (9, dims)), rng.integers(-most, most, (50, dims))
        planes = negatives.bit_planes(c)
        assert planes.dtype == np.uint8 and planes.shape[1] == -(-dims // 8)
        assert (negatives.scores(planes, negatives.subset_sums(a)) == c @ a.T).all()
    assert (negatives.scores(negatives.bit_planes(np.zeros((4, 5), np.int64)), negatives.subset_sums(a[:, :3].repeat(2, 1)[:, :5])) == 0).all()


def test_quantised_is_the_floor_of_the_double():
    values = pa.array([[0.1, -0.1, 1.0], [], [1e30, -1e30], [-0.00390625]], pa.list_(pa.float32()))
    got = negatives.quantised(values, 3)
    want = [[math.floor(256 * float(np.float32(x))) for x in (0.1, -0.1, 1.0)], [0, 0, 0]]
    assert got[:2].tolist() == want and got[2].tolist() == [2**62, -(2**62), 0] and got[3, 0] == -1


@pytest.mark.parametrize("strip, packed, room", [(64, 1024, 64 << 20), (3, 7, 64 << 20), (2, 1024, 1)])
def test_against_plain(spark, monkeypatch, strip, packed, room):
    monkeypatch.setattr(negatives, "_STRIP", strip)
    monkeypatch.setattr(negatives, "PACKED", packed)
    monkeypatch.setattr(negatives, "TABLE_BYTES", room)
    rows = vectors(1, 400)
    rows += rows[:40]  # repeated rows, anchors among them
    rows += [
        (None, 1, rows[5][2], 0.0, 1, "p"), (None, 2, rows[6][2], 0.0, 1, "p"), (100, 1, None, 0.0, 1, "p"),
        (200, None, rows[7][2], None, None, None), (300, 1, [1.0, None], 0.0, 1, "p"),
        (400, 1, [float("nan")] * 20, 0.0, 1, "p"), (500, 1, [float("inf")] * 20, 0.0, 1, "p"),
        (7001, 1, [0.5, 0.5], 0.0, 1, "p"), (-100, 3, rows[8][2], 0.0, 1, "p"),
    ]
    assert rows_of(negatives.hard_negatives(frame(spark, rows))) == plain(rows)


def test_few_rows(spark):
    rows = vectors(2, 6, labels=2)
    assert rows_of(negatives.hard_negatives(frame(spark, rows))) == plain(rows)
    none = [r for r in rows if r[0] % 100]
    assert negatives.hard_negatives(frame(spark, none)).collect() == []
    assert negatives.hard_negatives(frame(spark, rows).limit(0)).collect() == []


def test_query_against_sql(spark, tmp_path):
    rows = [(i, label, v) for i, label, v, *_ in vectors(4, 300, labels=10)] + [(35, 2**31 - 1, [0.1] * 20), (None, 3, [0.2] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(4)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(map(repr, con.execute(oracles.negatives_sql()).fetchall()))
    assert rows_of(negatives.op11_hard_negatives(spark, str(tmp_path))) == want and want
