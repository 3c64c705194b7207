"""Hard-negative mining with exact integer scores from table lookups.

Components become integers, ``floor(256 * x)``. Eight dimensions make a group. For each anchor and
group a table holds the sums of all 256 subsets of the anchor's eight components. Candidates are cut
into bit planes (two's complement): one byte for eight dimensions' bits of one plane. A candidate's
inner product with an anchor is then a sum of table entries at those bytes, doubled from plane to
plane, the sign's plane counting negative: lookups, shifts and additions only, and exact.

Candidates are packed once and written. Anchors come in blocks; every candidate meets every anchor of
a block, first for the best of the same label, then for the ranges that those positives define. Tasks
keep the best rows only, so what is shuffled does not grow with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import give_back_memory, stored, table

POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of its positive's score.
RANGE = (30, 90)
#: Bytes of tables that a task holds at once: this sets how many anchors one pass takes.
TABLE_BYTES = 64 << 20
_STRIP = 64
#: Candidates of one packed row.
PACKED = 1024
#: Stands for a null id, which sorts behind all others.
_NO_ID = np.iinfo(np.int64).max
_LARGEST = 2.0**62


def quantised(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """``floor(256 * x)`` of each component, as rows of ``dims``; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dims), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(vectors.value_lengths())
    rows = np.repeat(np.arange(len(vectors)), sizes)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, columns] = np.clip(np.floor(256.0 * flat), -_LARGEST, _LARGEST).astype(np.int64)
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Planes × groups × rows of bytes: two's complement bits of eight dimensions, highest plane first."""
    n, dims = values.shape
    planes = 1 + max((int(v).bit_length() for v in (values.max(initial=0), -1 - values.min(initial=0))), default=0)
    padded = np.zeros((n, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = values
    out = np.zeros((planes, padded.shape[1] // 8, n), np.uint8)
    for k in range(planes):
        bits = (padded >> (planes - 1 - k) & 1).astype(np.uint8)
        out[k] = np.packbits(bits, axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Groups × 256 × anchors: the sum of an anchor's components over each subset of a group."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, n), np.int64)
    padded[:dims] = anchors.T
    sums = np.zeros((groups, 256, n), np.int64)
    for bit in range(8):
        low = 1 << bit
        sums[:, low : 2 * low] = sums[:, :low] + padded[bit::8][:, None, :]
    most = int(np.abs(sums).sum(0).max(initial=0))
    return sums.astype(np.int32) if most < 1 << 31 else sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Candidates × anchors: inner products, by lookups, shifts and additions."""
    most = int(np.abs(sums).max(initial=0)) * len(sums) << len(planes)
    kind = np.int32 if most < 1 << 31 else np.int64
    sums = sums.astype(kind, copy=False)
    total = np.zeros((planes.shape[2], sums.shape[2]), kind)
    for k, plane in enumerate(planes):
        part = np.zeros_like(total)
        for group, table_ in enumerate(sums):
            part += table_[plane[group]]
        total <<= 1
        total += -part if k == 0 else part
    return total


@dataclass
class Anchors:
    """One block of anchors: ids, labels and integer components."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray

    def strips(self) -> Iterator[tuple[slice, np.ndarray]]:
        for low in range(0, len(self.ids), _STRIP):
            at = slice(low, low + _STRIP)
            yield at, subset_sums(self.values[at])


class Best:
    """The ``most`` best ``(score, id)`` rows of many keys, fed strip by strip."""

    def __init__(self, keys: int, most: int):
        self.most = most
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(keys)]
        #: A score below this cannot enter any more.
        self.least = np.full(keys, np.iinfo(np.int64).min)

    def add(self, key: int, found: np.ndarray, ids: np.ndarray) -> None:
        if len(found) > self.most:
            kth = np.partition(found, -self.most)[-self.most]
            found, ids = found[found >= kth], ids[found >= kth]
        held = self.rows[key]
        held += zip(found.tolist(), ids.tolist())
        held.sort(key=lambda row: (-row[0], row[1]))
        del held[self.most :]
        if len(held) == self.most:
            self.least[key] = held[-1][0]


def packed(rows: DataFrame, dims: int) -> DataFrame:
    """Candidates in packed rows: ``ids``, ``labels`` and ``planes`` of up to ``PACKED`` vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PACKED):
                some = batch.slice(low, PACKED)
                planes = bit_planes(quantised(some.column("vector"), dims))
                ids = some.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                labels = some.column("label").to_numpy(zero_copy_only=False)
                columns = [ids.astype("<i8"), labels.astype("<i8"), planes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.tobytes()], pa.binary()) for c in columns], ["ids", "labels", "planes"]
                )
        give_back_memory()

    return rows.mapInArrow(pack, "ids binary, labels binary, planes binary")


def _unpacked(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for ids, labels, planes in zip(*(batch.column(c) for c in ("ids", "labels", "planes"))):
            ids = np.frombuffer(ids.as_py(), "<i8")
            planes = np.frombuffer(planes.as_py(), np.uint8).reshape(-1, groups, len(ids))
            yield ids, np.frombuffer(labels.as_py(), "<i8"), planes


def _ranked(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` best rows of each ``key``, from the best of every task."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.col("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _emitted(best: Best) -> pa.RecordBatch:
    rows = [(key, i, s) for key, held in enumerate(best.rows) for s, i in held]
    columns = zip(*rows) if rows else ([], [], [])
    types = (pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "id", "score"])


_BEST = "key int, id long, score long"


def positives(candidates: DataFrame, anchors: Anchors, most: int) -> list[list[tuple[int, int]]]:
    """Each anchor's ``most`` best ``(id, score)`` among the other rows of its label."""
    groups = -(-anchors.values.shape[1] // 8)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one more, as the anchor itself is among them
        best = Best(len(anchors.ids), most + 1)
        wanted = np.unique(anchors.labels)
        tables = list(anchors.strips())
        for ids, labels, planes in _unpacked(batches, groups):
            for label in wanted[np.isin(wanted, labels)].tolist():
                mine = np.flatnonzero(labels == label)
                own_planes, own_ids = planes[:, :, mine], ids[mine]
                for at, sums in tables:
                    columns = np.flatnonzero(anchors.labels[at] == label)
                    if not len(columns):
                        continue
                    s = scores(own_planes, np.ascontiguousarray(sums[:, :, columns]))
                    keys = columns + at.start
                    enter = s >= best.least[keys]
                    for column in np.flatnonzero(enter.any(0)).tolist():
                        rows = enter[:, column]
                        best.add(int(keys[column]), s[rows, column], own_ids[rows])
        yield _emitted(best)
        give_back_memory()

    found: list[list[tuple[int, int]]] = [[] for _ in anchors.ids]
    rows = _ranked(candidates.mapInArrow(find, _BEST), most + 1)
    for key, i, s, _ in sorted(rows.collect(), key=lambda r: (r["key"], r["rank"])):
        found[key].append((i, s))
    for key, mine in enumerate(found):
        itself = (int(anchors.ids[key]), int(anchors.values[key] @ anchors.values[key]))
        if itself in mine:
            mine.remove(itself)
        del mine[most:]
    return found


def negatives(
    candidates: DataFrame, anchors: Anchors, asked: list[tuple[int, int]], most: int, share: tuple[int, int]
) -> DataFrame:
    """``key, id, score, rank``: for each of ``asked`` (anchor, positive's score) the best in its range."""
    groups = -(-anchors.values.shape[1] // 8)
    of_anchor: dict[int, list[int]] = {}
    for key, (anchor, _) in enumerate(asked):
        of_anchor.setdefault(anchor, []).append(key)
    low = [-(-share[0] * s // 100) for _, s in asked]
    high = [share[1] * s // 100 for _, s in asked]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(asked), most)
        best.least[:] = low
        tables = list(anchors.strips())
        for ids, labels, planes in _unpacked(batches, groups):
            for at, sums in tables:
                s = scores(planes, sums).T
                for row, anchor in enumerate(range(at.start, min(at.stop, len(anchors.ids)))):
                    keys = of_anchor.get(anchor, ())
                    if not keys:
                        continue
                    floor = min(best.least[k] for k in keys)
                    near = np.flatnonzero((s[row] >= floor) & (labels != anchors.labels[anchor]))
                    if not len(near):
                        continue
                    mine, own_ids = s[row][near].astype(np.int64), ids[near]
                    for key in keys:
                        inside = (mine >= best.least[key]) & (mine <= high[key])
                        if inside.any():
                            best.add(key, mine[inside], own_ids[inside])
        yield _emitted(best)
        give_back_memory()

    return _ranked(candidates.mapInArrow(find, _BEST), most)


def hard_negatives(
    rows: DataFrame,
    anchor_ids: str = "id % 100 = 0",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    share: tuple[int, int] = RANGE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``id`` (long), ``label`` and ``vector``. Anchors are the rows for which the SQL text
    ``anchor_ids`` holds. Rows with a null label, a null vector or a null or non-finite component take
    no part. Equal scores go by smaller id, a null id last. Equal rows are rows of their own: copies
    of an anchor are anchors and also its positives. Vectors shorter than the longest count as ending
    in zeros. Scores are 64-bit integers, exact while they fit; ``floor(256 * x)`` stops at 2^62. An
    empty table, or one without anchors, gives no rows; other columns are not read.
    """
    spark = rows.sparkSession
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    used = rows.select("id", F.col("label").cast("long").alias("label"), "vector").where(
        F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
    )
    dims = max(1, used.agg(F.max(F.size("vector"))).first()[0] or 1)
    candidates = stored(packed(used, dims))
    asked_rows = stored(used.where(anchor_ids))
    at_once = max(_STRIP, TABLE_BYTES // (-(-dims // 8) * 256 * 8))
    passes = max(1, -(-asked_rows.count() // at_once))
    results = []
    for number in range(passes):
        some = asked_rows.where(F.pmod(F.xxhash64("id", "vector"), F.lit(passes)) == number).toArrow()
        anchors = Anchors(
            some.column("id").to_numpy().astype(np.int64), some.column("label").to_numpy().astype(np.int64),
            quantised(some.column("vector").combine_chunks(), dims),
        )
        found = positives(candidates, anchors, n_positives)
        asked = [(a, i, s) for a, mine in enumerate(found) for i, s in mine]
        hits = negatives(candidates, anchors, [(a, s) for a, _, s in asked], n_negatives, share)
        keys = spark.createDataFrame(
            [(key, int(anchors.ids[a]), i, s) for key, (a, i, s) in enumerate(asked)],
            "key int, anchor_id long, positive_id long, positive_score long",
        )
        results.append(hits.join(F.broadcast(keys), "key"))
    out = results[0]
    for other in results[1:]:
        out = out.union(other)
    known = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c))
    return out.select(
        "anchor_id", known("positive_id").alias("positive_id"), "rank", known("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(
        rows.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector"))
    )
