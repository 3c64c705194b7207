"""Near-duplicate detection: SimHash fingerprints linked through a Gray-order hierarchical index.

Two different fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bit blocks,
so fingerprints are grouped by each block's value: the shared bits are the index's upper node. A
group that is still large is divided again by ``radius + 1`` blocks of its remaining bits, which
loses no link for the same reason. Inside a group the fingerprints are sorted by Gray rank and put
into a tree whose nodes hold the bits all members share; a search adds up differences from the root
down and leaves a node out once they pass the radius. Groups return stars, not pairs, and stars are
joined to components by alternating large-star and small-star steps over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import encoded, fresh, give_back_memory, stored, table

_PIECE = 1 << 15
_FANOUT = 8
_FRONTIER = 1 << 20


# --- fingerprints -----------------------------------------------------------------------------


def fingerprint(text: str | None, words: int = 4) -> int:
    """Unsigned SimHash of a text's word shingles; 0 for a text without words."""
    found = encoded(text).split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    if len(found) > words:
        starts, stops = starts[: 1 - words], stops[words - 1 :]
    else:
        starts, stops = starts[:1], stops[-1:]
    total, counts = len(starts), np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, total, _PIECE):
        spans = zip(starts[at : at + _PIECE].tolist(), stops[at : at + _PIECE].tolist())
        raw = np.frombuffer(b"".join([digest(joined[a:b], 42) for a, b in spans]), np.uint8)
        counts += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprint_column(text: Column, words: int = 4) -> Column:
    """The fingerprint's 64 bits as a (signed) long."""

    @pandas_udf("long")
    def bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.array([fingerprint(t, words) for t in batch], np.uint64)
            yield pd.Series(out.view(np.int64))
        give_back_memory()

    return bits(text)


# --- the index inside one group ---------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayTree:
    """Nodes over runs of Gray-sorted fingerprints; each level holds value, own mask and children."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        value, shared = self.codes, np.full(len(self.codes), full)
        levels = [(value, shared)]
        while len(value) > 1:
            first = np.arange(0, len(value), _FANOUT)
            owner = np.arange(len(value)) // _FANOUT
            differ = np.bitwise_or.reduceat(value ^ value[first][owner], first)
            shared = np.bitwise_and.reduceat(shared, first) & ~differ
            value = value[first]
            levels.append((value, shared))
        self.levels = levels[::-1]

    def near(self, low: int, high: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j) for the members i in [low, high): all j within the radius, i included."""
        ask = self.codes[low:high]
        value, shared = self.levels[0]
        who = np.arange(high - low)
        node = np.zeros(high - low, np.int64)
        passed = np.bitwise_count((ask ^ value[0]) & shared[0]).astype(np.int64)
        above = shared
        for value, shared in self.levels[1:]:
            keep = passed <= radius
            who, node, passed = who[keep], node[keep], passed[keep]
            child = node[:, None] * _FANOUT + np.arange(_FANOUT)[None, :]
            there = child < len(value)
            who = np.repeat(who, there.sum(1))
            passed = np.repeat(passed, there.sum(1))
            parent_mask = np.repeat(above[node], there.sum(1))
            node = child[there]
            passed = passed + np.bitwise_count(
                (ask[who] ^ value[node]) & shared[node] & ~parent_mask
            )
            above = shared
        keep = passed <= radius
        return who[keep] + low, node[keep]


def group_roots(codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, root of each): members of one component within the group share a root."""
    tree = GrayTree(codes)
    n = len(codes)
    label = np.arange(n)
    low, step = 0, 8
    while low < n:
        high = min(n, low + step)
        who, near = tree.near(low, high, radius)
        order = np.argsort(who, kind="stable")
        who, mine = who[order], label[near[order]]
        begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        parent = np.arange(n)

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        differ = np.minimum.reduceat(mine, begin) != np.maximum.reduceat(mine, begin)
        ends = np.r_[begin[1:], len(mine)]
        for k in np.flatnonzero(differ):
            some = np.unique(mine[begin[k] : ends[k]])
            root = find(int(some[0]))
            for other in some[1:].tolist():
                parent[find(other)] = root
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        label = parent[label]
        low, step = high, max(1, min(2 * step, _FRONTIER // max(1, n)))
    return tree.codes, tree.codes[label]


def _stars(groups: str, radius: int) -> Column:
    """Star links ``(u, v)`` inside each array of codes."""

    @pandas_udf("array<struct<u:long,v:long>>")
    def stars(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for members in batch:
                codes, roots = group_roots(np.asarray(members, np.int64).view(np.uint64), radius)
                own = codes != roots
                pairs = zip(codes[own].view(np.int64).tolist(), roots[own].view(np.int64).tolist())
                out.append([{"u": u, "v": v} for u, v in pairs])
            yield pd.Series(out)
        give_back_memory()

    return stars(groups)


# --- groups and links over the whole table ----------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _divided(mask: int, blocks: int) -> list[int]:
    """``mask`` with each of ``blocks`` even shares of the remaining bits added."""
    rest = [1 << b for b in range(63, -1, -1) if not mask >> b & 1]
    cuts = [len(rest) * k // blocks for k in range(blocks + 1)]
    return [mask | sum(rest[a:b]) for a, b in zip(cuts, cuts[1:])]


def star_links(codes: DataFrame, radius: int = 4, group: int = 4096, depth: int = 4) -> DataFrame:
    """Links ``(u, v)`` among the distinct longs in column ``code`` that join all components.

    ``group`` only chooses the plan: a group above it is divided by further bits, up to ``depth``
    times (then its members share most bits and the tree takes whole nodes at once).
    """
    blocks = radius + 1
    masks = _divided(0, blocks)
    entries = codes.select(
        "code", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")
    ).withColumn("held", F.expr("code & mask"))
    ready = []
    for _ in range(depth - 1):
        large = stored(
            entries.groupBy("mask", "held").count().where(F.col("count") > group).drop("count")
        )
        if large.isEmpty():
            break
        ready.append(entries.join(large, ["mask", "held"], "left_anti"))
        children = F.create_map(
            *[
                part
                for m in masks
                for part in (
                    F.lit(_signed(m)),
                    F.array(*[F.lit(_signed(c)) for c in _divided(m, blocks)]),
                )
            ]
        )
        masks = list(dict.fromkeys(c for m in masks for c in _divided(m, blocks)))
        entries = (
            entries.join(large, ["mask", "held"], "left_semi")
            .select("code", F.explode(children[F.col("mask")]).alias("mask"))
            .distinct()
            .withColumn("held", F.expr("code & mask"))
        )
    ready.append(entries)
    links = None
    for part in ready:
        one = (
            part.groupBy("mask", "held")
            .agg(F.collect_list("code").alias("codes"))
            .where(F.size("codes") > 1)
            .select(F.explode(_stars("codes", radius)).alias("link"))
            .select("link.u", "link.v")
        )
        links = one if links is None else links.union(one)
    return links.distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first())


def component_roots(links: DataFrame) -> DataFrame:
    """``(u, v)``: each linked node that is not its component's smallest, with that smallest node."""
    edges = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        edges = stored(
            joined.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, group: int = 4096
) -> DataFrame:
    """One row per document: ``doc_id``, ``code`` (fingerprint as long), ``component_id``.

    Null or empty texts have code 0 and are linked like any other. ``component_id`` is the smallest
    non-null id of the component (null if it has none). Repeated rows are kept; columns other than
    ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
    """
    coded = stored(docs.select("doc_id", fingerprint_column(F.col("text"), words).alias("code")))
    first = stored(coded.groupBy("code").agg(F.min("doc_id").alias("first_id")))
    roots = component_roots(star_links(first.select("code"), radius, group))
    linked = first.join(
        roots.select(F.col("u").alias("code"), F.col("v").alias("root")), "code", "left"
    ).withColumn("root", F.coalesce("root", "code"))
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = linked.join(smallest, "root").select("code", "component_id")
    return coded.join(classes, "code").select("doc_id", "code", "component_id")


def hex_code(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def without_near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """Rows of ``docs`` with one document of each component: the smallest id, then smallest text hash.

    All columns are kept. Of rows that agree in id and text one stays; documents without id form
    components by their fingerprints alone and give way to any document with an id.
    """
    key, kept_key, rank = fresh(docs, "key", "kept_key", "rank")
    identity = F.md5(
        F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text"))
    )
    coded = stored(
        docs.select(
            "doc_id", identity.alias("key"), fingerprint_column(F.col("text"), words).alias("code")
        )
    )
    # the best row of a fingerprint first, so that copies are gone before components meet
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    best = stored(coded.groupBy("code").agg(F.min(order).alias("best")))
    roots = component_roots(star_links(best.select("code"), radius))
    kept = (
        best.join(roots.select(F.col("u").alias("code"), F.col("v").alias("root")), "code", "left")
        .groupBy(F.coalesce("root", "code").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.key").alias(kept_key))
    )
    marked = docs.withColumn(key, identity)
    one = Window.partitionBy(key).orderBy(F.xxhash64(*[f"`{c}`" for c in docs.columns]))
    return (
        marked.join(kept, F.col(key) == F.col(kept_key))
        .withColumn(rank, F.row_number().over(one))
        .where(F.col(rank) == 1)
        .select(*[f"`{c}`" for c in docs.columns])
    )


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_code(F.col("code")).alias("fingerprint"), "component_id")
