"""Texts of similar wording: SimHash and MinHash propose, exact Jaccard similarity of word shingles decides.

First fingerprints are linked as op10 links them, by its Gray-order index. Most pairs at similarity 0.8
are further apart than its four bits, so bands of minimum hashes propose as well.

A text's shingles are its runs of ``words`` words (a shorter text is one run), each once. Of 32 bands
of five minimum hashes a pair at similarity 0.8 shares none with probability 3e-6, more similar pairs
less. Texts that share a band form a group; inside groups all pairs not yet linked are screened by
one bit of each of the 160 minimum hashes and then compared shingle by shingle.

Texts are neither copied nor shuffled: one pass over them gives every row its bands and 20 bytes of
sketch, and what moves are those. Texts whose shingles are needed are read again by their keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import encoded, fresh, give_back_memory, stored
from riskloom.llm.decontamination import small
from riskloom.llm.simhash import component_roots, fingerprint, fingerprint_column, star_links

BANDS = 32
_ROWS = 5
#: A pair at similarity s agrees on (1 + s) / 2 of the bits, give or take 0.024 at 0.8; it is lost with
#: probability 6e-8 at most.
_SLACK = 0.16
#: Runs up to this many members are screened together, pair distance by pair distance.
_SHORT = 64
#: Larger groups are compared in pieces, each pair of pieces in a row of its own.
GROUP = 4096
_PIECE = 4096
_DRAW = np.random.default_rng(5)
_TIMES = _DRAW.integers(0, 1 << 63, BANDS * _ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _DRAW.integers(0, 1 << 63, BANDS * _ROWS, np.uint64)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of ``words`` words; empty without words."""
    found = encoded(text).split()
    if not found:
        return np.zeros(0, np.uint64)
    runs = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = (digest(b" ".join(found[k : k + words]), 42) for k in range(runs))
    return np.unique(np.fromiter(hashes, np.uint64, runs))


def text_code(text: str | None) -> int:
    """A long for the sequence of words; 0 without words."""
    found = encoded(text).split()
    return xxhash.xxh64_intdigest(b" ".join(found), 7) if found else 0


def minimum_hashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * _ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), _PIECE):
        x = (hashes[at : at + _PIECE] >> np.uint64(32))[:, None]
        least = np.minimum(least, ((x * _TIMES + _PLUS) >> np.uint64(32)).min(0).astype(np.uint32))
    return least


def sketch_bits(least: np.ndarray) -> bytes:
    """The lowest bit of each minimum hash; bits of unlike hashes agree every second time."""
    return np.packbits((least & 1).astype(np.uint8)).tobytes()


def _codes(text: Column) -> Column:
    @pandas_udf("long")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([text_code(t) for t in batch], np.uint64).view(np.int64))
        give_back_memory()

    return code(text)


def _profiles(text: Column, words: int) -> Column:
    """``code`` of the word sequence, SimHash ``bits``, ``sketch`` and ``bands`` of a text."""

    @pandas_udf("struct<code:long,bits:long,sketch:binary,bands:array<long>>")
    def profile(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            least = [minimum_hashes(shingles(t, words)) for t in batch]
            bands = [
                [xxhash.xxh64_intdigest(part.tobytes(), k) - (1 << 63) for k, part in enumerate(s.reshape(BANDS, _ROWS))]
                for s in least
            ]
            yield pd.DataFrame(
                {
                    "code": np.array([text_code(t) for t in batch], np.uint64).view(np.int64),
                    "bits": np.array([fingerprint(t, words) for t in batch], np.uint64).view(np.int64),
                    "sketch": [sketch_bits(s) for s in least],
                    "bands": bands,
                }
            )
        give_back_memory()

    return profile(text)


def _hashes(text: Column, words: int) -> Column:
    @pandas_udf("binary")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingles(t, words).tobytes() for t in batch], dtype=object)
        give_back_memory()

    return hashes(text)


def _agreement(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.count_nonzero(sketches == one, axis=1) / sketches.shape[1]


def _may(least: float) -> float:
    return (1 + least) / 2 - _SLACK


def nearest(codes: list[int], sketches: np.ndarray, least: float) -> list[tuple[int, int]]:
    """For each member the leader it agrees with best, if they may be similar.

    Who agrees with no earlier leader as texts at ``least`` do becomes one, so a group of copies has
    few leaders and costs little more than one look at each member.
    """
    out, leaders = [], np.zeros(len(codes), np.int64)
    heads, n = np.empty_like(sketches), 0
    for i, sketch in enumerate(sketches):
        best = -1.0
        if n:
            agree = _agreement(heads[:n], sketch)
            j = int(agree.argmax())
            best = agree[j]
            if best >= _may(least):
                out.append((codes[i], codes[leaders[j]]))
        if best < (1 + least) / 2:
            leaders[n], heads[n] = i, sketch
            n += 1
    return out


def unsettled(codes: list[int], sketches: np.ndarray, roots: np.ndarray, least: float) -> list[int]:
    """Members that may be similar to one of another component.

    Pairs inside the largest component are not looked at: only the others meet all members.
    """
    marked = np.zeros(len(codes), bool)
    values, counts = np.unique(roots, return_counts=True)
    for i in np.flatnonzero(roots != values[counts.argmax()]):
        may = (_agreement(sketches, sketches[i]) >= _may(least)) & (roots != roots[i])
        marked |= may
        marked[i] |= may.any()
    return [codes[k] for k in np.flatnonzero(marked)]


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both) - 1e-9


def group_links(
    codes: list[int], sketches: np.ndarray, sets: list[np.ndarray], least: float, roots: np.ndarray
) -> list[tuple[int, int]]:
    """``(u, root)`` for the members that are not the root of their component of similar texts.

    Members of equal ``roots`` are known to be linked and are not compared.
    """
    n = len(codes)
    first: dict[int, int] = {}
    label = np.array([first.setdefault(int(r), k) for k, r in enumerate(roots)])
    sizes = np.array([len(s) for s in sets])
    for i in range(1, n):
        apart = np.flatnonzero(label[:i] != label[i])
        # sizes apart by more than the similarity allows cannot reach it
        apart = apart[np.minimum(sizes[apart], sizes[i]) >= least * np.maximum(sizes[apart], sizes[i]) - 1e-9]
        agree = _agreement(sketches[apart], sketches[i])
        may = agree >= _may(least)
        for j in apart[may][np.argsort(-agree[may], kind="stable")]:
            if label[j] == label[i]:
                continue
            if similar(sets[i], sets[j], least):
                label[label == max(label[i], label[j])] = min(label[i], label[j])
    return [(codes[k], codes[label[k]]) for k in range(n) if label[k] != k]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted rows."""
    differ = np.zeros(len(keys[0]) - 1, bool)
    for key in keys:
        differ |= key[1:] != key[:-1]
    return np.flatnonzero(np.r_[True, differ])


def _few_pairs(packed: np.ndarray, most: int) -> tuple[list[int], list[int]] | None:
    """Pairs of one group that differ in at most ``most`` bits; None if they are more than its members."""
    left: list[int] = []
    right: list[int] = []
    for i in range(1, len(packed)):
        near = np.flatnonzero(np.bitwise_count(packed[:i] ^ packed[i]).sum(1, dtype=np.int64) <= most)
        left += near.tolist()
        right += [i] * len(near)
        if len(left) > len(packed):
            return None
    return left, right


def group_proposals(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links to decide, from whole groups ``g, a, b`` in sorted rows.

    A group with no more pairs that may be similar than members proposes them all and is done. Any
    other is named, ``dense``, by its place, with a hash of its members as ``u``.
    """
    n = len(rows)
    codes = rows["code"].to_numpy()
    raw = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(n, -1)
    packed = np.zeros((n, 24), np.uint8)
    packed[:, : raw.shape[1]] = raw
    packed = packed.view(np.uint64)
    begin = _runs(*[rows[c].to_numpy() for c in ("g", "a", "b")])
    size = np.diff(np.r_[begin, n])
    run, end = np.repeat(np.arange(len(begin)), size), np.repeat(begin + size, size)
    most = int(BANDS * _ROWS * (1 - _may(least)) + 1e-9)
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    here, step = np.flatnonzero(size[run] <= _SHORT), 1
    while len(here := here[here + step < end[here]]):
        near = here[np.bitwise_count(packed[here] ^ packed[here + step]).sum(1, dtype=np.int64) <= most]
        lefts.append(near)
        rights.append(near + step)
        step += 1
    left, right = np.concatenate(lefts), np.concatenate(rights)
    dense = np.bincount(run[left], minlength=len(begin)) > size
    done = ~dense[run[left]]
    links = [(codes[left[done]], codes[right[done]])]
    for k in np.flatnonzero(size > _SHORT):
        found = _few_pairs(packed[begin[k] : begin[k] + size[k]], most)
        dense[k] = found is None
        if found:
            links.append(tuple(codes[begin[k] + np.array(side, np.int64)] for side in found))
    marks = []
    for k in np.flatnonzero(dense):
        own = slice(begin[k], begin[k] + size[k])
        marks.append((xxhash.xxh64_intdigest(codes[own].tobytes()) - (1 << 63), begin[k]))
    at = [m[1] for m in marks]
    u = np.concatenate([side[0] for side in links] + [np.array([m[0] for m in marks], np.int64)])
    v = np.concatenate([side[1] for side in links] + [np.zeros(len(at), np.int64)])
    out = {"u": u, "v": v}
    for c in ("g", "a", "b"):
        out[c] = np.r_[np.zeros(len(u) - len(at), np.int64), rows[c].to_numpy()[at].astype(np.int64)]
    return pd.DataFrame(out | {"dense": np.arange(len(u)) >= len(u) - len(at)})


def _proposals(placed: DataFrame, least: float) -> DataFrame:
    """``group_proposals`` of all groups; a task takes its groups one after the other."""

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = _runs(*[rows[c].to_numpy() for c in ("g", "a", "b")])[-1]
            if last:
                yield group_proposals(rows[:last], least)
            held = rows[last:].reset_index(drop=True)
        if held is not None:
            yield group_proposals(held, least)
        give_back_memory()

    dealt = placed.repartition("g", "a", "b").sortWithinPartitions("g", "a", "b", "code")
    return dealt.mapInPandas(propose, "u long, v long, g long, a long, b long, dense boolean")


_LINKS = "array<struct<u:long,v:long>>"


def _sketches_in(group: list) -> np.ndarray:
    return np.stack([np.unpackbits(np.frombuffer(m["sketch"], np.uint8)) for m in group])


def _codes_in(group: list) -> list[int]:
    return [int(m["code"]) for m in group]


def _as_links(links: list[tuple[int, int]]) -> list[dict]:
    return [{"u": u, "v": v} for u, v in links]


def _nearest(members: str, least: float) -> Column:
    @pandas_udf(_LINKS)
    def links(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_as_links(nearest(_codes_in(g), _sketches_in(g), least)) for g in batch])
        give_back_memory()

    return links(members)


def _unsettled(members: str, least: float) -> Column:
    @pandas_udf("array<long>")
    def codes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            roots = [np.array([m["root"] for m in g], np.int64) for g in batch]
            yield pd.Series(
                [unsettled(_codes_in(g), _sketches_in(g), r, least) for g, r in zip(batch, roots)]
            )
        give_back_memory()

    return codes(members)


def _stars(members: str, least: float) -> Column:
    @pandas_udf(_LINKS)
    def stars(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for g in batch:
                roots = np.array([m["root"] for m in g], np.int64)
                sets = [np.frombuffer(m["hashes"], np.uint64) for m in g]
                links = group_links(_codes_in(g), _sketches_in(g), sets, least, roots)
                out.append(_as_links(links))
            yield pd.Series(out)
        give_back_memory()

    return stars(members)


def _similar(one: str, other: str, least: float) -> Column:
    @pandas_udf("boolean")
    def decide(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            pairs = zip(a, b)
            yield pd.Series(
                [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), least) for x, y in pairs]
            )
        give_back_memory()

    return decide(one, other)


def fingerprint_links(texts: DataFrame, words: int) -> DataFrame:
    """Pairs of codes that join all texts whose SimHash fingerprints lie within four bits, step by step."""
    return _linked_prints(stored(texts.select("code", fingerprint_column(F.col("text"), words).alias("bits"))))


def _linked_prints(coded: DataFrame) -> DataFrame:
    first = stored(coded.groupBy("bits").agg(F.min("code").alias("first")))
    stars = star_links(first.select(F.col("bits").alias("code")))
    across = stars.join(first.toDF("u", "one"), "u").join(first.toDF("v", "other"), "v")
    same = coded.join(first, "bits").where(F.col("code") != F.col("first")).select("code", "first")
    return same.union(across.select("one", "other")).toDF("u", "v")


def similar_links(texts: DataFrame, words: int, least: float) -> DataFrame:
    """Links ``(u, v)`` that join all components of similar texts; ``texts`` has one row per ``code``."""
    made = stored(
        texts.select("code", _profiles(F.col("text"), words).alias("p")).select("code", "p.bits", "p.sketch", "p.bands")
    )

    def hashed(codes: DataFrame) -> DataFrame:
        some = texts.join(codes.distinct(), "code", "left_semi")
        return stored(some.select("code", _hashes(F.col("text"), words).alias("hashes")))

    return _links(made, hashed, least)


def _placed(made: DataFrame) -> DataFrame:
    """``g, a, b, code, sketch``: a row for each group a text is in, and each pair of pieces of a large one."""
    value = F.explode("bands").alias("g")
    sizes = made.select(value).groupBy("g").count().where(F.col("count") > GROUP)
    large = small(stored(sizes.select("g", F.ceil(F.col("count") / F.lit(GROUP)).cast("int").alias("k"))))
    return (
        made.select("code", "sketch", value)
        .join(large, "g", "left")
        .withColumn("k", F.coalesce("k", F.lit(1)))
        .withColumn("own", F.pmod(F.hash("code"), F.col("k")))
        # each member goes to every pair of pieces its own takes part in
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("g", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "code", "sketch")
    )


def _links(made: DataFrame, hashed: Callable[[DataFrame], DataFrame], least: float) -> DataFrame:
    """Links of texts given by ``code, bits, sketch, bands``; ``hashed`` gives ``code, hashes`` for some codes.

    Shingles travel late and seldom. First the fingerprints' links, the pairs of groups with few of
    them, and in other groups every member's best-agreeing leader are decided on shingles. Then, only
    in those other groups, members that may be similar to one of another component meet with their shingles.
    """
    place = ["g", "a", "b"]
    found = stored(_proposals(_placed(made), least))
    # groups of the same members are looked at once
    dense = stored(found.where("dense").groupBy("u").agg(F.min(F.struct(*place)).alias("at")).select("at.*"))
    members = stored(_placed(made).join(small(dense), place, "left_semi"))

    def together(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.groupBy(*place).agg(F.collect_list(F.struct("code", *columns)).alias("members"))

    leaders = together(members, "sketch").select(F.explode(_nearest("members", least)).alias("link"))
    proposed = (
        found.where(~F.col("dense")).select("u", "v")
        .union(leaders.select("link.u", "link.v"))
        .union(_linked_prints(made.select("code", "bits")))
    )
    proposed = stored(proposed.distinct())
    hashes = hashed(proposed.select(F.explode(F.array("u", "v")).alias("code")))
    decided = proposed.join(hashes.toDF("u", "one"), "u").join(hashes.toDF("v", "other"), "v")
    links = stored(decided.where(_similar("one", "other", least)).select("u", "v"))

    roots = component_roots(links).select(F.col("u").alias("code"), F.col("v").alias("root"))
    members = stored(members.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code")))
    open_rows = stored(
        together(members, "sketch", "root").select(*place, F.explode(_unsettled("members", least)).alias("code"))
    )
    met = open_rows.join(members, [*place, "code"]).join(hashed(open_rows.select("code")), "code")
    rest = together(met, "sketch", "root", "hashes").select(F.explode(_stars("members", least)).alias("link"))
    return links.union(rest.select("link.u", "link.v")).distinct()


def without_similar(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """Rows of ``docs`` with one document of each component of texts at similarity ``least`` or more.

    The smallest id stays, then the smallest text hash. All columns are kept. Of rows that agree in id
    and text one stays; documents without id give way to any document with an id. Texts without words
    are one text. Texts of any length are compared whole; an empty table stays empty.
    """
    key, again, rank = fresh(docs, "key", "again", "rank")
    identity = F.md5(
        F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text"))
    )
    coded = stored(
        docs.select("doc_id", identity.alias("key"), _profiles(F.col("text"), words).alias("p")).select(
            "doc_id", "key", "p.*"
        )
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    # copies are gone before texts meet; equal words have equal profiles
    made = stored(
        coded.groupBy("code").agg(
            F.min(order).alias("best"), *[F.first(c).alias(c) for c in ("bits", "sketch", "bands")]
        )
    )
    best = made.select("code", "best")

    def hashed(codes: DataFrame) -> DataFrame:
        keys = stored(best.join(codes.distinct(), "code").select("code", F.col("best.key").alias("key")))
        some = docs.select(identity.alias("key"), "text").join(small(keys), "key")
        return stored(some.select("code", _hashes(F.col("text"), words).alias("hashes")).dropDuplicates(["code"]))

    roots = component_roots(_links(made, hashed, least))
    kept = (
        best.join(roots.select(F.col("u").alias("code"), F.col("v").alias("root")), "code", "left")
        .groupBy(F.coalesce("root", "code").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.key").alias("key"), F.lit(True).alias("kept"))
    )
    # only keys that go, or stay with one of several rows, are looked up: most rows pass where they are
    odd = small(
        stored(
            coded.groupBy("key").count().join(kept, "key", "left")
            .where(F.col("kept").isNull() | (F.col("count") > 1))
            .select(F.col("key").alias(key), F.col("kept").isNotNull().alias(again))
        )
    )
    columns = [f"`{c}`" for c in docs.columns]
    marked = docs.withColumn(key, identity)
    one = Window.partitionBy(key).orderBy(F.xxhash64(*columns))
    repeated = marked.join(odd.where(again), key).withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    return marked.join(odd, key, "left_anti").select(*columns).union(repeated.select(*columns))
