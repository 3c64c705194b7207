"""Benchmark decontamination: SimHash of item-sized windows, a multi-index search, exact checks.

Texts are lower-cased runs of letters and digits, cut into five-word shingles (an item of fewer words
is one shingle of its own width). A window has as many shingles as its item. If the weighted
similarity, sum of smaller multiplicities over sum of larger ones, reaches ``least``, at least that
share of the window's places holds shingles of the item, and moving the window to its first such
place does not lower the similarity. So only windows that begin at a shared shingle, and are dense
enough, get a fingerprint: nothing that could pass is left out before the fingerprints.

Fingerprints meet the fingerprints of the items that proposed them through eight 8-bit blocks. Within
``radius`` bits one block differs in at most an eighth of it, and the item side lists all such values
of each block (37 of 256 at 23 bits), so the search finds every pair within the radius; the listed
values are shuffled, never broadcast. Pairs are then checked on their shingles. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, stored, table

SHINGLE = 5
LEAST = 0.8
RADIUS = 23
_BLOCKS = 8
#: Sides up to this many rows are broadcast (at most about 50 MB); larger ones are shuffled.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; null counts as empty."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, width: Column | int) -> Column:
    """64-bit hashes of all runs of ``width`` words, in order."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(words) - width
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(1), last + 1), lambda k: F.xxhash64(F.slice(words, k, width))),
    ).otherwise(F.array().cast("array<bigint>"))


def text_key(text: Column) -> Column:
    """Texts are looked at once each, whatever the number of copies."""
    return F.md5(F.coalesce(text, F.lit("")))


def small(df: DataFrame) -> DataFrame:
    """Mark a written table for broadcast if its row count is under the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fingerprint_of(shingles: Column) -> Column:
    """A long: a bit is set if it is in over half of the shingles.

    The bits are counted inside the row. Sixty-four sums over exploded shingles gave the same, but a
    row as wide, a shuffle and the largest generated code of the query.
    """
    one = F.lit(1).cast("long")

    def with_bit(code: Column, bit: Column) -> Column:
        holders = F.size(F.filter(shingles, lambda h: F.getbit(h, bit) == 1))
        value = F.call_function("shiftleft", one, bit)
        return F.when(2 * holders > F.size(shingles), code.bitwiseOR(value)).otherwise(code)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit)


def within_radius(
    windows: DataFrame, items: DataFrame, radius: int, on: tuple[str, ...] = ("width", "places")
) -> DataFrame:
    """``cid, item_id`` of all fingerprints that agree in the columns ``on``, within the radius."""
    near, bits = radius // _BLOCKS, 64 // _BLOCKS
    flips = F.filter(F.sequence(F.lit(0), F.lit((1 << bits) - 1)), lambda m: F.bit_count(m) <= near)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(_BLOCKS - 1))).alias("block")
    value = f"shiftrightunsigned({{0}}, {bits} * block) & {(1 << bits) - 1}"
    asked = windows.select("cid", *on, F.col("code").alias("window_code"), blocks)
    asked = asked.withColumn("value", F.expr(value.format("window_code")))
    held = items.select("item_id", *on, F.col("code").alias("item_code"), blocks)
    held = held.withColumn("flip", F.explode(flips)).withColumn(
        "value", F.expr(f"({value.format('item_code')}) ^ flip")
    )
    return (
        # the listed values are many more rows than Spark's estimate, so no side may be broadcast
        asked.join(held.hint("merge"), [*on, "block", "value"])
        .where(F.bit_count(F.expr("window_code ^ item_code")) <= radius)
        .select("cid", "item_id")
        .distinct()
    )


def weighted_overlap(a: Column, b: Column) -> Column:
    """Sum over shingles of the smaller multiplicity."""
    common = F.array_intersect(a, b)
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(
        common,
        F.lit(0),
        lambda total, h: total
        + F.least(F.size(F.filter(a, lambda x: x == h)), F.size(F.filter(b, lambda x: x == h))),
    )
    return F.when(plain, F.size(common)).otherwise(counted)


def leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS
) -> DataFrame:
    """``key, item_id, start_word, item_words, similarity``: the best window of each text and item.

    ``key`` is ``text_key`` of the document. Items without words match nothing; of equal windows the
    first counts; null item ids are kept; repeated items are one; items of equal words are searched
    for once and reported by each id. Texts of any length are read whole; an empty table on either
    side gives no rows. Columns other than ``text`` and the benchmark's ``item_id`` and ``text`` are
    not read.
    """
    item_words = words_of(F.col("text"))
    named = stored(
        benchmark.select("item_id", item_words.alias("words"))
        .where(F.size("words") > 0)
        .withColumn("no", F.md5(F.array_join("words", " ")))
        .distinct()
    )
    items = stored(
        named.dropDuplicates(["no"])
        .withColumn("item_words", F.size("words"))
        .withColumn("width", F.least(F.lit(SHINGLE), "item_words"))
        .withColumn("shingles", shingles_of(F.col("words"), F.col("width")))
        .select("no", "item_words", "width", "shingles", F.size("shingles").alias("places"))
        .withColumn("code", fingerprint_of(F.col("shingles")))
    )
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    places = stored(
        items.select("no", "width", "places", F.explode("shingles").alias("h")).distinct()
    )
    # runs of different widths have different hashes, so the hash alone is the key
    known = small(stored(places.select("h").distinct()))

    texts = docs.select("text", text_key(F.col("text")).alias("key"))
    split = texts.select("key", words_of(F.col("text")).alias("words"))
    runs = F.array(
        *[
            F.struct(F.lit(w).alias("width"), shingles_of(F.col("words"), w).alias("shingles"))
            for w in widths or [SHINGLE]
        ]
    )
    every = split.select("key", F.explode(runs).alias("r")).select(
        "key", F.col("r.width").alias("width"), F.posexplode("r.shingles").alias("pos", "h")
    )
    shared = stored(every.join(known, "h").distinct())

    # windows that begin at a shingle shared with an item and hold enough of the item's
    need = F.ceil(F.lit(least) * F.col("places")).cast("int")
    spans = (
        shared.join(small(places), ["width", "h"])
        .groupBy("key", "no", "width", "places")
        .agg(F.sort_array(F.collect_set("pos")).alias("at"))
        .withColumn("need", need)
        .where(F.size("at") >= F.col("need"))
        .withColumn(
            "starts",
            F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.size("at") - F.col("need")),
                    lambda k: F.when(
                        F.get(F.col("at"), k + F.col("need") - 1) - F.get(F.col("at"), k)
                        < F.col("places"),
                        F.get(F.col("at"), k),
                    ),
                ),
                lambda s: s.isNotNull(),
            ),
        )
    )
    windows = stored(spans.select("key", "no", "width", "places", F.explode("starts").alias("start")))
    by_key = small(
        stored(
            windows.groupBy("key").agg(
                F.collect_list(F.struct("no", "width", "places", "start")).alias("w")
            )
        )
    )
    cut = stored(
        texts.join(by_key, "key")
        .dropDuplicates(["key"])
        .select("key", words_of(F.col("text")).alias("words"), F.explode("w").alias("w"))
        .select("key", "w.*", F.expr("slice(words, start + 1, places + width - 1)").alias("part"))
        .withColumn("shingles", shingles_of(F.col("part"), F.col("width")))
        .withColumn("cid", F.md5(F.array_join(F.col("shingles").cast("array<string>"), ",")))
        .withColumn("code", fingerprint_of(F.col("shingles")))
        .select("key", "no", "start", "width", "places", "cid", "code", "shingles")
    )
    contents = cut.select("cid", "width", "places", "shingles").dropDuplicates(["cid", "width", "places"])
    held = items.select("no", F.col("no").alias("item_id"), "width", "places", "code")
    asked = cut.select("cid", "no", "width", "places", "code").distinct()
    pairs = (
        within_radius(asked, held, radius, on=("no", "width", "places"))
        .withColumnRenamed("item_id", "no")
        .join(items.drop("code"), "no")
        .join(contents.withColumnRenamed("shingles", "own"), ["cid", "width", "places"])
        .withColumn("both", weighted_overlap(F.col("own"), F.col("shingles")))
        .withColumn(
            "similarity",
            F.col("both") / (F.size("own") + F.size("shingles") - F.col("both")),
        )
        .where(F.col("similarity") >= least)
        .select("cid", "no", "width", "places", "item_words", "similarity")
    )
    best = F.struct(F.col("similarity"), (-F.col("start")).alias("back"))
    return (
        cut.drop("shingles", "code")
        .join(pairs, ["cid", "no", "width", "places"])
        .groupBy("key", "no", "item_words")
        .agg(F.max(best).alias("best"))
        .join(named.select("no", "item_id"), "no")
        .select(
            "key", "item_id", (-F.col("best.back")).cast("long").alias("start_word"),
            F.col("item_words").cast("long").alias("item_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item found in it: ``doc_id, item_id, start_word, ...``.

    Null and empty texts hold no item; repeated rows each get their rows; either table may be empty.
    """
    found = stored(leaks(docs, benchmark))
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return keyed.join(small(found), "key").drop("key")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text holds no benchmark item, columns kept."""
    (key,) = fresh(docs, "key")
    found = stored(leaks(docs, benchmark).select(F.col("key").alias(key)).distinct())
    kept = docs.withColumn(key, text_key(F.col("text"))).join(small(found), key, "left_anti")
    return kept.select(*[f"`{c}`" for c in docs.columns])


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
