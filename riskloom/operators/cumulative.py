"""Running sums and exact ranks that stay parallel whatever the key distribution.

A plain running window puts each key in one task. Here every key is cut into *cells* that follow the
order: sums inside a cell are local to the cell, and the sums of the cells before it come from a
table with one row per (key, cell). Work is therefore spread by cell, not by key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import checkpointed

CELL = "_cell"


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` range-partitioned on ``order``, with the partition number as its cell.

    Range bounds come from a sample, so the partitioned rows are written to the checkpoint folder:
    every later reader sees the same cells, also after an executor is lost.
    """
    parts = df.repartitionByRange(*order).withColumn(CELL, F.spark_partition_id())
    return checkpointed(parts)


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, str],
    *,
    cell: str = CELL,
    inclusive: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Add running sums per key along ``order``.

    ``sums`` maps output name to input column. ``order`` must be unique within a key and ``cell``
    must not fall as ``order`` rises. With ``totals`` the whole-key sum is added as ``total_<name>``.
    """
    at = [*keys, cell]
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier_cells = by_key.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    in_cell = (
        Window.partitionBy(*at)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    cells = df.groupBy(*at).agg(*[F.sum(c).alias(f"_sum_{o}") for o, c in sums.items()])
    offsets = cells.select(
        *at,
        *[
            F.coalesce(F.sum(f"_sum_{o}").over(earlier_cells), F.lit(0)).alias(f"_before_{o}")
            for o in sums
        ],
        *[F.sum(f"_sum_{o}").over(by_key).alias(f"total_{o}") for o in sums if totals],
    )
    local = df.select(
        "*",
        *[F.coalesce(F.sum(c).over(in_cell), F.lit(0)).alias(f"_local_{o}") for o, c in sums.items()],
    )
    # a NULL key is a key of its own
    offsets = offsets.toDF(*[f"_at_{k}" for k in at], *offsets.columns[len(at) :])
    same = reduce(lambda x, y: x & y, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_at_{k}`")) for k in at])
    return local.join(offsets, same).select(
        *df.columns,
        *[(F.col(f"_local_{o}") + F.col(f"_before_{o}")).alias(o) for o in sums],
        *[f"total_{o}" for o in sums if totals],
    )


#: Buckets a range is cut into in each round, and rows of a range that are listed instead.
BUCKETS, LISTED_ROWS, ROUNDS = 1024, 20_000, 8
#: Keys up to which ranges travel through the driver.
SELECTED_KEYS = 10_000


@dataclass(frozen=True)
class _Range:
    """Values of a key from ``lo`` to ``hi`` (None: all): ``n`` rows, ``before`` smaller ones."""

    key: tuple
    lo: float | None
    hi: float | None
    least: float | None  # smallest and largest finite value
    most: float | None
    n: int
    before: int


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float]
) -> DataFrame:
    """Continuous (linearly interpolated) percentiles per key, exact, by distributed selection.

    Each round counts a key's values in the buckets of a range and goes on with the bucket that holds
    the wanted rank, cut anew between its smallest and largest value; a bucket of few rows is listed.
    What is shuffled are bucket counts, whatever the number of rows. NULL is left out, NaN is the
    largest value. The table is read once a round (three or four times), so it should be a stored one.
    """
    spark = df.sparkSession
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.lit(0).alias("_all"), F.col(value).cast("double").alias("_value")
    )
    by = [*keys, "_all"]
    finite = ~F.isnan("_value") & (F.abs("_value") < float("inf"))
    known = F.when(finite, F.col("_value"))
    sizes = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.min(known).alias("lo"), F.max(known).alias("hi")
    )
    sizes = sizes.limit(SELECTED_KEYS + 1).collect()
    if len(sizes) > SELECTED_KEYS:
        return percentiles_by_rank(df, keys, value, points)

    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    bounds = ", ".join(f"{n} double" for n in ("_lo", "_hi", "_least", "_most"))
    table_schema = T.StructType([*fields, *T._parse_datatype_string(f"_all int, _range int, {bounds}, _ranks array<bigint>")])

    def inside(ranges: list[tuple[_Range, list[int]]]) -> tuple[DataFrame, DataFrame]:
        """Rows of the ranges (those of a key do not overlap), and the ranges as a small table."""
        lines = [
            (*r.key, 0, i, r.lo, r.hi, r.least, r.most, [k - r.before for k in ranks])
            for i, (r, ranks) in enumerate(ranges)
        ]
        table = spark.createDataFrame(lines, table_schema).toDF(
            *[f"_of_{k}" for k in by], *table_schema.names[len(by) :]
        )
        table = F.broadcast(table)
        same = reduce(
            lambda x, y: x & y, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in by]
        )
        within = F.col("_lo").isNull() | F.col("_value").between(F.col("_lo"), F.col("_hi"))
        return rows.join(table.drop("_ranks"), same & within), table.select("_range", "_ranks")

    open_: list[tuple[_Range, list[int]]] = []
    values: dict[tuple, float] = {}
    for r in sizes:
        key = tuple(r[k] for k in keys)
        ranks = sorted({f(p * (r["n"] - 1)) for p in points.values() for f in (math.floor, math.ceil)})
        open_.append((_Range(key, None, None, r["lo"], r["hi"], r["n"], 0), ranks))

    for _ in range(ROUNDS):
        large = [(r, ranks) for r, ranks in open_ if r.n > LISTED_ROWS]
        if not large:
            break
        open_ = [(r, ranks) for r, ranks in open_ if r.n <= LISTED_ROWS]
        open_ += _narrowed(inside, large, values)
    if any(r.n > LISTED_ROWS for r, _ in open_):
        return percentiles_by_rank(df, keys, value, points)
    _listed(inside, open_, values)

    out = []
    for r in sizes:
        key, line = tuple(r[k] for k in keys), []
        for p in points.values():
            rank = p * (r["n"] - 1)
            low, high = values[key, math.floor(rank)], values[key, math.ceil(rank)]
            line.append(low + (high - low) * (rank - math.floor(rank)) if low != high else low)
        out.append((*key, *line))
    return spark.createDataFrame(out, T.StructType([*fields, *(T.StructField(n, T.DoubleType()) for n in points)]))


def _bucket() -> Column:
    """A bucket number that never falls as the value rises; infinities and NaN have their own."""
    v, least, most = F.col("_value"), F.col("_least"), F.col("_most")
    part = (v / 2 - least / 2) / (most / 2 - least / 2)
    spread = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1))
    return (
        F.when(F.isnan(v), F.lit(BUCKETS + 1))
        .when(v == float("inf"), F.lit(BUCKETS))
        .when(v == float("-inf"), F.lit(-1))
        .otherwise(F.when(most > least, spread).otherwise(F.lit(0)))
        .cast("int")
    )


def _holding(counted: DataFrame, order: str, ranks: DataFrame) -> list:
    """The counted groups that hold a wanted rank, with the rows up to and including them."""
    upto = F.sum("n").over(Window.partitionBy("_range").orderBy(order))
    hit = F.exists("_ranks", lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))
    return counted.withColumn("upto", upto).join(ranks, "_range").where(hit).collect()


def _narrowed(inside, large: list[tuple[_Range, list[int]]], values: dict[tuple, float]) -> list:
    """The buckets that hold the wanted ranks; buckets of one value give the values of their ranks."""
    rows, ranks_of = inside(large)
    counted = rows.groupBy("_range", _bucket().alias("_bucket")).agg(
        F.count("*").alias("n"), F.min("_value").alias("lo"), F.max("_value").alias("hi")
    )
    out = []
    for b in _holding(counted, "_bucket", ranks_of):
        r, ranks = large[b["_range"]]
        before = r.before + b["upto"] - b["n"]
        mine = [k for k in ranks if before <= k < before + b["n"]]
        if b["lo"] == b["hi"] or math.isnan(b["lo"]):
            values.update({(r.key, k): b["lo"] for k in mine})
        else:
            out.append((_Range(r.key, b["lo"], b["hi"], b["lo"], b["hi"], b["n"], before), mine))
    return out


def _listed(inside, small: list[tuple[_Range, list[int]]], values: dict[tuple, float]) -> None:
    """Values at the wanted ranks of small ranges, from counts of their values."""
    if not small:
        return
    rows, ranks_of = inside(small)
    counted = rows.groupBy("_range", "_value").agg(F.count("*").alias("n"))
    for b in _holding(counted, "_value", ranks_of):
        r, ranks = small[b["_range"]]
        first = r.before + b["upto"] - b["n"]
        values.update({(r.key, k): b["_value"] for k in ranks if first <= k < first + b["n"]})


def percentiles_by_rank(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float]
) -> DataFrame:
    """The same percentiles for any number of keys: all values are ranked, by running counts over cells."""
    counts = (
        df.where(F.col(value).isNotNull())
        .select(*keys, F.col(value).cast("double").alias("_value"))
        .groupBy(*keys, "_value")
        .agg(F.count("*").alias("_n"))
    )
    ranked = running_sums(
        ranged(counts, [*keys, "_value"]), keys, "_value", {"_upto": "_n"}, totals=True
    )

    def at_rank(rank):
        held = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(held, F.col("_value")))

    picked = []
    for name, p in points.items():
        rank = (F.col("total__upto") - 1) * F.lit(float(p))
        picked += [
            at_rank(F.floor(rank)).alias(f"_lo_{name}"),
            at_rank(F.ceil(rank)).alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_part_{name}"),
        ]
    grouped = ranked.groupBy(*keys).agg(*picked)
    return grouped.select(
        *keys,
        *[
            F.expr(
                f"CASE WHEN _lo_{name} = _hi_{name} THEN _lo_{name} "
                f"ELSE _lo_{name} + (_hi_{name} - _lo_{name}) * _part_{name} END"
            ).alias(name)
            for name in points
        ],
    )


def join_all(frames: list[DataFrame], keys: list[str], how: str = "inner") -> DataFrame:
    """Join frames that share unique keys."""
    return reduce(lambda left, right: left.join(right, keys, how), frames)
