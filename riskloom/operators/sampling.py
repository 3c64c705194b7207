"""Samples and splits that depend on row ids only, not on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash32

_BUCKETS = 4096


def hash_sample(
    df: DataFrame, fraction: float, *, seed: int = 42, row_id: str = "transaction_id"
) -> DataFrame:
    """Rows whose id hashes below ``fraction`` of the hash range."""
    limit = int(fraction * 4294967296)
    return df.where(hash32(F.lit(str(seed)), row_id) < limit)


def stratified_split(
    df: DataFrame,
    test_size: float = 0.2,
    *,
    label: str | None = "is_fraud",
    seed: int = 42,
    row_id: str = "transaction_id",
) -> DataFrame:
    """Add ``is_test``: exactly round(n * test_size) rows of every label class are true.

    The test rows of a class are those with the lowest hash. Counts per hash bucket, then per hash
    inside the bucket that holds the cut, tell the hash where the class is cut. All rows but those
    with exactly that hash are then decided by a comparison; only these few are ranked.
    """
    label_text = F.coalesce(F.col(label).cast("string"), F.lit("")) if label else F.lit("")
    hashed = df.withColumns({"_stratum": label_text, "_hash": hash32(F.lit(str(seed)), row_id)})
    width = 4294967296 // _BUCKETS
    in_order = Window.partitionBy("_stratum").orderBy("_at")
    before = F.coalesce(
        F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )

    def holding_the_cut(sizes: DataFrame) -> DataFrame:
        """The first value of ``_at`` whose rows reach what is wanted, and what is wanted of it."""
        left = F.col("_wanted") - before
        reached = sizes.select("_stratum", "_at", "_n", left.alias("_rest"))
        return reached.where((F.col("_rest") > 0) & (F.col("_rest") <= F.col("_n")))

    sizes = hashed.groupBy("_stratum", F.floor(F.col("_hash") / width).alias("_at")).agg(
        F.count("*").alias("_n")
    )
    total = F.sum("_n").over(Window.partitionBy("_stratum"))
    sizes = sizes.withColumn("_wanted", F.floor(total * F.lit(test_size) + 0.5))
    bucket = holding_the_cut(sizes).select(
        "_stratum", F.col("_at").alias("_bucket"), F.col("_rest").alias("_wanted")
    )
    inside = (
        hashed.join(F.broadcast(bucket), "_stratum")  # one row per label class
        .where(F.floor(F.col("_hash") / width) == F.col("_bucket"))
        .groupBy("_stratum", "_wanted", F.col("_hash").alias("_at"))
        .agg(F.count("*").alias("_n"))
    )
    cuts = holding_the_cut(inside).select("_stratum", F.col("_at").alias("_cut"), "_rest")
    marked = hashed.join(F.broadcast(cuts), "_stratum", "left")
    tie = F.coalesce(F.col("_hash") == F.col("_cut"), F.lit(False))
    place = F.row_number().over(Window.partitionBy("_stratum").orderBy(row_id))
    clear = marked.where(~tie).withColumn(
        "is_test", F.coalesce(F.col("_hash") < F.col("_cut"), F.lit(False))
    )
    tied = marked.where(tie).withColumn("is_test", place <= F.col("_rest"))
    return clear.union(tied).select(*df.columns, "is_test")


def split_summary(split: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Size and fraud rate of each side."""
    return split.groupBy("is_test").agg(
        F.count("*").alias("rows"), F.avg(F.col(label).cast("double")).alias("fraud_rate")
    )
