"""Entity features as of a time, and the rules that remove data again."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import checkpointed

# Stored windows in hours, and entity types with their key column.
STORE_WINDOWS = {"1H": 1, "24H": 24, "7D": 168, "30D": 720}
ENTITY_COLUMNS = {"CARD": "card_id", "MERCHANT": "merchant_id", "CUSTOMER": "customer_id"}

# Days that rows are kept, by table.
RETENTION_DAYS = {
    "transactions": 730,
    "scoring_results": 730,
    "audit_log": 2555,
    "validation_results": 90,
    "drift_reports": 365,
    "feature_store": 30,
}


_DAY_US = 86_400_000_000


def materialise(txns: DataFrame, as_of: datetime, *, valid_hours: int = 24) -> DataFrame:
    """One row per (entity type, entity, window) with the window's features in a map.

    A transaction becomes one row per entity; the windows are conditional aggregates of the same
    group, so a busy entity sends one partial row per task and windows multiply nothing.
    """
    longest = max(STORE_WINDOWS.values())
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("timestamp")) / 3.6e9
    recent = txns.where(
        (F.col("timestamp") >= F.lit(as_of - timedelta(hours=longest)))
        & (F.col("timestamp") < F.lit(as_of))
    )
    entities = F.array(
        *[
            F.struct(F.lit(kind).alias("entity_type"), F.col(c).alias("entity_id"))
            for kind, c in ENTITY_COLUMNS.items()
            if c in txns.columns
        ]
    )
    amount = F.col("amount").cast("double")
    long = recent.select(
        amount.alias("amount"), age.alias("age"), F.explode(entities).alias("e")
    ).where("e.entity_id IS NOT NULL")
    aggregates = []
    for w, h in STORE_WINDOWS.items():
        inside = F.col("age") <= float(h)
        aggregates += [
            F.count(F.when(inside, 1)).alias(f"n_{w}"),
            F.sum(F.when(inside, F.col("amount"))).alias(f"total_{w}"),
            F.avg(F.when(inside, F.col("amount"))).alias(f"mean_{w}"),
            F.max(F.when(inside, F.col("amount"))).alias(f"largest_{w}"),
        ]
    windows = F.array(
        *[
            F.struct(
                F.lit(w).alias("feature_window"),
                F.col(f"n_{w}").cast("double").alias("n"),
                *[F.col(f"{x}_{w}").alias(x) for x in ("total", "mean", "largest")],
            )
            for w in STORE_WINDOWS
        ]
    )
    grouped = (
        long.groupBy("e.entity_type", "e.entity_id")
        .agg(*aggregates)
        .select("entity_type", "entity_id", F.explode(windows).alias("w"))
        .select("entity_type", "entity_id", "w.*")
        .where("n > 0")
    )
    features = F.create_map(
        F.lit("txn_count"), F.col("n"),
        F.lit("amount_sum"), F.col("total"),
        F.lit("amount_mean"), F.col("mean"),
        F.lit("amount_max"), F.col("largest"),
    )
    return grouped.select(
        "entity_type",
        "entity_id",
        "feature_window",
        features.alias("features"),
        F.lit(as_of).cast("timestamp").alias("computed_at"),
        F.lit(as_of + timedelta(hours=valid_hours)).cast("timestamp").alias("valid_until"),
    )


def write_store(store: DataFrame, path: str) -> None:
    """Replace the (entity type, window) partitions that ``store`` holds."""
    store.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "entity_type", "feature_window"
    ).parquet(path)


def valid_features(store: DataFrame, at: datetime) -> DataFrame:
    return store.where(F.col("valid_until").isNull() | (F.col("valid_until") >= F.lit(at)))


def lookup(
    txns: DataFrame, store: DataFrame, at: datetime, *, entity_type: str = "CARD", window: str = "24H"
) -> DataFrame:
    """Transactions with the valid stored features of one entity type and window."""
    key = ENTITY_COLUMNS[entity_type]
    valid = valid_features(store, at).where(
        (F.col("entity_type") == entity_type) & (F.col("feature_window") == window)
    )
    return txns.join(valid.select(F.col("entity_id").alias(key), "features"), key, "left")


def lookup_as_of(
    txns: DataFrame, store: DataFrame, *, entity_type: str = "CARD", window: str = "24H", ts: str = "timestamp"
) -> DataFrame:
    """Transactions with the features that were the newest stored ones at each transaction's own time.

    Stored rows and transactions share one time line per key; a transaction takes the last stored row
    at or before it, if that is still valid then (``valid_until`` included, NULL: without end). The
    line is cut into days: inside a day the last stored row is a running one, before it comes the last
    of the earlier days from a table with one row per key and day. So no pairs are formed, and a busy
    key is spread over its days. Transactions without key or time get no features.
    """
    key = ENTITY_COLUMNS[entity_type]
    wanted = (F.col("entity_type") == entity_type) & (F.col("feature_window") == window)
    kept = F.struct("features", "computed_at", "valid_until")
    stored = store.where(wanted & F.col("entity_id").isNotNull()).select(
        F.col("entity_id").alias("_key"), F.unix_micros("computed_at").alias("_us"), F.lit(0).alias("_asks"), kept.alias("_held")
    )
    line = txns.withColumns(
        {"_key": F.col(key), "_us": F.unix_micros(F.col(ts).cast("timestamp")), "_asks": F.lit(1)}
    ).unionByName(stored, allowMissingColumns=True)
    line = line.withColumn("_day", F.floor(F.col("_us") / F.lit(_DAY_US)))

    days = line.groupBy("_key", "_day").agg(F.max_by("_held", F.when(F.col("_asks") == 0, F.col("_us"))).alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select("_key", "_day", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))

    # keyless rows have no line; a hash spreads them
    spread = F.when(F.col("_key").isNull(), F.xxhash64("transaction_id")).otherwise(F.lit(0))
    inside = Window.partitionBy("_key", "_day", "_apart").orderBy("_us", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_apart", spread).withColumn("_now", F.last("_held", ignorenulls=True).over(inside))
    out = found.where("_asks = 1").join(before, ["_key", "_day"], "left")
    newest = F.when(F.col("_key").isNotNull() & F.col("_us").isNotNull(), F.coalesce("_now", "_before"))
    out = out.withColumn("_newest", newest)
    valid = F.col("_newest.valid_until").isNull() | (F.unix_micros("_newest.valid_until") >= F.col("_us"))
    return out.select(
        *[f"`{c}`" for c in txns.columns],
        F.when(valid, F.col("_newest.features")).alias("features"),
        F.when(valid, F.col("_newest.computed_at")).alias("computed_at"),
    )


def retained(df: DataFrame, table: str, as_of: datetime, *, time_column: str = "timestamp") -> DataFrame:
    """The rows of a table its retention period still covers."""
    since = as_of - timedelta(days=RETENTION_DAYS[table])
    return df.where(F.col(time_column) >= F.lit(since))


def erased(df: DataFrame, requests: DataFrame, *, key: str = "transaction_id") -> DataFrame:
    """The table without the rows whose id is on the erasure list."""
    return df.join(requests.select(key), key, "left_anti")


# --- stored tables ----------------------------------------------------------------------------
#
# Tables are Parquet folders partitioned by a date column. Only partitions that lose rows are
# touched: whole ones are removed, others rewritten from a copy in the checkpoint folder.


def _remove_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    jvm = spark.sparkContext._jvm
    for value in values:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _rewrite(kept: DataFrame, path: str, column: str) -> None:
    copy = checkpointed(kept)  # the files being replaced are the ones being read
    copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def retain_stored(
    spark: SparkSession,
    path: str,
    table: str,
    as_of: datetime,
    *,
    time_column: str = "timestamp",
    date_column: str = "date",
) -> None:
    """Apply a table's retention period to its stored rows.

    Dates wholly before the period go by name, without being read; the date the period begins in is
    rewritten if it loses rows.
    """
    since = as_of - timedelta(days=RETENTION_DAYS[table])
    rows = spark.read.parquet(path)
    day = F.col(date_column).cast("date")
    old = [r[0] for r in rows.where(day < F.lit(since.date())).select(date_column).distinct().collect()]
    edge = rows.where(day == F.lit(since.date()))
    kept = edge.where(F.col(time_column) >= F.lit(since))
    if edge.where(F.col(time_column) < F.lit(since)).limit(1).count():
        if kept.limit(1).count():
            _rewrite(kept, path, date_column)
        else:
            old += [r[0] for r in edge.select(date_column).distinct().collect()]
    _remove_partitions(spark, path, date_column, old)


def erase_stored(
    spark: SparkSession,
    path: str,
    requests: DataFrame,
    *,
    key: str = "transaction_id",
    date_column: str = "date",
) -> list:
    """Remove the rows of an erasure list from a stored table; returns the dates that lost rows."""
    rows = spark.read.parquet(path)
    asked = requests.select(key).distinct()
    # one value per date that is hit
    hit = [r[0] for r in rows.select(key, date_column).join(asked, key, "left_semi").select(date_column).distinct().collect()]
    if not hit:
        return []
    kept = checkpointed(erased(rows.where(F.col(date_column).isin(hit)), asked, key=key))
    left = [r[0] for r in kept.select(date_column).distinct().collect()]
    if left:
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            date_column
        ).parquet(path)
    _remove_partitions(spark, path, date_column, [v for v in hit if v not in left])
    return hit
