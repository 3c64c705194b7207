"""Reading and writing tables: parquet, CSV, JDBC, catalog tables, score batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.relational import insert_if_absent
from riskloom.schema import SCORING_RESULTS, TRANSACTIONS, canonical_transactions, conform
from riskloom.session import checkpointed, shared_dir

# CSV text keeps microseconds and the zone.
_CSV = {"header": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on whatever file system the path names."""
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


# --- files ------------------------------------------------------------------------------------


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """A parquet transaction table in canonical form; absent columns get their defaults."""
    return canonical_transactions(spark.read.parquet(path))


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV transaction table in the canonical column order, with declared types."""
    return spark.read.schema(TRANSACTIONS).options(**_CSV).csv(path)


def write_table(df: DataFrame, path: str, *, mode: str = "fail") -> None:
    """Write to ``path``; the suffix picks the format (``.csv``, else parquet)."""
    writer = df.write.mode(_MODES[mode])
    if path.rstrip("/").endswith(".csv"):
        writer.options(**_CSV).csv(path)
    else:
        writer.parquet(path)


def stage(df: DataFrame, folder: str, name: str, batch_id: str) -> DataFrame:
    """Write a batch's intermediate table and go on from the written copy.

    A rerun of the batch replaces its own folder only. Later steps read columns from parquet instead
    of repeating the work, also after executors were lost.
    """
    path = f"{folder}/{name}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- catalog tables ---------------------------------------------------------------------------


def write_dataframe(df: DataFrame, table: str, *, if_exists: str = "append") -> int:
    """Write to a catalog table and return the rows it gained.

    The counts come from the table's file footers, so the written plan does not run a second time.
    """
    spark = df.sparkSession
    adds = if_exists == "append" and table_exists(spark, table)
    before = row_count(spark, table) if adds else 0
    df.write.mode(_MODES[if_exists]).saveAsTable(table)
    return row_count(spark, table) - before


def write_counted(df: DataFrame, path: str, *, if_exists: str = "append") -> int:
    """Write to a parquet folder and return the rows it gained."""
    spark = df.sparkSession
    before = _rows_at(spark, path, df.schema) if if_exists == "append" else 0
    df.write.mode(_MODES[if_exists]).parquet(path)
    return _rows_at(spark, path, df.schema) - before


def _rows_at(spark: SparkSession, path: str, schema: T.StructType, batch_id: str | None = None) -> int:
    if not path_exists(spark, path):
        return 0
    rows = spark.read.schema(schema).parquet(path)
    return (rows if batch_id is None else rows.where(F.col("batch_id") == batch_id)).count()


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def read_sql(spark: SparkSession, text: str, params: dict | None = None) -> DataFrame:
    """SQL text with named parameters (``:name``), bound as values."""
    return spark.sql(text, args=params or {})


def parts(df: DataFrame, rows: int) -> Iterator[DataFrame]:
    """A table as chunks of ``rows`` rows (the last may have fewer), each a DataFrame of its own.

    The plan runs once: rows are numbered on a written copy, from the row counts of its partitions,
    and written again by chunk; each chunk then reads its own folder. An empty table is one chunk.
    """
    spark = df.sparkSession
    (number, chunk), taken = ["_row", "_chunk"], {c.lower() for c in df.columns}
    while number in taken or chunk in taken:
        number, chunk = f"_{number}", f"_{chunk}"
    # a partition's rows are numbered from partition * 2^33
    kept = checkpointed(df).withColumn(number, F.monotonically_increasing_id())
    part = F.shiftright(number, 33)
    starts, total = [], 0
    for p, n in sorted(kept.groupBy(part.alias("p")).count().collect()):
        starts.append((p, total))
        total += n
    # one row per partition of the written copy
    held = spark.createDataFrame(starts, "_part long, _first long")
    kept = kept.join(F.broadcast(held), part == F.col("_part"))
    within = F.col(number).bitwiseAND((1 << 33) - 1)
    path = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    numbered = kept.withColumn(chunk, F.floor((F.col("_first") + within) / rows).cast("long"))
    numbered.select(*[f"`{c}`" for c in df.columns], chunk).write.partitionBy(chunk).parquet(path)
    for i in range(max(1, -(-total // rows))):
        yield spark.read.schema(df.schema).parquet(f"{path}/{chunk}={i}") if total else empty(spark, df.schema)


# --- JDBC -------------------------------------------------------------------------------------


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A query on a database; with a partition column several tasks read disjoint ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    if partition_column and bounds:
        reader = (
            reader.option("dbtable", f"({query}) part")
            .option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    else:
        reader = reader.option("query", query)
    return reader.options(**options).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, *, if_exists: str = "append", batch_size: int = 10_000, **options: str
) -> int:
    """Write to a database table in batches from every partition; returns the rows written.

    The rows are counted while they are written, so the plan runs once.
    """
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format("jdbc").mode(_MODES[if_exists]).option("url", url)
    writer.option("dbtable", table).option("batchsize", batch_size).options(**options).save()
    return written.get["rows"]


# --- score batches ----------------------------------------------------------------------------


def new_batch_id(at: datetime | None = None) -> str:
    """``batch_<yyyymmdd_hhmmss>_<8 hex digits>``."""
    moment = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    return f"batch_{moment}_{uuid.uuid4().hex[:8]}"


def as_scoring_results(
    results: DataFrame, batch_id: str, *, flag_threshold: float = 0.5, scored_at: datetime | None = None
) -> DataFrame:
    """Results as rows of the scoring table: stamped with batch and time, scores to four places."""
    moment = F.lit(scored_at) if scored_at else F.current_timestamp()
    stamped = (
        results.withColumn("batch_id", F.lit(batch_id))
        .withColumn("scored_at", moment)
        .withColumn("flag_threshold", F.lit(flag_threshold))
    )
    return conform(stamped, SCORING_RESULTS)


def persist_scores(
    spark: SparkSession, rows: DataFrame, path: str, *, batch_id: str | None = None
) -> int:
    """Append scores, one per (transaction_id, batch_id); returns the rows added.

    The table is partitioned by batch: when all rows belong to one ``batch_id``, naming it lets the
    look for existing rows read that partition only.
    """
    keys = ["transaction_id", "batch_id"]
    if path_exists(spark, path):
        existing = read_scores(spark, path)
        if batch_id is not None:
            existing = existing.where(F.col("batch_id") == batch_id)
        rows = insert_if_absent(existing, rows, keys)
    else:
        rows = rows.dropDuplicates(keys)
    before = _rows_at(spark, path, SCORING_RESULTS, batch_id)
    rows.write.mode("append").partitionBy("batch_id").parquet(path)
    return _rows_at(spark, path, SCORING_RESULTS, batch_id) - before


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORING_RESULTS).parquet(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
