"""Transactions and scores as co-located tables, so that finding unscored rows costs what a batch costs.

Both tables are partitioned by the transaction's day and bucketed by its id. The anti join of the two
then meets bucket by bucket, without an exchange, and only inside days that still hold unscored rows.
Which days those are is known from a ledger: every append writes how many rows it adds to a day and
source, every scoring how many it takes away. A late row reopens its day; the first open day is the
low-water mark.

The ledger may say that too much is pending, never too little: rows are entered before they are
written and taken off after their scores are. A writer that dies between the two leaves a day open,
which costs a look at that day and no row; ``recount`` puts the ledger right.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.relational import insert_written_if_absent, oldest, unscored
from riskloom.schema import SCORING_RESULTS, TRANSACTIONS
from riskloom.session import shared_dir
from riskloom.sources.tables import path_exists

_LEDGER = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("change", T.LongType()),
    ]
)


@dataclass
class PendingTables:
    """``<folder>/transactions``, ``<folder>/scores`` and ``<folder>/ledger``.

    ``name`` is the prefix of the two catalog tables; the folder is what lasts, so a session without
    a lasting catalog declares the tables anew. All writers must use the same ``buckets``.
    """

    spark: SparkSession
    folder: str
    name: str = "riskloom"
    buckets: int = 64

    def __post_init__(self) -> None:
        self.folder = self.folder.rstrip("/")
        for table, schema in (("transactions", TRANSACTIONS), ("scores", SCORING_RESULTS)):
            self._declare(table, schema)

    def _table(self, table: str) -> str:
        return f"{self.name}_{table}"

    def _declare(self, table: str, schema: T.StructType) -> None:
        if self.spark.catalog.tableExists(self._table(table)):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"""CREATE TABLE {self._table(table)} ({columns}, day DATE) USING parquet
            PARTITIONED BY (day) CLUSTERED BY (transaction_id) INTO {self.buckets} BUCKETS
            LOCATION '{self.folder}/{table}'"""
        )
        if path_exists(self.spark, f"{self.folder}/{table}"):
            self.spark.catalog.recoverPartitions(self._table(table))

    @property
    def transactions(self) -> DataFrame:
        return self.spark.table(self._table("transactions"))

    @property
    def scores(self) -> DataFrame:
        return self.spark.table(self._table("scores"))

    # --- ledger -------------------------------------------------------------------------------

    def _ledger(self) -> DataFrame:
        path = f"{self.folder}/ledger"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(path)

    def _enter(self, rows: DataFrame, sign: int) -> None:
        """Enter the counts of ``rows`` (day, data_source) into the ledger."""
        change = rows.groupBy("day", "data_source").agg((F.count("*") * sign).cast("long").alias("change"))
        change.coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")

    def pending(self) -> DataFrame:
        """``day, data_source, rows`` of the days that may hold unscored rows."""
        sums = self._ledger().groupBy("day", "data_source").agg(F.sum("change").alias("rows"))
        return sums.where(F.col("rows") > 0)

    def low_water_mark(self):
        """The first day with unscored rows, or None."""
        return self.pending().agg(F.min("day")).first()[0]

    def recount(self) -> None:
        """Replace the ledger by what the tables say. No other writer may be at work."""
        open_rows = unscored(self.transactions, self.scores)
        counts = open_rows.groupBy("day", "data_source").agg(F.count("*").alias("change"))
        self._replace_ledger(counts)

    def _replace_ledger(self, counts: DataFrame) -> None:
        fixed = self.spark.createDataFrame(counts.select(*_LEDGER.names).collect(), _LEDGER)
        fixed.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger")

    def compact_day(self, day) -> None:
        """Rewrite a day's files as one a bucket; hourly appends leave one a bucket each.

        No other writer may be at work on the day.
        """
        for table in ("transactions", "scores"):
            name = self._table(table)
            rows = self._handed_over(self.spark.table(name).where(F.col("day") == day))
            view = f"{name}_{uuid.uuid4().hex}"
            self._spread(rows, table).drop("day").createOrReplaceTempView(view)
            # the day is named in the statement, so no other day can be touched
            self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (day = DATE '{day}') SELECT * FROM {view}")
            self.spark.catalog.dropTempView(view)

    def compact_ledger(self) -> None:
        """Fold the ledger into one row a day and source. No other writer may be at work."""
        self._replace_ledger(self.pending().withColumnRenamed("rows", "change"))

    # --- writing ------------------------------------------------------------------------------

    def _handed_over(self, rows: DataFrame) -> DataFrame:
        """A written copy: its counts and its rows must not come from two runs of a plan."""
        path = f"{shared_dir(self.spark)}/pending-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _absent(self, known: DataFrame, rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
        """A written copy of the rows to append (``columns`` of them); ``rows`` itself where that is all."""
        new = insert_written_if_absent(known, rows, keys)
        return rows if new is rows else self._handed_over(new.select(*columns) if columns else new)

    def _days(self, rows: DataFrame) -> list:
        return [r[0] for r in rows.select("day").distinct().collect()]

    def add_transactions(self, rows: DataFrame) -> int:
        """Append the rows whose id their day does not have yet; returns how many."""
        dated = rows.withColumn("day", F.to_date("timestamp")).select(*TRANSACTIONS.names, "day")
        dated = self._handed_over(dated)
        known = self.transactions.where(F.col("day").isin(self._days(dated)))
        new = self._absent(known, dated, ["transaction_id"])
        self._enter(new, 1)
        self._insert(new, "transactions")
        return new.count()

    def add_scores(self, scores: DataFrame, batch: DataFrame) -> int:
        """Append the scores of ``batch``'s rows, one per id and batch; returns how many.

        ``batch`` (``transaction_id``, ``timestamp``, ``data_source``) says which days the scores are
        stored under; scores of other ids are not written. A second score of an id, from another
        batch, is kept and takes nothing off the ledger.
        """
        keys = batch.select("transaction_id", F.to_date("timestamp").alias("day"), "data_source")
        placed = self._handed_over(
            scores.join(keys.dropDuplicates(["transaction_id"]), "transaction_id")
        )
        known = self.scores.where(F.col("day").isin(self._days(placed)))
        new = self._absent(known, placed, ["transaction_id", "batch_id"])
        first = self._absent(known, new, ["transaction_id"], "day", "data_source")
        self._insert(new, "scores")
        self._enter(first, -1)
        return new.count()

    def _spread(self, rows: DataFrame, table: str) -> DataFrame:
        """One file per day and bucket: rows reach their bucket's task before they are written."""
        columns = self.spark.table(self._table(table)).columns
        return rows.select(*columns).repartition(self.buckets, "transaction_id")

    def _insert(self, rows: DataFrame, table: str) -> None:
        self._spread(rows, table).write.insertInto(self._table(table))

    # --- extraction ---------------------------------------------------------------------------

    def _open_days(self, rows: int, data_source: str | None) -> list:
        """The first open days that together hold ``rows`` pending rows, or all of them."""
        pending = self.pending()
        if data_source is not None:
            pending = pending.where(F.col("data_source") == data_source)
        days, held = [], 0
        for day, n in pending.groupBy("day").agg(F.sum("rows")).orderBy("day").collect():
            if held >= rows:
                break
            days.append(day)
            held += n
        return days

    def unscored_in(self, days: list) -> DataFrame:
        """Unscored rows of some days: joined bucket by bucket, reading those days only."""
        wanted = F.col("day").isin(days) if days else F.lit(False)
        return unscored(self.transactions.where(wanted), self.scores.where(wanted)).drop("day")

    def next_batch(self, batch_size: int = 10_000, data_source: str | None = None) -> DataFrame:
        """The oldest unscored rows, at most ``batch_size``: what ``extract_unscored_batch`` returns.

        Reads the first open days that hold enough. The ledger may count rows that were never
        written; where the days looked at fall short for that reason, all open days are read.
        """
        everything = self._open_days(1 << 62, data_source)
        days = self._open_days(batch_size, data_source)

        def candidates(days: list) -> DataFrame:
            rows = self.unscored_in(days)
            return rows if data_source is None else rows.where(F.col("data_source") == data_source)

        if len(days) < len(everything) and candidates(days).count() < batch_size:
            days = everything
        return oldest(candidates(days), batch_size)
