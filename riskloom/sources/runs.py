"""Tables that grow by one small append an epoch and stay cheap to read: runs that are merged by level.

An epoch's append is a run of level 0, a folder of its own that a replay replaces. When a level has
``fan`` runs they become one run of the next level. A reader meets fewer than ``fan`` runs a level, so
the folders it lists grow with the logarithm of the epochs, and a row is rewritten once a level.

Epochs are merged only after a later one has begun, so an epoch that is replayed can still be told
from what came before it. A merged run is complete or ignored; the runs it replaces are ignored from
then on and deleted after it is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.tables import empty, path_exists

#: Days after which a last-seen table keeps only an entity's newest time.
FOLD_DAYS = 30


@dataclass(frozen=True, order=True)
class Run:
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"level{self.level}-{self.first}-{self.last}"

    def covers(self, other: "Run") -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


@dataclass
class Runs:
    """Runs of one table below ``folder``; ``partition_by`` are columns of ``schema``."""

    spark: SparkSession
    folder: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    fan: int = 8
    #: Columns whose ranges a merge deals to its files, so that a large day is many files.
    order: tuple[str, ...] = ()

    def _path(self, run: Run) -> str:
        return f"{self.folder.rstrip('/')}/{run.name}"

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self, before: int | None = None) -> list[Run]:
        """Complete runs of epochs before ``before`` that no larger run replaces, oldest first."""
        if not path_exists(self.spark, self.folder):
            return []
        path, files = self._files()
        found = []
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("level") and path_exists(self.spark, f"{self.folder}/{name}/_SUCCESS"):
                found.append(Run(*map(int, name.removeprefix("level").split("-"))))
        found = [r for r in found if before is None or r.last < before]
        return sorted((r for r in found if not any(o.covers(r) for o in found)), key=lambda r: r.first)

    def next_epoch(self) -> int:
        return max((r.last for r in self.runs()), default=-1) + 1

    def append(self, rows: DataFrame, epoch: int) -> DataFrame:
        """Write an epoch's rows, or replace them, and go on from the written copy."""
        run = Run(0, epoch, epoch)
        self._write(rows, run)
        return self._read([run])

    def _write(self, rows: DataFrame, run: Run) -> None:
        writer = rows.select(*self.schema.names).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self._path(run))

    def _read(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return empty(self.spark, self.schema)
        # partitioned folders under different roots have to be read one by one; runs are few
        read = self.spark.read.schema(self.schema).parquet
        parts = [read(self._path(r)) for r in runs] if self.partition_by else [read(*map(self._path, runs))]
        return reduce(DataFrame.unionByName, parts).select(*self.schema.names)

    def before(self, epoch: int | None = None) -> DataFrame:
        """All rows of earlier epochs (of all epochs without ``epoch``)."""
        return self._read(self.runs(epoch))

    def merge(self, epoch: int, combine: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Merge full levels of the epochs before ``epoch``; ``combine`` may reduce the rows."""
        level = 0
        while True:
            here = [r for r in self.runs(epoch) if r.level == level]
            if len(here) < self.fan:
                if not any(r.level > level for r in self.runs(epoch)):
                    break
                level += 1
                continue
            merged = Run(level + 1, here[0].first, here[-1].last)
            rows = self._read(here)
            if self.order:
                rows = rows.repartitionByRange(*self.order)
            self._write(combine(rows) if combine else rows, merged)
            level += 1
        self._drop_replaced()

    def _drop_replaced(self) -> None:
        current = self.runs()
        kept, largest = {r.name for r in current}, max((r.last for r in current if r.level), default=-1)
        if largest < 0:
            return
        path, files = self._files()
        for status in files.listStatus(path):
            name = status.getPath().getName()
            # an unfinished or replaced run of merged epochs; newer ones may be another writer's
            if name.startswith("level") and name not in kept and int(name.rsplit("-", 1)[1]) <= largest:
                files.delete(status.getPath(), True)


def history(spark: SparkSession, folder: str, schema: T.StructType, fan: int = 8) -> Runs:
    """Past transactions in runs, partitioned by ``day``; ``with_day`` prepares their rows."""
    full = T.StructType([*[f for f in schema.fields if f.name != "day"], T.StructField("day", T.DateType())])
    return Runs(spark, folder, full, ("day",), fan, ("day", "timestamp"))


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.to_date("timestamp"))


_SEEN = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


@dataclass
class LastSeen:
    """Newest time of every entity and day, below ``folder``; old days are folded to the newest one.

    Answers "when was this entity last seen before a time" without reading transactions: days before
    the asked one come from here, the asked day itself from the transactions of that day. A time
    before the folded days cannot be answered (``None``), and the caller reads the past instead.
    """

    spark: SparkSession
    folder: str
    entities: tuple[str, ...]
    fan: int = 8

    def __post_init__(self) -> None:
        self._runs = Runs(self.spark, self.folder, _SEEN, (), self.fan)
        self._answers: dict[tuple, date] = {}

    def update(self, rows: DataFrame, epoch: int) -> None:
        """Take up the rows of an epoch (a replay replaces them), after merging earlier ones."""
        self._runs.merge(epoch, self._folded)
        present = [e for e in self.entities if e in rows.columns]
        pairs = F.array(*[F.struct(F.lit(e).alias("entity"), F.col(e).cast("string").alias("key")) for e in present])
        seen = rows.select("timestamp", F.explode(pairs).alias("p")).where("p.key IS NOT NULL")
        self._runs.append(self._newest(seen.select("p.entity", "p.key", "timestamp")), epoch)

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("day", F.to_date("timestamp"))
            .groupBy("entity", "key", "day")
            .agg(F.max("timestamp").alias("timestamp"))
        )

    def _folded(self, rows: DataFrame) -> DataFrame:
        """Days up to the fold count as one: of them an entity keeps its newest time."""
        newest = rows.agg(F.max("day")).first()[0]
        if newest is None:
            return rows
        fold = F.lit(newest - timedelta(days=FOLD_DAYS))
        group = F.when(F.col("day") >= fold, F.col("day"))
        kept = rows.groupBy("entity", "key", group.alias("g")).agg(F.max("timestamp").alias("timestamp"))
        return kept.select("entity", "key", F.to_date("timestamp").alias("day"), "timestamp")

    def answers_from(self, before: int | None = None) -> date | None:
        """The first day for which everything before it is known; None: every day."""
        merged = tuple(r for r in self._runs.runs(before) if r.level)
        if not merged:
            return None
        if merged not in self._answers:
            newest = self._runs._read(list(merged)).agg(F.max("day")).first()[0]
            self._answers = {merged: (newest or date.min + timedelta(days=FOLD_DAYS)) - timedelta(days=FOLD_DAYS)}
        return self._answers[merged]

    def seen_before(self, entity: str, day: date, before: int | None = None) -> DataFrame | None:
        """``entity`` and ``timestamp``: times before ``day``, the newest of each entity among them."""
        first = self.answers_from(before)
        if first is not None and day < first:
            return None
        rows = self._runs.before(before).where((F.col("entity") == entity) & (F.col("day") < F.lit(day)))
        return rows.select(F.col("key").alias(entity), "timestamp")
