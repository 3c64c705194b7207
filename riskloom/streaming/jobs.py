"""Structured Streaming counterparts of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.models.ensemble import EnsembleScorer
from riskloom.models.rules import RuleScorer
from riskloom.operators.features import (
    COUNTED_ENTITIES,
    FeatureGroups,
    with_fast_features,
    with_features_after,
)
from riskloom.sources import runs, tables


def transaction_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None
) -> DataFrame:
    """New parquet files of a folder as a stream of transactions."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def rule_scores(stream: DataFrame, scorer: RuleScorer = RuleScorer()) -> DataFrame:
    """Rule score and reasons from the features that need no history: a projection, no state."""
    return scorer.score(with_fast_features(stream, keep=("transaction_id", "timestamp")))


def without_repeats(stream: DataFrame, *, delay: str = "7 days") -> DataFrame:
    """The first row of each transaction id; ids are forgotten once the watermark has passed them."""
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["transaction_id"])


def velocity_panel(
    stream: DataFrame, *, length: str = "24 hours", slide: str = "1 hour", delay: str | None = "1 hour"
) -> DataFrame:
    """Transactions per card in sliding event-time windows; counts combine before the shuffle.

    Works on batch tables too, where ``delay`` is not needed.
    """
    rows = stream.withWatermark("timestamp", delay) if delay else stream
    counted = rows.where(F.col("card_id").isNotNull()).groupBy(
        F.window("timestamp", length, slide).alias("window"), "card_id"
    )
    return counted.agg(
        F.count("*").alias("txn_count"), F.sum(F.col("amount").cast("double")).alias("amount_sum")
    ).select("card_id", F.col("window.start").alias("window_start"), "txn_count", "amount_sum")


def _features_of_epoch(
    batch: DataFrame, epoch: int, folder: str, schema: T.StructType, groups: FeatureGroups, strategy: str
) -> DataFrame:
    """Features of a micro-batch after all earlier ones, which are kept in merged runs by day.

    A replayed epoch does not see itself or later ones.
    """
    spark = batch.sparkSession
    history = runs.history(spark, f"{folder}/history", schema)
    seen = runs.LastSeen(spark, f"{folder}/last_seen", tuple(COUNTED_ENTITIES))
    history.merge(epoch)
    rows = history.append(runs.with_day(batch), epoch).select(*schema.names)
    seen.update(rows, epoch)
    return with_features_after(
        rows, history.before(epoch), groups, strategy=strategy, last_seen=seen, before=epoch, day="day"
    )


def trailing_features(
    stream: DataFrame,
    folder: str,
    groups: FeatureGroups = FeatureGroups(),
    *,
    strategy: str = "auto",
) -> StreamingQuery:
    """Exact history features of every arriving row, written to ``<folder>/features``.

    The state is a table of past rows rather than per-card operator state: a busy card would hold
    its whole week in one task's state, while a table is read back by time and split like any other.
    A micro-batch reads the days its windows reach and a last-seen table, both in runs that are
    merged, so what it lists and reads does not grow with the epochs. Its folders are named after its
    epoch, so a replay replaces its own output.
    Rows see what arrived before them; a late row does not change results already written.
    """
    schema = stream.schema

    def process(batch: DataFrame, epoch: int) -> None:
        out = _features_of_epoch(batch, epoch, folder, schema, groups, strategy)
        out.write.mode("overwrite").parquet(f"{folder}/features/epoch={epoch}")

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def incremental_scoring(
    stream: DataFrame, folder: str, scorer: EnsembleScorer, *, strategy: str = "auto"
) -> StreamingQuery:
    """Score arriving rows and append them to ``<folder>/scores``.

    The stream's checkpoint remembers which files were scored. Scores use the range frozen at fit,
    so they do not depend on how rows fall into micro-batches.
    """
    schema = stream.schema
    scorer.calibration = "fit"

    def process(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        features = _features_of_epoch(batch, epoch, folder, schema, FeatureGroups(), strategy)
        scored = scorer.results(scorer.score(features))
        batch_id = f"stream_{epoch:012d}"
        final = tables.as_scoring_results(scored, batch_id, flag_threshold=scorer.flag_threshold)
        tables.persist_scores(spark, final, f"{folder}/scores", batch_id=batch_id)

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
