"""Extraction, lookups, summaries and rankings over transaction and score tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.cumulative import exact_percentiles
from riskloom.operators.trailing import BROADCAST_KEYS, FRAME_ROWS, count, statistic, trailing
from riskloom.session import checkpointed

# --- extraction and joins ---------------------------------------------------------------------


def unscored(txns: DataFrame, scores: DataFrame) -> DataFrame:
    return txns.join(scores.select("transaction_id"), "transaction_id", "left_anti")


def oldest(rows: DataFrame, batch_size: int) -> DataFrame:
    """The first ``batch_size`` rows by time and id: each partition's first, then the first of those."""
    return rows.orderBy("timestamp", "transaction_id").limit(batch_size)


def extract_unscored_batch(
    txns: DataFrame, scores: DataFrame, batch_size: int = 10_000, data_source: str | None = None
) -> DataFrame:
    """The oldest rows without a score, with every column, at most ``batch_size`` of them.

    The source filter is only there when asked for, so it reaches the scan. Both tables are read and
    shuffled whole; :class:`riskloom.sources.pending.PendingTables` reads what a batch needs.
    """
    rows = txns if data_source is None else txns.where(F.col("data_source") == data_source)
    return oldest(unscored(rows, scores), batch_size)


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The incoming rows to append: one per key, none whose key the target already has."""
    return incoming.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def insert_written_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """What ``insert_if_absent`` returns, for a written ``incoming``, which may be read twice.

    The keys alone are counted first. Rows are moved only for keys that repeat or are known: without
    any the result is ``incoming`` itself, few of them are sent to the rows.
    """
    mine = incoming.select(*keys, F.lit(1).alias("_mine"), F.lit(0).alias("_known"))
    theirs = target.select(*keys, F.lit(0).alias("_mine"), F.lit(1).alias("_known")).na.drop(subset=keys)
    counted = mine.unionByName(theirs).groupBy(*keys).agg(F.sum("_mine").alias("_mine"), F.max("_known").alias("_known"))
    odd = counted.where("_mine > 0 AND (_mine > 1 OR _known = 1)")
    odd = checkpointed(odd.select(*[F.col(k).alias(f"_{k}") for k in keys], "_known"))
    n, repeated = odd.agg(F.count("*"), F.count(F.when(F.col("_known") == 0, 1))).first()
    if not n:
        return incoming

    def met(rows: DataFrame, few: bool, how: str) -> DataFrame:
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        return incoming.join(F.broadcast(rows) if few else rows, same, how)

    out = met(odd, n <= BROADCAST_KEYS, "left_anti")
    if repeated:
        once = met(odd.where("_known = 0"), repeated <= BROADCAST_KEYS, "left_semi")
        out = out.unionByName(once.dropDuplicates(keys))
    return out


def flagged_transactions(txns: DataFrame, scores: DataFrame) -> DataFrame:
    """Flagged scores with their transaction, newest first."""
    flagged = scores.where("is_flagged")
    reasons = F.col("reason_codes") if "reason_codes" in scores.columns else F.lit(None).cast("string")
    return (
        txns.join(flagged, "transaction_id")
        .select(
            "transaction_id",
            "timestamp",
            "amount",
            "merchant_id",
            "merchant_category",
            "card_id",
            "is_online",
            "ensemble_score",
            "rule_score",
            "isolation_forest_score",
            "autoencoder_score",
            reasons.alias("reason_codes"),
            "scored_at",
            "batch_id",
            F.col("is_fraud").alias("ground_truth"),
        )
        .orderBy(F.desc("scored_at"), "transaction_id")
    )


def with_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with ``is_fraud``, joined only when they do not carry it already."""
    if "is_fraud" in predictions.columns or "is_fraud" not in labels.columns:
        return predictions
    return predictions.join(labels.select("transaction_id", "is_fraud"), "transaction_id", "left")


def card_velocity(
    txns: DataFrame,
    requests: DataFrame,
    window_hours: int = 24,
    *,
    strategy: str = "auto",
    limit: int = FRAME_ROWS,
) -> DataFrame:
    """Point-in-time card velocity for a table of (request_id, card_id, reference_time).

    Requests and transactions share one time line per card, so the window is a trailing window and
    no request-by-transaction pairs are formed. Only facts of the asked cards, between the first
    window's start and the last request, enter it. Requests without history get zeros.
    """
    first, last = requests.agg(F.min("reference_time"), F.max("reference_time")).first()
    reach = F.lit(first).cast("timestamp") - F.expr(f"INTERVAL {int(window_hours)} HOURS")
    inside = (F.col("timestamp") >= reach) & (F.col("timestamp") < F.lit(last).cast("timestamp"))
    asked = requests.where(F.col("card_id").isNotNull()).select("card_id").distinct()
    facts = txns.where(inside).join(asked, "card_id", "left_semi").select(
        F.col("transaction_id").alias("_row"),
        "card_id",
        F.col("timestamp").alias("_at"),
        "amount",
        "merchant_id",
        "billing_country",
        F.lit(True).alias("_fact"),
    )
    asks = requests.select(
        F.concat(F.lit("?"), F.col("request_id")).alias("_row"),
        "card_id",
        F.col("reference_time").alias("_at"),
        F.lit(None).cast(txns.schema["amount"].dataType).alias("amount"),
        F.lit(None).cast("string").alias("merchant_id"),
        F.lit(None).cast("string").alias("billing_country"),
        F.lit(False).alias("_fact"),
    )
    measures = [
        count("txn_count_window", window_hours),
        statistic("sum", "total_amount_window", "amount", window_hours),
        statistic("mean", "avg_amount_window", "amount", window_hours),
        statistic("distinct", "distinct_merchants", "merchant_id", window_hours),
        statistic("distinct", "distinct_countries", "billing_country", window_hours),
    ]
    line = trailing(
        facts.unionByName(asks),
        "card_id",
        measures,
        history="_fact",
        strategy=strategy,
        limit=limit,
        ts="_at",
        row_id="_row",
    )
    return line.where(~F.col("_fact")).select(
        F.expr("substring(_row, 2)").alias("request_id"),
        "card_id",
        F.col("_at").alias("reference_time"),
        *[m.name for m in measures],
    )


# --- summaries --------------------------------------------------------------------------------


def totals_by_label(txns: DataFrame, data_source: str | None = "SYNTHETIC") -> DataFrame:
    rows = txns if data_source is None else txns.where(F.col("data_source") == data_source)
    return rows.groupBy("is_fraud").agg(
        F.count("*").alias("count"),
        F.avg(F.col("amount").cast("double")).alias("avg_amount"),
        F.max(F.col("amount").cast("double")).alias("max_amount"),
    )


def batch_summary(
    scores: DataFrame, *, approximate: bool = False, live: bool = False
) -> DataFrame:
    """One row per scoring batch, newest first.

    Median and p95 are exact by default: a batch of any size is ranked over cells. The approximate
    form answers in the same single pass as the other columns. ``live`` is for views, which must
    follow their table: exact too, it counts each batch's distinct scores, at most 10,001 since
    the scoring table keeps four decimals.
    """
    score = F.col("ensemble_score").cast("double")
    points = {"median_score": 0.5, "p95_score": 0.95}
    plain = [
        F.min("scored_at").alias("batch_start"),
        F.max("scored_at").alias("batch_end"),
        F.count("*").alias("total_scored"),
        F.sum(F.col("is_flagged").cast("bigint")).alias("total_flagged"),
        F.avg(score).alias("avg_score"),
    ]
    if approximate:
        plain += [F.percentile_approx(score, p, 100_000).alias(n) for n, p in points.items()]
    if live:
        plain += [F.percentile(score, p).alias(n) for n, p in points.items()]
    out = scores.groupBy("batch_id").agg(*plain)
    if not (approximate or live):
        out = out.join(exact_percentiles(scores, ["batch_id"], "ensemble_score", points), "batch_id", "left")
    return out.orderBy(F.desc("batch_start"))


def batch_statistics(scored: DataFrame) -> DataFrame:
    """Size, flag rate, mean, maximum and exact p95 of a scored batch, as one row."""
    score = F.col("ensemble_score").cast("double")
    flagged = F.col("is_flagged").cast("bigint")
    plain = scored.agg(
        F.count("*").alias("total"),
        F.coalesce(F.sum(flagged), F.lit(0)).alias("flagged"),
        F.avg(flagged.cast("double")).alias("flag_rate"),
        F.avg(score).alias("mean_score"),
        F.max(score).alias("max_score"),
    )
    p95 = exact_percentiles(scored, [], "ensemble_score", {"p95_score": 0.95})
    return plain.select("*", p95.scalar().alias("p95_score"))


def dataset_statistics(txns: DataFrame, *, sample: float | None = None) -> DataFrame:
    """Size, fraud rate, cards, time span and amount distribution of a transaction table.

    With ``sample`` the numbers come from that share of the ids and counts are scaled up.
    """
    from riskloom.operators.sampling import hash_sample

    rows = txns if sample is None else hash_sample(txns, sample)
    scale = 1.0 if sample is None else 1.0 / sample
    amount = F.col("amount").cast("double")

    def scaled(n):
        return F.round(n * F.lit(scale)).cast("bigint")

    plain = rows.agg(
        scaled(F.count("*")).alias("total_transactions"),
        F.avg(F.col("is_fraud").cast("double")).alias("fraud_rate"),
        scaled(F.count_distinct("card_id")).alias("unique_cards"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
        F.avg(amount).alias("amount_mean"),
        F.stddev_samp(amount).alias("amount_std"),
        F.min(amount).alias("amount_min"),
        F.max(amount).alias("amount_max"),
    )
    median = exact_percentiles(rows, [], "amount", {"amount_median": 0.5})
    return plain.select("*", median.scalar().alias("amount_median"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count().orderBy(F.desc("count"), column)


def generation_summary(txns: DataFrame) -> DataFrame:
    fraud = F.col("is_fraud").cast("bigint")
    return txns.agg(
        F.count("*").alias("total_transactions"),
        F.sum(fraud).alias("fraud_transactions"),
        F.avg(fraud.cast("double")).alias("fraud_rate"),
        F.count_distinct("card_id").alias("unique_cards"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )


# --- filters and rankings ---------------------------------------------------------------------


def flagged_only(scores: DataFrame) -> DataFrame:
    return scores.where("is_flagged")


def alerts(scores: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Scores strictly above the alert threshold, with what an alert carries."""
    carried = ["transaction_id", "ensemble_score"]
    if "reason_codes" in scores.columns:
        carried.append("reason_codes")
    return scores.where(F.col("ensemble_score") > threshold).select(*carried)


def top_flagged(scored: DataFrame, n: int = 5) -> DataFrame:
    """The n highest flagged scores with their first two reasons."""
    out = scored.where("is_flagged").orderBy(F.desc("ensemble_score"), "transaction_id").limit(n)
    wanted = ["transaction_id", "ensemble_score", "amount", "is_fraud"]
    columns = [c for c in wanted if c in scored.columns]
    if "reasons" in scored.columns:
        texts = F.transform("reasons", lambda r: r["reason"])
        columns.append(F.concat_ws("; ", F.slice(texts, 1, 2)).alias("top_reasons"))
    return out.select(*columns)


def recent_failures(audit: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    since = F.lit(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return audit.where((F.col("status") == "FAILED") & (F.col("timestamp") >= since)).orderBy(
        F.desc("timestamp"), "operation", "batch_id"
    )


def batch_history(audit: DataFrame, batch_id: str) -> DataFrame:
    return audit.where(F.col("batch_id") == batch_id).orderBy("timestamp", "operation", "status")


def latest(audit: DataFrame, n: int = 10) -> DataFrame:
    return audit.orderBy(F.desc("timestamp"), "operation", "batch_id", "status").limit(n)


def top_per_row(pairs: list[tuple[str, Column]], k: int) -> Column:
    """The k largest of named values in a row, as (feature, value); ties: the later column first."""
    entries = F.array(
        *[
            F.struct(
                value.cast("double").alias("value"),
                F.lit(i).alias("position"),
                F.lit(name).alias("feature"),
            )
            for i, (name, value) in enumerate(pairs)
        ]
    )
    # structs compare field by field, so a descending sort is by value, then by column position
    return F.slice(F.sort_array(entries, asc=False), 1, k)
