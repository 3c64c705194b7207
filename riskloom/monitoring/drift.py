"""Drift between a reference and a current feature table.

Numeric columns: two-sample Kolmogorov-Smirnov statistic with its asymptotic p-value, and the
Wasserstein-1 distance in units of the reference deviation. Categorical columns: Jensen-Shannon
distance (natural logarithm), and the chi-square statistic of the two count rows.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.cumulative import CELL, ranged, running_sums
from riskloom.schema import DRIFT_REPORTS

# The monitored features.
NUMERIC_FEATURES = [
    "amount",
    "amount_log",
    "hour_sin",
    "hour_cos",
    "card_hours_since_last",
    "card_txn_count_1h",
    "card_txn_count_24h",
    "card_amount_zscore_24h",
]
CATEGORICAL_FEATURES = [
    "is_weekend",
    "is_night",
    "suspicious_email",
    "country_mismatch",
    "high_risk_category",
    "is_online",
]

KS_LEVEL = 0.05
WASSERSTEIN_LIMIT = 0.1
JS_LIMIT = 0.1
DATASET_SHARE = 0.5
TEST_SHARE = 0.3
_TESTED_NUMERIC = 5
_SERIES_TERMS = 100


def _present(features: list[str], current: DataFrame) -> list[str]:
    return [f for f in features if f in current.columns]


def _value_counts(reference: DataFrame, current: DataFrame, features: list[str], kind: str) -> DataFrame:
    """(feature, value, rows in reference, rows in current); counted before anything is shuffled."""

    def long(df: DataFrame, is_reference: int) -> DataFrame:
        pairs = F.array(
            *[F.struct(F.lit(f).alias("feature"), F.col(f).cast(kind).alias("value")) for f in features]
        )
        return df.select(F.explode(pairs).alias("p")).select(
            "p.feature",
            "p.value",
            F.lit(is_reference).alias("_ref"),
            F.lit(1 - is_reference).alias("_cur"),
        )

    return (
        long(reference, 1)
        .unionAll(long(current, 0))
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.sum("_ref").alias("n_ref"), F.sum("_cur").alias("n_cur"))
    )


def _with_next(df: DataFrame) -> DataFrame:
    """The next larger value of the same feature, across range cells."""
    inside = Window.partitionBy("feature", CELL).orderBy("value")
    along = Window.partitionBy("feature").orderBy(CELL)
    firsts = df.groupBy("feature", CELL).agg(F.min("value").alias("_first"))
    firsts = firsts.select("feature", CELL, F.lead("_first").over(along).alias("_next_cell"))
    local = df.withColumn("_next", F.lead("value").over(inside))
    return local.join(firsts, ["feature", CELL]).withColumn("_next", F.coalesce("_next", "_next_cell"))


def numeric_drift(
    reference: DataFrame, current: DataFrame, features: list[str] | None = None, *, method: str = "ks"
) -> DataFrame:
    """Per numeric feature: KS statistic and p-value, scaled Wasserstein distance, and the verdict."""
    names = features or _present(NUMERIC_FEATURES, current)
    counts = ranged(_value_counts(reference, current, names, "double"), ["feature", "value"])
    curve = running_sums(
        counts, ["feature"], "value", {"c_ref": "n_ref", "c_cur": "n_cur"}, totals=True
    )
    gap = F.abs(
        F.try_divide(F.col("c_ref").cast("double"), F.col("total_c_ref"))
        - F.try_divide(F.col("c_cur").cast("double"), F.col("total_c_cur"))
    )
    width = F.coalesce(F.col("_next") - F.col("value"), F.lit(0.0))
    n, v = F.col("n_ref").cast("double"), F.col("value")
    distances = (
        _with_next(curve.withColumn(CELL, F.col(CELL)).withColumn("_gap", gap))
        .groupBy("feature")
        .agg(
            F.max("_gap").alias("ks_statistic"),
            F.sum(F.col("_gap") * width).alias("_w1"),
            F.max("total_c_ref").alias("n_ref"),
            F.max("total_c_cur").alias("n_cur"),
            F.try_divide(F.sum(n * v), F.sum(n)).alias("_mean"),
        )
    )
    # the reference deviation, about the mean just found
    squares = (
        counts.join(distances.select("feature", "_mean"), "feature")
        .groupBy("feature")
        .agg(F.sqrt(F.try_divide(F.sum(n * (v - F.col("_mean")) ** 2), F.sum(n))).alias("_std"))
    )
    size = F.try_divide(F.col("n_ref").cast("double") * F.col("n_cur"), F.col("n_ref") + F.col("n_cur"))
    lam = F.sqrt(size) * F.col("ks_statistic")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * F.col("_lam") ** 2),
    )
    # below 0.2 the alternating series has not converged and the true value is 1 to many digits
    p_value = F.when(F.col("_lam") < 0.2, 1.0).otherwise(
        F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    )
    out = distances.join(squares, "feature").withColumn("_lam", lam)
    out = out.select(
        "feature",
        "ks_statistic",
        p_value.alias("p_value"),
        F.try_divide(F.col("_w1"), F.greatest(F.col("_std"), F.lit(1e-3))).alias("wasserstein"),
    )
    verdict = F.col("p_value") < KS_LEVEL if method == "ks" else F.col("wasserstein") >= WASSERSTEIN_LIMIT
    return out.withColumn("drift_detected", verdict)


def categorical_drift(
    reference: DataFrame, current: DataFrame, features: list[str] | None = None
) -> DataFrame:
    """Per categorical feature: Jensen-Shannon distance, chi-square statistic, and the verdict."""
    names = features or _present(CATEGORICAL_FEATURES, current)
    counts = _value_counts(reference, current, names, "string")
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur")
    )
    joined = counts.join(totals, "feature")
    p = F.try_divide(F.col("n_ref").cast("double"), F.col("t_ref"))
    q = F.try_divide(F.col("n_cur").cast("double"), F.col("t_cur"))
    middle = (p + q) / 2

    def information(x):
        return F.when(x > 0, x * F.ln(x / middle)).otherwise(F.lit(0.0))

    both = (F.col("n_ref") + F.col("n_cur")).cast("double")
    everything = F.col("t_ref") + F.col("t_cur")

    def excess(n, t):
        expected = both * t / everything
        return F.coalesce(F.try_divide((n - expected) * (n - expected), expected), F.lit(0.0))

    out = joined.groupBy("feature").agg(
        F.sqrt(F.greatest(F.sum(information(p) + information(q)) / 2, F.lit(0.0))).alias("js_distance"),
        F.sum(
            excess(F.col("n_ref"), F.col("t_ref")) + excess(F.col("n_cur"), F.col("t_cur"))
        ).alias("chi_square"),
    )
    return out.withColumn("drift_detected", F.col("js_distance") >= JS_LIMIT)


def column_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, method, drift_score, drift_detected) for every monitored feature that is present."""
    parts = []
    if _present(NUMERIC_FEATURES, current):
        parts.append(
            numeric_drift(reference, current).select(
                "feature", F.lit("ks").alias("method"), F.col("p_value").alias("drift_score"), "drift_detected"
            )
        )
    if _present(CATEGORICAL_FEATURES, current):
        parts.append(
            categorical_drift(reference, current).select(
                "feature",
                F.lit("jensenshannon").alias("method"),
                F.col("js_distance").alias("drift_score"),
                "drift_detected",
            )
        )
    if not parts:
        raise ValueError("no monitored feature in the current table")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def dataset_drift(columns: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """Number and share of drifted columns, and the verdict, from :func:`column_drift`."""
    drifted = F.sum(F.col("drift_detected").cast("bigint"))
    return columns.agg(
        F.count("*").alias("n_columns"),
        drifted.alias("n_drifted_columns"),
        (drifted / F.count("*")).alias("drift_share"),
        (drifted / F.count("*") >= share).alias("drift_detected"),
    )


def drift_tests(columns: DataFrame, limit: float = TEST_SHARE) -> DataFrame:
    """The share test and the tests of the first five numeric features as (name, status, description)."""
    share = columns.agg(F.avg(F.col("drift_detected").cast("double")).alias("share")).select(
        F.lit("share_of_drifted_columns").alias("name"),
        F.when(F.col("share") < limit, "SUCCESS").otherwise("FAIL").alias("status"),
        F.format_string(f"share of drifted columns is %.3f, limit {limit}", "share").alias("description"),
    )
    single = columns.where(F.col("feature").isin(NUMERIC_FEATURES[:_TESTED_NUMERIC])).select(
        F.concat(F.lit("column_drift:"), "feature").alias("name"),
        F.when(F.col("drift_detected"), "FAIL").otherwise("SUCCESS").alias("status"),
        F.format_string("%s score is %.3f", "method", "drift_score").alias("description"),
    )
    return share.unionByName(single)


def all_passed(tests: DataFrame) -> DataFrame:
    return tests.agg(F.min((F.col("status") == "SUCCESS").cast("int")).cast("boolean").alias("all_passed"))


def detect_drift(spark: SparkSession, current: DataFrame, batch_id: str, reference_path: str) -> dict:
    """Compare with the stored reference; the first batch becomes the reference and never drifts."""
    from riskloom.sources.tables import path_exists

    if not path_exists(spark, reference_path):
        kept = _present(NUMERIC_FEATURES + CATEGORICAL_FEATURES, current)
        current.select(*kept).write.parquet(reference_path)
        return {"batch_id": batch_id, "drift_detected": False, "note": "reference data initialized"}
    columns = column_drift(spark.read.parquet(reference_path), current).collect()  # one row per feature
    drifted = [r["feature"] for r in columns if r["drift_detected"]]
    share = len(drifted) / len(columns)
    return {
        "batch_id": batch_id,
        "drift_detected": share >= DATASET_SHARE,
        "drift_share": share,
        "n_drifted_columns": len(drifted),
        "n_columns": len(columns),
        "drift_by_column": {
            r["feature"]: {
                "drift_detected": r["drift_detected"],
                "drift_score": r["drift_score"],
                "stattest": r["method"],
            }
            for r in columns
        },
    }


# --- reports as a table -----------------------------------------------------------------------


def period(df: DataFrame, time_column: str = "timestamp") -> tuple:
    """First and last time of a table; nulls where it has no such column."""
    if time_column not in df.columns:
        return None, None
    return tuple(df.agg(F.min(time_column), F.max(time_column)).first())


def store_report(
    spark: SparkSession,
    path: str,
    report: dict,
    report_type: str,
    *,
    reference_period: tuple = (None, None),
    current_period: tuple = (None, None),
    created_at: datetime | None = None,
) -> None:
    """Append a report of :func:`detect_drift` or of the performance monitor to the report table."""
    share = report.get("drift_share")
    row = (
        uuid.uuid4().hex,
        report["batch_id"],
        created_at or datetime.now(timezone.utc),
        report_type,
        *reference_period,
        *current_period,
        report.get("drift_detected"),
        None if share is None else Decimal(f"{share:.4f}"),
        json.dumps(report, default=str, sort_keys=True),
    )
    spark.createDataFrame([row], DRIFT_REPORTS).coalesce(1).write.mode("append").parquet(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DRIFT_REPORTS).parquet(path)
