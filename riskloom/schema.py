"""Table contracts: the canonical transaction table and the tables the engine writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING, _DOUBLE, _LONG, _TS, _BOOL = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.TimestampType(),
    T.BooleanType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


TRANSACTIONS = _struct(
    ("transaction_id", _STRING, False),
    ("timestamp", _TS, False),
    ("amount", T.DecimalType(18, 2), False),
    ("currency", _STRING, True),
    ("merchant_id", _STRING, False),
    ("merchant_category", _STRING, True),
    ("card_id", _STRING, False),
    ("card_type", _STRING, True),
    ("card_country", _STRING, True),
    ("customer_id", _STRING, True),
    ("device_id", _STRING, True),
    ("ip_address", _STRING, True),
    ("email_domain", _STRING, True),
    ("billing_country", _STRING, True),
    ("shipping_country", _STRING, True),
    ("is_online", _BOOL, True),
    ("product_category", _STRING, True),
    ("data_source", _STRING, False),
    ("created_at", _TS, True),
    ("is_fraud", _BOOL, True),
    ("fraud_label_source", _STRING, True),
)

#: Values a row gets when its source leaves the column out.
TRANSACTION_DEFAULTS = {"currency": "USD", "is_online": True, "data_source": "UNKNOWN"}

#: One row per report: data drift or model performance of a batch. ``metrics`` is JSON.
DRIFT_REPORTS = _struct(
    ("report_id", _STRING, False),
    ("batch_id", _STRING, False),
    ("created_at", _TS, False),
    ("report_type", _STRING, False),
    ("reference_start", _TS, True),
    ("reference_end", _TS, True),
    ("current_start", _TS, True),
    ("current_end", _TS, True),
    ("drift_detected", _BOOL, True),
    ("drift_score", T.DecimalType(5, 4), True),
    ("metrics", _STRING, True),
)

REASON = _struct(
    ("model", _STRING, True),
    ("rule", _STRING, True),
    ("feature", _STRING, True),
    ("score", _DOUBLE, True),
    ("contribution", _DOUBLE, True),
    ("reconstruction_error", _DOUBLE, True),
    ("reason", _STRING, True),
)
REASONS = T.ArrayType(REASON)

_SCORE = T.DecimalType(5, 4)

SCORING_RESULTS = _struct(
    ("transaction_id", _STRING, False),
    ("batch_id", _STRING, False),
    ("scored_at", _TS, False),
    ("ensemble_score", _SCORE, False),
    ("is_flagged", _BOOL, False),
    ("flag_threshold", _SCORE, True),
    ("rule_score", _SCORE, True),
    ("isolation_forest_score", _SCORE, True),
    ("autoencoder_score", _SCORE, True),
    ("reason_codes", _STRING, True),
    ("model_versions", _STRING, True),
)

AUDIT_LOG = _struct(
    ("timestamp", _TS, False),
    ("batch_id", _STRING, True),
    ("operation", _STRING, False),
    ("status", _STRING, False),
    ("records_processed", _LONG, True),
    ("records_flagged", _LONG, True),
    ("duration_seconds", T.DecimalType(10, 3), True),
    ("error_message", _STRING, True),
    ("metadata", _STRING, True),
    ("triggered_by", _STRING, True),
    ("source_system", _STRING, True),
)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: cast, order, and fill absent columns with their default."""
    defaults = defaults or {}
    columns = []
    for field in schema.fields:
        default = F.lit(defaults.get(field.name))
        if field.name not in df.columns:
            value = default
        elif field.name in defaults:
            value = F.coalesce(F.col(field.name), default)
        else:
            value = F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def canonical_transactions(df: DataFrame) -> DataFrame:
    """Any transaction table as the canonical one; NaN amounts become NULL."""
    if isinstance(df.schema["amount"].dataType, T.FractionalType) and not isinstance(
        df.schema["amount"].dataType, T.DecimalType
    ):
        df = df.withColumn("amount", F.nanvl("amount", F.lit(None).cast("double")))
    return conform(df, TRANSACTIONS, TRANSACTION_DEFAULTS)
