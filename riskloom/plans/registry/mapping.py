"""Queries on projections: schema mapping and the features that need no history."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.expressions import display_name
from riskloom.operators import features as feat
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import big, bit, plain, query, rnd
from riskloom.sources import external

# --- features without history -----------------------------------------------------------------

_MAILS = ", ".join(f"'{d}'" for d in feat.SUSPICIOUS_DOMAINS)
_FAST_MAILS = ", ".join(f"'{d}'" for d in feat.FAST_SUSPICIOUS_DOMAINS)
_RISKY = ", ".join(f"'{c}'" for c in feat.HIGH_RISK_CATEGORIES)
_HOUR = "extract(hour FROM timestamp)"
_DOW = "(extract(isodow FROM timestamp) - 1)"
_DAY = "extract(day FROM timestamp)"

BASE_SQL = [rnd("amount", "amount"), rnd("ln(1 + amount)", "amount_log")]
CLOCK_SQL = [
    rnd(f"sin(2 * pi() * {_HOUR} / 24)", "hour_sin"),
    rnd(f"cos(2 * pi() * {_HOUR} / 24)", "hour_cos"),
    rnd(f"sin(2 * pi() * {_DOW} / 7)", "dow_sin"),
    rnd(f"cos(2 * pi() * {_DOW} / 7)", "dow_cos"),
    bit(f"{_DOW} >= 5", "is_weekend"),
    bit(f"{_HOUR} >= 22 OR {_HOUR} <= 5", "is_night"),
]
TEMPORAL_SQL = CLOCK_SQL + [
    bit(f"{_HOUR} BETWEEN 9 AND 17 AND {_DOW} < 5", "is_business_hours"),
    big(_DAY, "day_of_month"),
    bit(f"{_DAY} <= 3", "is_month_start"),
    bit(f"{_DAY} >= 28", "is_month_end"),
]
_MISMATCH = bit("NOT coalesce(billing_country = shipping_country, false)", "country_mismatch")
_ONLINE = bit("is_online", "is_online")
_ROUND = bit("amount % 100 = 0", "is_round_amount")
_LARGE = bit("amount > 1000", "is_large_amount")
RISK_SQL = [
    bit(f"email_domain IN ({_MAILS})", "suspicious_email"),
    _MISMATCH,
    bit("NOT coalesce(card_country = billing_country, false)", "card_billing_mismatch"),
    bit(f"merchant_category IN ({_RISKY})", "high_risk_category"),
    _ONLINE,
    _ROUND,
    _LARGE,
    bit("amount > 5000", "is_very_large_amount"),
]
FAST_SQL = BASE_SQL + CLOCK_SQL + [
    bit(f"email_domain IN ({_FAST_MAILS})", "suspicious_email"),
    _ONLINE,
    _ROUND,
    _LARGE,
    _MISMATCH,
]


def _over_txn(columns: list[str]) -> str:
    return f"SELECT transaction_id, {', '.join(columns)} FROM txn"


def _select(t: Tables, columns: dict):
    return plain(t.txn.select("transaction_id", *[c.alias(n) for n, c in columns.items()]))


@query("b9_base_features", _over_txn(BASE_SQL), ("txn",))
def _(t: Tables):
    return _select(t, feat.base_columns())


@query("b10_temporal", _over_txn(TEMPORAL_SQL), ("txn",))
def _(t: Tables):
    return _select(t, feat.temporal_columns())


@query("b11_risk_indicators", _over_txn(RISK_SQL), ("txn",))
def _(t: Tables):
    return _select(t, feat.risk_columns(t.txn.columns))


@query("b12_fast_features", _over_txn(FAST_SQL), ("txn",))
def _(t: Tables):
    return plain(feat.with_fast_features(t.txn))


@query(
    "b13_fill_missing",
    "SELECT transaction_id, round(coalesce(amount, 0), 6) AS amount, "
    + rnd("coalesce(CASE WHEN amount > -1 THEN ln(1 + amount) END, 0)", "amount_log")
    + " FROM dq_txn",
    ("dq_txn",),
)
def _(t: Tables):
    columns = feat.base_columns()
    rows = t.dq_txn.select("transaction_id", *[c.alias(n) for n, c in columns.items()])
    return plain(rows.na.fill(0, subset=list(columns)))


@query("b14_feature_groups", _over_txn(BASE_SQL + RISK_SQL[:-4] + RISK_SQL[-4:]), ("txn",))
def _(t: Tables):
    groups = feat.FeatureGroups(velocity=False, aggregations=False, temporal=False)
    return plain(feat.with_features(t.txn, groups))


@query(
    "b15_display_names",
    """SELECT 'amount' AS feature, 'Transaction Amount' AS display_name, count(*) AS rows_used FROM txn
    UNION ALL SELECT 'is_night', 'Night Transaction (10pm-5am)', count(*) FROM txn
    WHERE extract(hour FROM timestamp) >= 22 OR extract(hour FROM timestamp) <= 5
    UNION ALL SELECT 'day_of_month', 'day_of_month', count(*) FROM txn""",
    ("txn",),
)
def _(t: Tables):
    used = t.txn.select(
        *[c.alias(n) for n, c in feat.base_columns().items()],
        *[c.alias(n) for n, c in feat.temporal_columns().items()],
    ).select("amount", F.nullif("is_night", F.lit(0)).alias("is_night"), "day_of_month")
    counts = used.agg(*[F.count(c).alias(c) for c in used.columns])
    long = counts.unpivot([], used.columns, "feature", "rows_used")
    return plain(long.select("feature", display_name(F.col("feature")).alias("display_name"), "rows_used"))


@query(
    "b16_model_columns",
    "SELECT transaction_id, " + ", ".join(FAST_SQL[:2]) + " FROM txn",
    ("txn",),
)
def _(t: Tables):
    matrix = t.txn.select(
        "transaction_id", "timestamp", "is_fraud", *[c.alias(n) for n, c in feat.base_columns().items()]
    )
    return plain(matrix.select("transaction_id", *feat.feature_matrix_columns(matrix)))


# --- external layout --------------------------------------------------------------------------

_EXT_SQL = """SELECT
 concat('ieee_', CAST(e.TransactionID AS VARCHAR)) AS transaction_id,
 TIMESTAMP '2017-11-30 00:00:00' + to_seconds(e.TransactionDT) AS timestamp,
 round_even(e.TransactionAmt, 2) AS amount,
 'USD' AS currency,
 concat('ieee_card_', e.card1) AS card_id,
 CASE lower(e.card4) WHEN 'visa' THEN 'VISA' WHEN 'mastercard' THEN 'MASTERCARD'
  WHEN 'american express' THEN 'AMEX' WHEN 'discover' THEN 'DISCOVER' ELSE 'UNKNOWN' END AS card_type,
 CASE WHEN e.addr2 = 87 THEN 'USA' WHEN e.addr2 = 60 THEN 'CAN' ELSE 'OTHER' END AS billing_country,
 CASE WHEN e.addr2 = 87 THEN 'USA' WHEN e.addr2 = 60 THEN 'CAN' ELSE 'OTHER' END AS card_country,
 CASE WHEN e.addr2 = 87 THEN 'USA' WHEN e.addr2 = 60 THEN 'CAN' ELSE 'OTHER' END AS shipping_country,
 concat('ieee_merchant_', e.ProductCD) AS merchant_id,
 CASE e.ProductCD WHEN 'W' THEN 'digital_goods' WHEN 'H' THEN 'home' WHEN 'C' THEN 'clothing'
  WHEN 'S' THEN 'services' WHEN 'R' THEN 'retail' ELSE 'unknown' END AS merchant_category,
 coalesce(e.P_emaildomain, 'unknown') AS email_domain,
 TRUE AS is_online,
 concat('ieee_device_', coalesce(i.DeviceInfo, 'nan')) AS device_id,
 concat('ieee_card_', e.card1) AS customer_id,
 CASE e.ProductCD WHEN 'W' THEN 'digital_goods' WHEN 'H' THEN 'home' WHEN 'C' THEN 'clothing'
  WHEN 'S' THEN 'services' WHEN 'R' THEN 'retail' ELSE 'unknown' END AS product_category,
 'IEEE_CIS' AS data_source,
 e.isFraud = 1 AS is_fraud,
 'GROUND_TRUTH' AS fraud_label_source,
 round(e.V1, 6) AS ieee_v1, e.C1 AS ieee_c1, e.D1 AS ieee_d1,
 i.DeviceType AS ieee_devicetype, i.DeviceInfo AS ieee_deviceinfo
FROM ext_txn e LEFT JOIN ext_identity i ON e.TransactionID = i.TransactionID"""


@query("b1_external_to_canonical", _EXT_SQL, ("ext_txn", "ext_identity"))
def _(t: Tables):
    return plain(external.to_canonical(t.ext_txn, t.ext_identity).drop("ip_address"))


def _mapped(name: str, columns: str):
    """One query per mapping step: the same job, narrowed to the columns of the step."""
    picked = [c.strip() for c in columns.split(",")]

    @query(name, f"SELECT {', '.join(picked)} FROM ({_EXT_SQL}) AS m", ("ext_txn", "ext_identity"))
    def _(t: Tables):
        return plain(external.to_canonical(t.ext_txn, t.ext_identity).select(*picked))


_mapped("b2_epoch_timestamp", "transaction_id, timestamp")
_mapped("b3_amount_rounding", "transaction_id, amount")
_mapped("b4_card_type", "transaction_id, card_type")
_mapped("b5_country_decode", "transaction_id, billing_country, card_country, shipping_country")
_mapped("b6_product_category", "transaction_id, merchant_id, merchant_category, product_category")
_mapped("b7_defaults", "transaction_id, email_domain, device_id, customer_id, is_online")
_mapped("b8_passthrough", "transaction_id, ieee_v1, ieee_c1, ieee_d1, ieee_devicetype, ieee_deviceinfo")


@query(
    "b7_without_identity",
    """SELECT concat('ieee_', CAST(TransactionID AS VARCHAR)) AS transaction_id, 'unknown' AS device_id,
    coalesce(P_emaildomain, 'unknown') AS email_domain FROM ext_txn""",
    ("ext_txn",),
)
def _(t: Tables):
    return external.to_canonical(t.ext_txn).select("transaction_id", "device_id", "email_domain")


@query(
    "d1_identity_left_join",
    """SELECT e.TransactionID, e.ProductCD, i.DeviceType, i.DeviceInfo
    FROM ext_txn e LEFT JOIN ext_identity i ON e.TransactionID = i.TransactionID""",
    ("ext_txn", "ext_identity"),
)
def _(t: Tables):
    joined = external.join_identity(t.ext_txn, t.ext_identity)
    return plain(joined.select("TransactionID", "ProductCD", "DeviceType", "DeviceInfo"))
