"""Small column expressions: time in microseconds, hashing, display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def micros(column: Column | str) -> Column:
    """Epoch microseconds; ``timestamp_ntz`` is read as UTC."""
    col = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(col.cast("timestamp"))


def from_micros(column: Column) -> Column:
    return F.timestamp_micros(column)


def flag(condition: Column) -> Column:
    """A predicate as 0/1, NULL counting as false."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def differs(left: str, right: str) -> Column:
    """1 unless both sides are known and equal: a missing country is a mismatch."""
    return F.coalesce(F.col(left) != F.col(right), F.lit(True)).cast("int")


def hash32(*parts: Column | str) -> Column:
    """First 32 bits of the md5 of the joined parts: the same number in any engine."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.col(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit(*parts: Column | str) -> Column:
    """A reproducible number in [0, 1) drawn from the given parts."""
    return hash32(*parts) / F.lit(4294967296.0)


def pick(values: list[str], *parts: Column | str) -> Column:
    """One of ``values``, chosen by the hash of the parts."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (hash32(*parts) % len(values) + 1).cast("int"))


# The names shown for feature columns in reports.
DISPLAY_NAMES = {
    "amount": "Transaction Amount",
    "amount_log": "Log Transaction Amount",
    "hour_sin": "Hour (Sine)",
    "hour_cos": "Hour (Cosine)",
    "is_weekend": "Weekend Transaction",
    "is_night": "Night Transaction (10pm-5am)",
    "suspicious_email": "Suspicious Email Domain",
    "country_mismatch": "Billing/Shipping Country Mismatch",
    "card_billing_mismatch": "Card/Billing Country Mismatch",
    "high_risk_category": "High-Risk Merchant Category",
    "is_round_amount": "Round Amount ($X00)",
    "is_large_amount": "Large Amount (>$1000)",
    "card_hours_since_last": "Hours Since Last Card Transaction",
    "card_txn_count_1h": "Card Transactions in Last Hour",
    "card_txn_count_24h": "Card Transactions in Last 24h",
    "card_amount_zscore_24h": "Amount Z-Score vs 24h Average",
    "card_unique_merchants_24h": "Unique Merchants in 24h",
}


def display_name(feature: Column) -> Column:
    """The reader's name of a feature, or the column name where there is none."""
    names = F.create_map(*[F.lit(x) for pair in DISPLAY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, feature), feature)
