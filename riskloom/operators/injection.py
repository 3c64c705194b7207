"""Labelled anomalies written into an existing transaction table.

Whether a row is used, for which anomaly, and every changed value follow from hashes of its id, so
the result depends neither on partitioning nor on a random state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import from_micros, hash32, micros, pick, unit

# Largest usual amount of each merchant category (first profile of the category).
CATEGORY_MAXIMA = {
    "grocery": 300.0,
    "gas_station": 150.0,
    "food_beverage": 200.0,
    "electronics": 2000.0,
    "apparel": 500.0,
    "health": 200.0,
    "digital_services": 50.0,
    "utilities": 500.0,
    "travel": 5000.0,
    "lodging": 1000.0,
    "transportation": 100.0,
    "luxury": 10000.0,
    "home": 5000.0,
}
DEFAULT_MAXIMUM = 1000.0

# Lists the injected values are picked from.
COUNTRIES = ["USA", "CAN", "GBR", "DEU", "FRA", "JPN", "AUS", "BRA", "MEX", "IND"]
SUSPICIOUS_DOMAINS = ["tempmail.com", "guerrillamail.com", "10minutemail.com", "throwaway.email"]
SUSPICIOUS_NETWORKS = ["185.220.", "104.244.", "45.33.", "103.21."]
UNUSUAL_CATEGORY = "electronics"

BURST_ROWS = 5
OUTLIER_RANGE = (10.0, 50.0)
OFF_HOURS_RANGE = (2.0, 5.0)
OFF_HOURS_MOVED = 0.3


@dataclass(frozen=True)
class AnomalyMix:
    rate: float = 0.02
    amount_outlier: float = 0.25
    velocity: float = 0.20
    geographic: float = 0.15
    off_hours: float = 0.15
    duplicate: float = 0.10
    merchant: float = 0.15

    def shares(self) -> dict[str, float]:
        return {
            "amount_outlier": self.amount_outlier,
            "velocity": self.velocity,
            "geographic": self.geographic,
            "off_hours": self.off_hours,
            "duplicate": self.duplicate,
            "merchant": self.merchant,
        }

    def validate(self) -> None:
        total = sum(self.shares().values())
        if abs(total - 1.0) > 0.01:
            raise ValueError(f"anomaly shares must sum to 1, got {total}")


def anomaly_kind(mix: AnomalyMix, row_id: str = "transaction_id") -> Column:
    """The anomaly a row is used for, or NULL.

    A burst makes five rows, so its share of the seeds is a fifth of its share of the rows.
    """
    draw = unit(F.lit("inject"), row_id)
    kind = F.lit(None).cast("string")
    upper = 0.0
    branches = []
    for name, share in mix.shares().items():
        upper += mix.rate * share / (BURST_ROWS if name == "velocity" else 1)
        branches.append((name, upper))
    for name, limit in reversed(branches):
        kind = F.when(draw < limit, name).otherwise(kind)
    return kind


def _address() -> Column:
    octet = lambda part: (hash32(F.lit(part), "transaction_id") % 256).cast("string")
    return F.concat(pick(SUSPICIOUS_NETWORKS, F.lit("net"), "transaction_id"), octet("ip3"), F.lit("."), octet("ip4"))


def _between(low: float, high: float, tag: str) -> Column:
    return F.lit(low) + unit(F.lit(tag), "transaction_id") * (high - low)


def _maximum(category: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CATEGORY_MAXIMA.items() for x in pair])
    return F.coalesce(F.try_element_at(table, category), F.lit(DEFAULT_MAXIMUM))


def _outlier(category: Column) -> Column:
    return F.round(_maximum(category) * _between(*OUTLIER_RANGE, "outlier"), 2)


def _other_country(tag: str) -> Column:
    """A country other than the billing country (USA where that is missing)."""
    home = F.coalesce("billing_country", F.lit("USA"))
    others = F.array_except(F.array(*[F.lit(c) for c in COUNTRIES]), F.array(home))
    return F.element_at(others, (hash32(F.lit(tag), "transaction_id") % F.size(others) + 1).cast("int"))


# --- what each anomaly changes ----------------------------------------------------------------
#
# Every function returns the changed columns of a row that is already known to be of that kind.
# ``_copy`` numbers the added rows of a seed from 0; new ids are in place when values are drawn.


def _amount_outlier() -> dict[str, Column]:
    return {
        "amount": _outlier(F.col("merchant_category")),
        "email_domain": pick(SUSPICIOUS_DOMAINS, F.lit("mail"), "transaction_id"),
        "ip_address": _address(),
        "shipping_country": pick(COUNTRIES, F.lit("ship"), "transaction_id"),
    }


def _velocity() -> dict[str, Column]:
    """Row i comes i times one or two minutes after the seed, at its own merchant and device."""
    step = F.lit(1) + hash32(F.lit("step"), "transaction_id") % 2
    category = pick(list(CATEGORY_MAXIMA), F.lit("burst"), "transaction_id")
    shop = (hash32(F.lit("shop"), "transaction_id") % 50).cast("string")
    return {
        "timestamp": from_micros(micros("timestamp") + F.col("_copy") * step * 60_000_000),
        "merchant_id": F.concat(category, F.lit("_"), shop),
        "merchant_category": category,
        "amount": F.round(_maximum(category) * _between(0.01, 1.0, "paid"), 2),
        "device_id": F.concat(F.lit("device_"), F.substring(F.md5("transaction_id"), 1, 8)),
        "ip_address": _address(),
    }


def _geographic() -> dict[str, Column]:
    return {
        "shipping_country": _other_country("ship"),
        "card_country": _other_country("card"),
        "ip_address": _address(),
    }


def _off_hours() -> dict[str, Column]:
    """Two to five times the amount; three rows in ten move to an hour from one to four."""
    us, hour = micros("timestamp"), F.lit(3_600_000_000)
    day = us - F.pmod(us, F.lit(24) * hour)
    night = day + (F.lit(1) + hash32(F.lit("hour"), "transaction_id") % 4) * hour + F.pmod(us, hour)
    moves = unit(F.lit("moved"), "transaction_id") < OFF_HOURS_MOVED
    amount = F.col("amount").cast("double") * _between(*OFF_HOURS_RANGE, "factor")
    return {
        "timestamp": from_micros(F.when(moves, night).otherwise(us)),
        "amount": F.round(amount, 2),
        "ip_address": _address(),
    }


def _duplicate() -> dict[str, Column]:
    """The same charge again, 1 to 29 seconds later."""
    later = F.lit(1) + hash32(F.lit("late"), "transaction_id") % 29
    return {"timestamp": from_micros(micros("timestamp") + later * 1_000_000)}


def _merchant() -> dict[str, Column]:
    shop = (hash32(F.lit("shop"), "transaction_id") % 50).cast("string")
    return {
        "merchant_id": F.concat(F.lit(f"{UNUSUAL_CATEGORY}_"), shop),
        "merchant_category": F.lit(UNUSUAL_CATEGORY),
        "amount": _outlier(F.lit(UNUSUAL_CATEGORY)),
        "email_domain": pick(SUSPICIOUS_DOMAINS, F.lit("mail"), "transaction_id"),
    }


KINDS = {
    "amount_outlier": _amount_outlier,
    "velocity": _velocity,
    "geographic": _geographic,
    "off_hours": _off_hours,
    "duplicate": _duplicate,
    "merchant": _merchant,
}
_ADDED = ["velocity", "duplicate"]


def _applied(marked: DataFrame, columns: list[str]) -> DataFrame:
    """One pass over rows marked with ``_kind``: changed rows, and the added copies of seeds.

    Near-duplicates are made of honest rows only.
    """
    kind, copy = F.col("_kind"), F.col("_copy")
    honest = ~F.coalesce("is_fraud", F.lit(False))
    itself = F.array(F.lit(-1))
    copies = (
        F.when(kind == "velocity", F.sequence(F.lit(-1), F.lit(BURST_ROWS - 1)))
        .when((kind == "duplicate") & honest, F.array(F.lit(-1), F.lit(0)))
        .otherwise(itself)
    )
    rows = marked.withColumn("_copy", F.explode(copies))
    rows = rows.withColumn("_kind", F.when(~kind.isin(_ADDED) | (copy >= 0), kind))
    new_id = (
        F.when(kind == "velocity", F.concat("transaction_id", F.lit("_v"), copy.cast("string")))
        .when(kind == "duplicate", F.concat("transaction_id", F.lit("_d")))
        .otherwise(F.col("transaction_id"))
    )
    rows = rows.withColumn("transaction_id", new_id)
    types = {f.name: f.dataType for f in marked.schema.fields}
    values = {name: make() for name, make in KINDS.items()}
    out = []
    for c in columns:
        value = F.col(c)
        for name, changed in values.items():
            if c in changed:
                value = F.when(kind == name, changed[c].cast(types[c])).otherwise(value)
        if c == "is_fraud":
            value = F.when(kind.isNotNull(), F.lit(True)).otherwise(value)
        if c == "fraud_label_source":
            value = F.when(kind.isNotNull(), F.lit("INJECTED")).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out, "_kind")


def injected(seeds: DataFrame, kind: str) -> DataFrame:
    """The anomalous rows one kind makes of all ``seeds``."""
    marked = seeds.withColumn("_kind", F.lit(kind))
    return _applied(marked, seeds.columns).where(F.col("_kind").isNotNull()).drop("_kind")


def inject(txns: DataFrame, mix: AnomalyMix = AnomalyMix()) -> DataFrame:
    """The table with anomalies: some rows changed in place, bursts and near-duplicates added."""
    mix.validate()
    marked = txns.withColumn("_kind", anomaly_kind(mix))
    return _applied(marked, txns.columns).drop("_kind")
