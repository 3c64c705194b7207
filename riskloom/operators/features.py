"""The feature columns of a transaction: base, calendar, risk and per-entity history."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import HOUR_US, differs, flag, micros
from riskloom.operators.trailing import (
    BROADCAST_KEYS,
    NO_HISTORY_GAP,
    Measure,
    count,
    measure_load,
    statistic,
    trailing,
)

if TYPE_CHECKING:
    from riskloom.sources.runs import LastSeen

# Window lengths in hours. The 30-day window is known but not counted.
WINDOWS = {"1h": 1, "6h": 6, "24h": 24, "7d": 168, "30d": 720}
COUNT_WINDOWS = {name: hours for name, hours in WINDOWS.items() if hours <= 168}
STATISTIC_WINDOWS = {"24h": 24, "7d": 168}

# Disposable mail domains, the whole list and the short list of the fast feature set.
SUSPICIOUS_DOMAINS = [
    "tempmail.com",
    "guerrillamail.com",
    "10minutemail.com",
    "throwaway.email",
    "mailinator.com",
    "fakeinbox.com",
    "sharklasers.com",
    "yopmail.com",
]
FAST_SUSPICIOUS_DOMAINS = SUSPICIOUS_DOMAINS[:5]

# Merchant categories counted as high risk.
HIGH_RISK_CATEGORIES = [
    "jewelry",
    "luxury",
    "electronics",
    "travel",
    "gambling",
    "cryptocurrency",
    "wire_transfer",
    "gift_cards",
]

COUNTED_ENTITIES = ["card_id", "customer_id", "merchant_id"]
PROFILED_ENTITIES = ["card_id", "merchant_id"]
_EPSILON = 1e-6


@dataclass(frozen=True)
class FeatureGroups:
    """Which groups to compute. ``cold_start`` is the z-score of a row without history:
    ``"raw"`` keeps amount / 1e-6, ``"zero"`` makes it 0."""

    velocity: bool = True
    aggregations: bool = True
    temporal: bool = True
    risk: bool = True
    cold_start: str = "raw"


def base_columns() -> dict[str, Column]:
    amount = F.col("amount").cast("double")
    return {"amount": amount, "amount_log": F.log1p(amount)}


def temporal_columns(ts: str = "timestamp") -> dict[str, Column]:
    hour, dow, day = F.hour(ts), F.weekday(F.col(ts)), F.dayofmonth(ts)
    turn = 2 * math.pi
    return {
        "hour_sin": F.sin(F.lit(turn) * hour / 24),
        "hour_cos": F.cos(F.lit(turn) * hour / 24),
        "dow_sin": F.sin(F.lit(turn) * dow / 7),
        "dow_cos": F.cos(F.lit(turn) * dow / 7),
        "is_weekend": flag(dow >= 5),
        "is_night": flag((hour >= 22) | (hour <= 5)),
        "is_business_hours": flag(hour.between(9, 17) & (dow < 5)),
        "day_of_month": day,
        "is_month_start": flag(day <= 3),
        "is_month_end": flag(day >= 28),
    }


def risk_columns(present: list[str]) -> dict[str, Column]:
    """Risk indicators; those that compare columns the table lacks are left out."""
    has = set(present).issuperset
    amount = F.col("amount").cast("double")
    out = {"suspicious_email": flag(F.col("email_domain").isin(SUSPICIOUS_DOMAINS))}
    if has({"billing_country", "shipping_country"}):
        out["country_mismatch"] = differs("billing_country", "shipping_country")
    if has({"card_country", "billing_country"}):
        out["card_billing_mismatch"] = differs("card_country", "billing_country")
    if has({"merchant_category"}):
        out["high_risk_category"] = flag(F.col("merchant_category").isin(HIGH_RISK_CATEGORIES))
    out["is_online"] = flag(F.col("is_online"))
    out["is_round_amount"] = flag(amount % 100 == 0)
    out["is_large_amount"] = flag(amount > 1000)
    out["is_very_large_amount"] = flag(amount > 5000)
    return out


def fast_columns(present: list[str]) -> dict[str, Column]:
    """The thirteen features that need no history, for low-latency and streaming scoring."""
    calendar = temporal_columns()
    risk = risk_columns(present)
    out = base_columns()
    for name in ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "is_night"):
        out[name] = calendar[name]
    out["suspicious_email"] = flag(F.col("email_domain").isin(FAST_SUSPICIOUS_DOMAINS))
    for name in ("is_online", "is_round_amount", "is_large_amount", "country_mismatch"):
        if name in risk:
            out[name] = risk[name]
    return out


def _short(entity: str) -> str:
    return entity.removesuffix("_id")


def history_measures(entity: str, present: list[str], groups: FeatureGroups) -> list[Measure]:
    """The trailing measures of one entity, in feature order."""
    e = _short(entity)
    out: list[Measure] = []
    if groups.velocity:
        out += [count(f"{e}_txn_count_{w}", h) for w, h in COUNT_WINDOWS.items()]
    if groups.aggregations and entity in PROFILED_ENTITIES:
        for w, h in STATISTIC_WINDOWS.items():
            out += [statistic(k, f"{e}_amount_{k}_{w}", "amount", h) for k in ("mean", "std", "max")]
        if entity == "card_id" and "merchant_id" in present:
            out += [
                statistic("distinct", f"{e}_unique_merchants_{w}", "merchant_id", h)
                for w, h in STATISTIC_WINDOWS.items()
            ]
    return out


def zscore(amount: Column, mean: Column, std: Column, cold_start: str) -> Column:
    """Distance from the window mean; an empty window has mean and std 0."""
    z = (amount - mean) / (std + F.lit(_EPSILON))
    if cold_start == "raw":
        return z
    return F.when((mean == 0) & (std == 0), F.lit(0.0)).otherwise(z)


def feature_names(present: list[str], groups: FeatureGroups = FeatureGroups()) -> list[str]:
    """Feature columns in their fixed order for a table with the given columns."""
    names = list(base_columns())
    if groups.temporal:
        names += list(temporal_columns())
    if groups.risk:
        names += list(risk_columns(present))
    if groups.velocity:
        for entity in COUNTED_ENTITIES:
            if entity in present:
                e = _short(entity)
                names += [f"{e}_hours_since_last"] + [f"{e}_txn_count_{w}" for w in COUNT_WINDOWS]
    if groups.aggregations:
        for entity in PROFILED_ENTITIES:
            if entity in present:
                names += [
                    f"{_short(entity)}_amount_{k}_{w}"
                    for w in STATISTIC_WINDOWS
                    for k in ("mean", "std", "max", "zscore")
                ]
        if {"card_id", "merchant_id"}.issubset(present):
            names += [f"card_unique_merchants_{w}" for w in STATISTIC_WINDOWS]
    return names


def with_features(
    txns: DataFrame,
    groups: FeatureGroups = FeatureGroups(),
    *,
    keep: tuple[str, ...] = ("transaction_id",),
    history: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Feature matrix keyed by ``transaction_id``: 53 columns with all groups on.

    Each entity costs one shuffle of the columns still needed; Catalyst drops the others. Rows keep
    their identity, so nothing depends on row order. ``history`` is passed to :func:`trailing`.
    """
    present = txns.columns
    carried = list(dict.fromkeys([*keep, *([history] if history else [])]))
    work = txns
    entities = [e for e in COUNTED_ENTITIES if e in present and history_measures(e, present, groups)]
    load = measure_load(txns, entities) if entities and strategy == "auto" else {}
    for entity in entities:
        work = trailing(
            work,
            entity,
            history_measures(entity, present, groups),
            gap=f"{_short(entity)}_hours_since_last" if groups.velocity else None,
            history=history,
            base=txns,
            load=load.get(entity),
            strategy=strategy,
        )
    columns = base_columns()
    if groups.temporal:
        columns |= temporal_columns()
    if groups.risk:
        columns |= risk_columns(present)
    if groups.aggregations:
        for entity in [e for e in PROFILED_ENTITIES if e in entities]:
            e = _short(entity)
            for w in STATISTIC_WINDOWS:
                columns[f"{e}_amount_zscore_{w}"] = zscore(
                    F.col("amount").cast("double"),
                    F.col(f"{e}_amount_mean_{w}"),
                    F.col(f"{e}_amount_std_{w}"),
                    groups.cold_start,
                )
    selected = [columns.get(n, F.col(n)).alias(n) for n in feature_names(present, groups)]
    extra = [c for c in carried if c not in feature_names(present, groups)]
    return _filled(work.select(*extra, *selected), feature_names(present, groups))


def with_fast_features(
    txns: DataFrame, *, keep: tuple[str, ...] = ("transaction_id",)
) -> DataFrame:
    columns = fast_columns(txns.columns)
    out = txns.select(*keep, *[c.alias(n) for n, c in columns.items()])
    return _filled(out, list(columns))


def _filled(df: DataFrame, names: list[str]) -> DataFrame:
    """Missing feature values (NULL or NaN) become 0."""
    return df.na.fill(0, subset=names)


def feature_matrix_columns(df: DataFrame) -> list[str]:
    """Everything a model may read: all columns but the key, the time and the labels."""
    held_out = {"transaction_id", "timestamp", "is_fraud"}
    return [c for c in df.columns if c not in held_out]


def with_features_after(
    batch: DataFrame,
    past: DataFrame,
    groups: FeatureGroups = FeatureGroups(),
    *,
    keep: tuple[str, ...] = ("transaction_id",),
    strategy: str = "auto",
    last_seen: LastSeen | None = None,
    before: int | None = None,
    day: str | None = None,
) -> DataFrame:
    """Features of ``batch`` when the rows of ``past`` came before it.

    Windows read the past they can reach, time bounds at the scan, and of it only rows that share an
    entity with the batch. The gap to an entity's previous row has no bound: times before that reach
    come from ``last_seen`` (as of epoch ``before``) and from the past's rows of the day where the
    reach ends, or, without it, from all the older past's entity and time columns. ``day`` names a
    date column that partitions ``past``. Rows of the batch that are already in the past count once.
    """
    start = F.min("timestamp") - F.expr(f"INTERVAL {max(COUNT_WINDOWS.values())} HOURS")
    first, last, start_day = batch.agg(start, F.max("timestamp"), F.to_date(start)).first()
    if first is None:
        return with_features(batch, groups, keep=keep, strategy=strategy)
    entities = [e for e in COUNTED_ENTITIES if e in batch.columns]
    asked = {e: _asked(batch, e) for e in entities}
    reach = F.lit(first)

    def between(low, high) -> Column:
        """Past rows of a time range, its days first so that whole folders are skipped."""
        days = F.lit(True) if day is None else F.col(day).between(F.to_date(low), F.to_date(high))
        return days & (F.col("timestamp") >= low) & (F.col("timestamp") <= high)

    reached = past.where(between(reach, F.lit(last)))
    shares = F.lit(False)
    for e in entities:
        reached = reached.join(asked[e].withColumn(f"_in_{e}", F.lit(True)), e, "left")
        shares |= F.col(f"_in_{e}").isNotNull()
    reached = reached.where(shares).join(batch.select("transaction_id"), "transaction_id", "left_anti")
    both = reached.select(*batch.columns).withColumn("_asked", F.lit(False))
    both = both.unionByName(batch.withColumn("_asked", F.lit(True)))
    carried = list(dict.fromkeys([*keep, "timestamp", *entities, "_asked"]))
    out = with_features(both, groups, keep=tuple(carried), strategy=strategy).where("_asked")
    if groups.velocity:
        for e in entities:
            gap = f"{_short(e)}_hours_since_last"
            older = past.where(F.col("timestamp") < reach)
            seen = last_seen.seen_before(e, start_day, before) if last_seen else None
            if seen is not None:
                midnight = F.date_trunc("DAY", reach)
                older = past.where(between(midnight, reach) & (F.col("timestamp") < reach))
                older = older.select(e, "timestamp").unionByName(seen)
            latest = (
                older.select(e, "timestamp")
                .join(asked[e], e, "left_semi")
                .groupBy(e)
                .agg(F.max("timestamp").alias("_latest"))
            )
            hours = (micros("timestamp") - micros("_latest")) / F.lit(float(HOUR_US))
            unseen = (F.col(gap) == NO_HISTORY_GAP) & F.col("_latest").isNotNull()
            out = out.join(latest, e, "left")
            out = out.withColumn(gap, F.when(unseen, hours).otherwise(F.col(gap))).drop("_latest")
    names = feature_names(batch.columns, groups)
    return out.select(*[c for c in keep if c not in names], *names)


def _asked(batch: DataFrame, entity: str) -> DataFrame:
    """The batch's keys of one entity column, sent to every executor while they are few."""
    keys = batch.where(F.col(entity).isNotNull()).select(entity).distinct()
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
