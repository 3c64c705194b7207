"""Queries on trailing windows. The oracle frames end one microsecond before the row."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators.features import (
    COUNT_WINDOWS,
    COUNTED_ENTITIES,
    PROFILED_ENTITIES,
    STATISTIC_WINDOWS,
    FeatureGroups,
    with_features,
    with_features_after,
)
from riskloom.operators.trailing import count, statistic, trailing
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import plain, query, rnd
from riskloom.plans.registry.mapping import BASE_SQL, RISK_SQL, TEMPORAL_SQL


def _frame(entity: str, hours: int) -> str:
    return (
        f"(PARTITION BY {entity} ORDER BY timestamp RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING "
        "AND INTERVAL 1 MICROSECOND PRECEDING)"
    )


def _known(entity: str, value: str, default: str) -> str:
    return f"CASE WHEN {entity} IS NULL THEN {default} ELSE {value} END"


def _e(entity: str) -> str:
    return entity.removesuffix("_id")


def gap_sql(entity: str) -> str:
    lag = f"lag(timestamp) OVER (PARTITION BY {entity} ORDER BY timestamp, transaction_id)"
    hours = f"coalesce((epoch_us(timestamp) - epoch_us({lag})) / 3600000000.0, 9999)"
    return rnd(_known(entity, hours, "9999"), f"{_e(entity)}_hours_since_last")


def counts_sql(entity: str) -> list[str]:
    return [
        "CAST("
        + _known(entity, f"count(*) OVER {_frame(entity, h)}", "0")
        + f" AS BIGINT) AS {_e(entity)}_txn_count_{w}"
        for w, h in COUNT_WINDOWS.items()
    ]


_FUNCTIONS = {"mean": "avg", "std": "stddev_samp", "max": "max"}
_DIGITS = {"mean": 6, "std": 4, "max": 6, "zscore": 4}


def _stat(entity: str, kind: str, hours: int) -> str:
    value = f"coalesce({_FUNCTIONS[kind]}(amount) OVER {_frame(entity, hours)}, 0)"
    return _known(entity, value, "0")


def _z(entity: str, hours: int) -> str:
    mean, std = _stat(entity, "mean", hours), _stat(entity, "std", hours)
    return f"(amount - {mean}) / ({std} + 1e-6)"


def stats_sql(entity: str, kinds: tuple[str, ...]) -> list[str]:
    out = []
    for w, h in STATISTIC_WINDOWS.items():
        for k in kinds:
            value = _z(entity, h) if k == "zscore" else _stat(entity, k, h)
            out.append(rnd(value, f"{_e(entity)}_amount_{k}_{w}", _DIGITS[k]))
    return out


def distinct_sql() -> list[str]:
    return [
        "CAST("
        + _known("card_id", f"count(DISTINCT merchant_id) OVER {_frame('card_id', h)}", "0")
        + f" AS BIGINT) AS card_unique_merchants_{w}"
        for w, h in STATISTIC_WINDOWS.items()
    ]


def _over(view: str, columns: list[str]) -> str:
    return f"SELECT transaction_id, {', '.join(columns)} FROM {view}"


FINE = {
    f"{_e(e)}_amount_{k}_{w}": _DIGITS[k]
    for e in PROFILED_ENTITIES
    for k in _DIGITS
    for w in STATISTIC_WINDOWS
}


def _features(t: Tables, names: list[str], *, strategy: str = "auto", **groups: bool):
    off = {"velocity": False, "aggregations": False, "temporal": False, "risk": False} | groups
    out = with_features(t.txn, FeatureGroups(**off), strategy=strategy)
    return plain(out.select("transaction_id", *names), fine=FINE)


_GAPS = [f"{_e(e)}_hours_since_last" for e in COUNTED_ENTITIES]
_COUNTS = [f"{_e(e)}_txn_count_{w}" for e in COUNTED_ENTITIES for w in COUNT_WINDOWS]


def _stat_names(kind: str) -> list[str]:
    return [f"{_e(e)}_amount_{kind}_{w}" for e in PROFILED_ENTITIES for w in STATISTIC_WINDOWS]


@query("f1_hours_since_last", _over("txn", [gap_sql(e) for e in COUNTED_ENTITIES]), ("txn",))
def _(t: Tables):
    return _features(t, _GAPS, velocity=True)


@query(
    "f2_txn_counts", _over("txn", [c for e in COUNTED_ENTITIES for c in counts_sql(e)]), ("txn",)
)
def _(t: Tables):
    return _features(t, _COUNTS, velocity=True)


@query("f2_card_txn_count", _over("txn", counts_sql("card_id")), ("txn",))
def _(t: Tables):
    measures = [count(f"card_txn_count_{w}", h) for w, h in COUNT_WINDOWS.items()]
    out = trailing(t.txn, "card_id", measures)
    return plain(out.select("transaction_id", *[m.name for m in measures]))


def _statistic_query(name: str, kind: str) -> None:
    columns = [c for e in PROFILED_ENTITIES for c in stats_sql(e, (kind,))]

    @query(name, _over("txn", columns), ("txn",))
    def _(t: Tables):
        return _features(t, _stat_names(kind), aggregations=True)


_statistic_query("f3_amount_mean", "mean")
_statistic_query("f4_amount_std", "std")
_statistic_query("f5_amount_max", "max")
_statistic_query("f6_amount_zscore", "zscore")


@query("f7_unique_merchants", _over("txn", distinct_sql()), ("txn",))
def _(t: Tables):
    names = [f"card_unique_merchants_{w}" for w in STATISTIC_WINDOWS]
    return _features(t, names, aggregations=True)


FULL_SQL = (
    BASE_SQL
    + TEMPORAL_SQL
    + RISK_SQL
    + [c for e in COUNTED_ENTITIES for c in [gap_sql(e), *counts_sql(e)]]
    + [c for e in PROFILED_ENTITIES for c in stats_sql(e, ("mean", "std", "max", "zscore"))]
    + distinct_sql()
)


@query("f8_full_features", _over("txn", FULL_SQL), ("txn",))
def _(t: Tables):
    return plain(with_features(t.txn), fine=FINE)


# --- the same answers from the form for busy entities -----------------------------------------


@query(
    "f_cells_merchant_history",
    _over("txn", [gap_sql("merchant_id"), *counts_sql("merchant_id"), *stats_sql("merchant_id", ("mean", "std", "max"))]),
    ("txn",),
)
def _(t: Tables):
    measures = [count(f"merchant_txn_count_{w}", h) for w, h in COUNT_WINDOWS.items()] + [
        statistic(k, f"merchant_amount_{k}_{w}", "amount", h)
        for w, h in STATISTIC_WINDOWS.items()
        for k in ("mean", "std", "max")
    ]
    gap = "merchant_hours_since_last"
    out = trailing(t.txn, "merchant_id", measures, gap=gap, strategy="cells")
    return plain(out.select("transaction_id", gap, *[m.name for m in measures]), fine=FINE)


@query("f_cells_unique_merchants", _over("txn", distinct_sql()), ("txn",))
def _(t: Tables):
    measures = [
        statistic("distinct", f"card_unique_merchants_{w}", "merchant_id", h)
        for w, h in STATISTIC_WINDOWS.items()
    ]
    out = trailing(t.txn, "card_id", measures, strategy="cells")
    return plain(out.select("transaction_id", *[m.name for m in measures]))


_TIED = [gap_sql("card_id"), *counts_sql("card_id"), *stats_sql("card_id", ("mean", "std", "max")), *distinct_sql()]


def _tied(t: Tables, strategy: str, limit: int):
    measures = (
        [count(f"card_txn_count_{w}", h) for w, h in COUNT_WINDOWS.items()]
        + [
            statistic(k, f"card_amount_{k}_{w}", "amount", h)
            for w, h in STATISTIC_WINDOWS.items()
            for k in ("mean", "std", "max")
        ]
        + [
            statistic("distinct", f"card_unique_merchants_{w}", "merchant_id", h)
            for w, h in STATISTIC_WINDOWS.items()
        ]
    )
    gap = "card_hours_since_last"
    out = trailing(t.order_txn, "card_id", measures, gap=gap, strategy=strategy, limit=limit)
    return plain(out.select("transaction_id", gap, *[m.name for m in measures]), fine=FINE)


@query("f_ties_frame", _over("order_txn", _TIED), ("order_txn",))
def _(t: Tables):
    return _tied(t, "frame", 0)


@query("f_ties_busy_split", _over("order_txn", _TIED), ("order_txn",))
def _(t: Tables):
    # with a limit of one row per week many customers are busy and many are not: both forms run
    return _tied(t, "auto", 1)


# --- double amounts, rows without entity, and a batch after its past ---------------------------

_THIN = "amount * 0.001234567"


def _thin_sql(kind: str, hours: int) -> str:
    value = f"coalesce({_FUNCTIONS[kind]}({_THIN}) OVER {_frame('merchant_id', hours)}, 0)"
    return rnd(value, f"{kind}_{hours}", 7)


_THIN_SQL = _over("txn", [_thin_sql(k, h) for h in (24, 168) for k in ("mean", "std", "max")])


def _thin(t: Tables, strategy: str):
    """Double amounts well below a cent."""
    rows = t.txn.withColumn("amount", F.col("amount").cast("double") * 0.001234567)
    measures = [statistic(k, f"{k}_{h}", "amount", h) for h in (24, 168) for k in ("mean", "std", "max")]
    out = trailing(rows, "merchant_id", measures, strategy=strategy)
    return plain(out.select("transaction_id", *[m.name for m in measures]), 7)


@query("f_double_frame", _THIN_SQL, ("txn",))
def _(t: Tables):
    return _thin(t, "frame")


@query("f_double_cells", _THIN_SQL, ("txn",))
def _(t: Tables):
    return _thin(t, "cells")


@query(
    "f_null_entity_repeats",
    """SELECT form, 2 * count(*) AS rows, CAST(0 AS BIGINT) AS seen, 9999.0 AS gap
    FROM txn, (VALUES ('frame'), ('cells'), ('auto')) f(form) WHERE card_id IS NULL GROUP BY form""",
    ("txn",),
)
def _(t: Tables):
    """Every row twice, under one id: rows without a card still see nothing."""
    twice = t.txn.union(t.txn)
    found = None
    for form in ("frame", "cells", "auto"):
        out = trailing(
            twice, "card_id", [count("n", 168), statistic("mean", "m", "amount", 168)], gap="gap", strategy=form, limit=50
        )
        one = out.where("card_id IS NULL").agg(
            F.count("*").alias("rows"), F.sum(F.col("n") + (F.col("m") != 0).cast("int")).alias("seen"), F.min("gap").alias("gap")
        ).select(F.lit(form).alias("form"), "rows", "seen", "gap")
        found = one if found is None else found.union(one)
    return plain(found)


HISTORY_SQL = (
    [c for e in COUNTED_ENTITIES for c in [gap_sql(e), *counts_sql(e)]]
    + [c for e in PROFILED_ENTITIES for c in stats_sql(e, ("mean", "std", "max", "zscore"))]
    + distinct_sql()
)


@query(
    "f_after_past",
    f"SELECT * EXCLUDE (moment) FROM (SELECT timestamp AS moment, transaction_id, {', '.join(HISTORY_SQL)} FROM txn) x "
    "WHERE moment >= TIMESTAMP '2024-01-22 00:00:00'",
    ("txn",),
)
def _(t: Tables):
    """All 33 history columns of a later batch; many customers rested longer than any window."""
    start = F.lit("2024-01-22 00:00:00").cast("timestamp")
    batch, past = t.txn.where(F.col("timestamp") >= start), t.txn.where(F.col("timestamp") < start)
    groups = FeatureGroups(temporal=False, risk=False)
    out = with_features_after(batch, past, groups)
    return plain(out.drop("amount", "amount_log"), fine=FINE)


# --- point-in-time lookups --------------------------------------------------------------------

_D5 = """SELECT request_id, card_id, reference_time,
 CAST(count(fact_id) AS BIGINT) AS txn_count_window,
 round(coalesce(sum(amount), 0), 6) AS total_amount_window,
 round(coalesce(avg(amount), 0), 6) AS avg_amount_window,
 CAST(count(DISTINCT merchant_id) AS BIGINT) AS distinct_merchants,
 CAST(count(DISTINCT billing_country) AS BIGINT) AS distinct_countries
FROM (
 SELECT q.o_orderkey AS request_id, q.card_id, q.reference_time,
  t.transaction_id AS fact_id, t.amount, t.merchant_id, t.billing_country
 FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
   concat('card_', CAST(o_custkey % 16 AS VARCHAR)) AS card_id,
   TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 173 % 2764800) AS reference_time FROM orders) q
 LEFT JOIN txn t ON t.card_id = q.card_id AND t.timestamp >= q.reference_time - INTERVAL 24 HOUR
  AND t.timestamp < q.reference_time
) x GROUP BY request_id, card_id, reference_time"""


def _requests(t: Tables):
    """Lookups of cards at times spread over the event span; some cards have no transactions."""
    orders = t.spark.read.parquet(f"{t.folder}/orders.parquet")
    start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        F.concat(F.lit("card_"), (F.col("o_custkey") % 16).cast("string")).alias("card_id"),
        F.timestamp_micros(start + F.col("o_orderkey") * 173 % 2764800 * 1_000_000).alias(
            "reference_time"
        ),
    )


@query("d5_card_velocity", _D5, ("txn",))
def _(t: Tables):
    from riskloom.operators.relational import card_velocity

    return plain(card_velocity(t.txn, _requests(t)))


@query("d5_card_velocity_busy", _D5, ("txn",))
def _(t: Tables):
    from riskloom.operators.relational import card_velocity

    return plain(card_velocity(t.txn, _requests(t), limit=200))
