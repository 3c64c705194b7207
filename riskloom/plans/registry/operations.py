"""Queries on reading and writing, the feature store, retention, injection and streams."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskloom.models.ensemble import EnsembleScorer
from riskloom.monitoring import drift, evaluation, quality
from riskloom.operators import feature_store as store
from riskloom.operators import injection, sampling
from riskloom.operators.features import FeatureGroups, feature_names, with_features
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import plain, query, rnd
from riskloom.plans.registry.history import FINE, HISTORY_SQL
from riskloom.plans.registry.mapping import FAST_SQL
from riskloom.schema import canonical_transactions
from riskloom.session import checkpointed, shared_dir
from riskloom.sources import external, sql_surface, tables
from riskloom.streaming import jobs

_AS_OF = datetime(2024, 1, 31)
_AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def _folder(t: Tables, name: str) -> str:
    """A new folder for what a query writes."""
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks ------------------------------------------------------------------------

_CORE = ["transaction_id", "timestamp", "amount", "card_id", "is_fraud"]
_CORE_SQL = f"SELECT {', '.join(_CORE)} FROM txn"


@query("a1_parquet_scan", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(t: Tables):
    rows = t.spark.read.parquet(f"{t.folder}/events.parquet")
    return plain(rows.select("event_id", "ts", "user_id", "event_type", "value"))


@query("a2_parquet_round_trip", _CORE_SQL, ("txn",))
def _(t: Tables):
    path = _folder(t, "parquet")
    tables.write_table(t.txn, path)
    return plain(tables.read_transactions(t.spark, path).select(*_CORE))


@query("a3_csv_round_trip", _CORE_SQL, ("txn",))
def _(t: Tables):
    path = _folder(t, "text") + ".csv"
    tables.write_table(canonical_transactions(t.txn), path)
    return plain(tables.read_transactions_csv(t.spark, path).select(*_CORE))


@query(
    "a4_external_csv_scan",
    """SELECT TransactionID, TransactionDT, round(TransactionAmt, 6) AS TransactionAmt, ProductCD, card1,
    card4, addr2, P_emaildomain, CAST(isFraud AS BIGINT) AS isFraud, round(V1, 6) AS V1, C1, D1, M1 FROM ext_txn""",
    ("ext_txn",),
)
def _(t: Tables):
    """An unwanted column is in the file and must not be in the result."""
    path = _folder(t, "external") + ".csv"
    tables.write_table(t.ext_txn.withColumn("unwanted", F.lit(1)), path)
    return plain(external.read_transactions_csv(t.spark, path))


@query(
    "a5_parameterised_sql",
    "SELECT transaction_id, amount FROM txn WHERE amount > 5000 AND card_type = 'VISA'",
    ("txn",),
)
def _(t: Tables):
    t.txn.createOrReplaceTempView("transactions")
    text = "SELECT transaction_id, amount FROM transactions WHERE amount > :low AND card_type = :type"
    return plain(tables.read_sql(t.spark, text, {"low": 5000, "type": "VISA"}))


@query("a6_write_table", "SELECT count(*) * 2 AS stored, count(*) AS written FROM txn", ("txn",))
def _(t: Tables):
    """Replace, then append: the table holds both writes; the writer counts its own rows."""
    path = _folder(t, "table")
    written = tables.write_counted(t.txn, path, if_exists="replace")
    tables.write_counted(t.txn, path, if_exists="append")
    stored = t.spark.read.parquet(path).agg(F.count("*").alias("stored"))
    return stored.withColumn("written", F.lit(written).cast("bigint"))


@query("a9_stage", _CORE_SQL, ("txn",))
def _(t: Tables):
    return plain(tables.stage(t.txn, _folder(t, "stages"), "batch", "batch_a").select(*_CORE))


@query(
    "a10_validation_summary",
    """SELECT 'batch_bad' AS batch_id, count(*) AS n_rows, false AS success, 12 AS n_expectations,
     CAST((count(*) > count(transaction_id))::INT + (count(*) > count(amount))::INT
      + (count(*) FILTER (WHERE amount < 0 OR amount > 1000000) > 0)::INT
      + (count(transaction_id) > count(DISTINCT transaction_id))::INT AS BIGINT) AS n_failed FROM dq_txn
    UNION ALL SELECT 'batch_good', count(*), count(card_id) = count(*), 12,
     CASE WHEN count(card_id) = count(*) THEN 0 ELSE 1 END FROM txn""",
    ("dq_txn", "txn"),
)
def _(t: Tables):
    path = _folder(t, "validation")
    for batch_id, df in (("batch_bad", t.dq_txn), ("batch_good", t.txn), ("batch_other", t.txn)):
        quality.save_result(t.spark, quality.validate(df, batch_id), path)
    summary = quality.validation_summary(t.spark, path, ["batch_bad", "batch_good"])
    return plain(summary.drop("timestamp"))


@query("a11_row_count", "SELECT count(*) AS rows, true AS known FROM txn", ("txn",))
def _(t: Tables):
    name = f"transactions_{uuid.uuid4().hex}"
    t.txn.createOrReplaceTempView(name)
    known = tables.table_exists(t.spark, name)
    return t.spark.table(name).agg(F.count("*").alias("rows")).withColumn("known", F.lit(known))


@query(
    "a12_persist_scores",
    """SELECT transaction_id, batch_id, round(ensemble_score, 4) AS ensemble_score, 0.5 AS flag_threshold
    FROM (SELECT transaction_id, 'batch_x' AS batch_id, ensemble_score FROM scores
      UNION ALL SELECT transaction_id, 'batch_y', ensemble_score FROM scores) s""",
    ("scores",),
)
def _(t: Tables):
    """Two batches, the first one written twice: the repeat adds nothing."""
    path = _folder(t, "scores")
    results = t.scores.select(
        "transaction_id", "ensemble_score", "is_flagged", "rule_score", "isolation_forest_score"
    )
    for batch_id in ("batch_x", "batch_y", "batch_x"):
        rows = tables.as_scoring_results(results, batch_id, scored_at=_AS_OF)
        tables.persist_scores(t.spark, rows, path, batch_id=batch_id)
    stored = tables.read_scores(t.spark, path)
    return plain(stored.select("transaction_id", "batch_id", "ensemble_score", "flag_threshold"))


# --- SQL surface ------------------------------------------------------------------------------


@query(
    "t1_sql_card_velocity",
    """SELECT count(*) AS txn_count_window, round(coalesce(sum(amount), 0), 2) AS total_amount_window,
     round(coalesce(avg(amount), 0), 2) AS avg_amount_window, count(DISTINCT merchant_id) AS distinct_merchants,
     count(DISTINCT billing_country) AS distinct_countries FROM txn
    WHERE card_id = 'card_3' AND timestamp >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 48 HOUR
     AND timestamp < TIMESTAMP '2024-01-15 00:00:00'""",
    ("txn",),
)
def _(t: Tables):
    sql_surface.register_views(t.spark, t.txn, t.scores)
    sql_surface.register_functions(t.spark)
    call = "SELECT * FROM get_card_velocity('card_3', TIMESTAMP '2024-01-15 00:00:00', 48)"
    return plain(t.spark.sql(call), 2)


@query(
    "t1_sql_unscored_batch",
    """SELECT row_number() OVER (ORDER BY t.timestamp, t.transaction_id) AS place, t.transaction_id, t.amount,
     t.card_id, t.customer_id, t.email_domain, t.billing_country FROM txn t WHERE NOT EXISTS
     (SELECT 1 FROM scores s WHERE s.transaction_id = t.transaction_id)
    ORDER BY t.timestamp, t.transaction_id LIMIT 500""",
    ("txn", "scores"),
)
def _(t: Tables):
    """The oldest 500, in order, with columns beyond the eight that scoring needs."""
    sql_surface.register_views(t.spark, t.txn, t.scores)
    sql_surface.register_functions(t.spark)
    text = """SELECT row_number() OVER (ORDER BY timestamp, transaction_id) AS place, transaction_id, amount,
      card_id, customer_id, email_domain, billing_country FROM extract_unscored_batch(500)"""
    return plain(t.spark.sql(text))


_T1_WAITING = """SELECT t.transaction_id, t.timestamp, t.amount, t.device_id FROM txn t WHERE NOT EXISTS
     (SELECT 1 FROM scores s WHERE s.transaction_id = t.transaction_id)
    ORDER BY t.timestamp, t.transaction_id LIMIT {}"""


def _sql_batch(t: Tables, arguments: str):
    sql_surface.register_views(t.spark, t.txn, t.scores)
    sql_surface.register_functions(t.spark)
    call = f"SELECT transaction_id, timestamp, amount, device_id FROM extract_unscored_batch({arguments})"
    return plain(t.spark.sql(call))


@query("t1_sql_unscored_default", _T1_WAITING.format(10000), ("txn", "scores"))
def _(t: Tables):
    return _sql_batch(t, "")


@query("t1_sql_unscored_source", _T1_WAITING.format(1234), ("txn", "scores"))
def _(t: Tables):
    return _sql_batch(t, "1234, 'SYNTHETIC'")


@query(
    "t2_sql_views",
    f"""WITH twice AS (SELECT batch_id, ensemble_score FROM scores
      UNION ALL SELECT batch_id, ensemble_score / 2 FROM scores)
    SELECT batch_id, count(*) AS total_scored, {rnd('quantile_cont(ensemble_score, 0.5)', 'median_score')},
     {rnd('quantile_cont(ensemble_score, 0.95)', 'p95_score')} FROM twice GROUP BY batch_id""",
    ("scores",),
)
def _(t: Tables):
    """The summary is asked after rows were appended to the table its view was registered on."""
    path = _folder(t, "scores")
    t.scores.write.parquet(path)
    kept = t.spark.read.schema(t.scores.schema).parquet(path)
    sql_surface.register_views(t.spark, t.txn, kept)
    half = (F.col("ensemble_score") / 2).cast(t.scores.schema["ensemble_score"].dataType)
    t.scores.withColumn("ensemble_score", half).write.mode("append").parquet(path)
    t.spark.catalog.refreshTable("v_batch_summary")
    text = "SELECT batch_id, total_scored, median_score, p95_score FROM v_batch_summary"
    return plain(t.spark.sql(text))


@query(
    "t2_sql_flagged_view",
    """SELECT s.batch_id, count(*) AS flagged_rows, round(sum(t.amount), 4) AS flagged_amount
    FROM txn t JOIN scores s ON t.transaction_id = s.transaction_id WHERE s.is_flagged GROUP BY s.batch_id""",
    ("txn", "scores"),
)
def _(t: Tables):
    sql_surface.register_views(t.spark, t.txn, t.scores)
    text = """SELECT f.batch_id, count(*) AS flagged_rows, sum(f.amount) AS flagged_amount
      FROM v_flagged_transactions f JOIN v_batch_summary b ON f.batch_id = b.batch_id GROUP BY f.batch_id"""
    return plain(t.spark.sql(text), 4)


# --- feature store, retention, erasure --------------------------------------------------------

_STORE_ROWS = " UNION ALL ".join(
    f"SELECT '{kind}' AS entity_type, {column} AS entity_id, '{w}' AS feature_window, amount FROM txn "
    f"WHERE {column} IS NOT NULL AND timestamp >= {_AS_OF_SQL} - INTERVAL {h} HOUR AND timestamp < {_AS_OF_SQL}"
    for kind, column in store.ENTITY_COLUMNS.items()
    for w, h in store.STORE_WINDOWS.items()
)


@query(
    "p1_feature_store",
    f"""SELECT entity_type, entity_id, feature_window, count(*) AS txn_count, round(sum(amount), 4) AS amount_sum,
    round(avg(amount), 6) AS amount_mean, max(amount) AS amount_max FROM ({_STORE_ROWS}) r
    GROUP BY entity_type, entity_id, feature_window""",
    ("txn",),
)
def _(t: Tables):
    rows = store.materialise(t.txn, _AS_OF)
    return plain(
        rows.select(
            "entity_type",
            "entity_id",
            "feature_window",
            F.col("features")["txn_count"].cast("bigint").alias("txn_count"),
            *[F.col("features")[k].alias(k) for k in ("amount_sum", "amount_mean", "amount_max")],
        ),
        fine={"amount_sum": 4},
    )


@query(
    "p2_feature_lookup",
    f"""SELECT t.transaction_id, f.n AS card_txn_count FROM txn t LEFT JOIN (SELECT card_id, count(*) AS n FROM txn
    WHERE card_id IS NOT NULL AND timestamp >= {_AS_OF_SQL} - INTERVAL 24 HOUR AND timestamp < {_AS_OF_SQL}
    GROUP BY card_id) f ON t.card_id = f.card_id""",
    ("txn",),
)
def _(t: Tables):
    path = _folder(t, "store")
    store.write_store(store.materialise(t.txn, _AS_OF), path)
    found = store.lookup(t.txn, t.spark.read.parquet(path), _AS_OF)
    return found.select(
        "transaction_id", F.col("features")["txn_count"].cast("bigint").alias("card_txn_count")
    )


_STORED_AT = [datetime(2024, 1, 5), datetime(2024, 1, 12, 6), datetime(2024, 1, 20)]
_STORED_SQL = " UNION ALL ".join(
    f"""SELECT card_id, TIMESTAMP '{at}' AS computed_at, TIMESTAMP '{at}' + INTERVAL 72 HOUR AS valid_until,
     CAST(count(*) AS BIGINT) AS n FROM txn WHERE card_id IS NOT NULL
      AND timestamp >= TIMESTAMP '{at}' - INTERVAL 24 HOUR AND timestamp < TIMESTAMP '{at}' GROUP BY card_id"""
    for at in _STORED_AT
)


@query(
    "p2_lookup_as_of",
    f"""WITH s AS ({_STORED_SQL}),
    asked AS (SELECT transaction_id, card_id, timestamp FROM txn
      UNION ALL SELECT concat(transaction_id, '-at'), card_id, TIMESTAMP '{_STORED_AT[1]}' FROM txn
      UNION ALL SELECT concat(transaction_id, '-end'), card_id, TIMESTAMP '{_STORED_AT[1]}' + INTERVAL 72 HOUR FROM txn)
    SELECT a.transaction_id, CASE WHEN s.valid_until >= a.timestamp THEN s.n END AS card_txn_count,
     CASE WHEN s.valid_until >= a.timestamp THEN s.computed_at END AS computed_at
    FROM asked a ASOF LEFT JOIN s ON a.card_id = s.card_id AND a.timestamp >= s.computed_at""",
    ("txn",),
)
def _(t: Tables):
    """Three stored states; asked at each transaction's time, at a stored time, and as validity ends."""
    path = _folder(t, "store")
    for at in _STORED_AT:
        stored = store.materialise(t.txn, at, valid_hours=72)
        stored.write.mode("append").partitionBy("entity_type", "feature_window").parquet(path)
    asked = t.txn.select("transaction_id", "card_id", "timestamp")
    for suffix, at in (("-at", _STORED_AT[1]), ("-end", _STORED_AT[1] + timedelta(hours=72))):
        more = t.txn.select(F.concat("transaction_id", F.lit(suffix)).alias("transaction_id"), "card_id", F.lit(at).alias("timestamp"))
        asked = asked.unionByName(more)
    found = store.lookup_as_of(asked, t.spark.read.parquet(path))
    return plain(
        found.select("transaction_id", F.col("features")["txn_count"].cast("bigint").alias("card_txn_count"), "computed_at")
    )


@query(
    "p3_retention",
    "SELECT transaction_id, timestamp FROM order_txn WHERE timestamp >= TIMESTAMP '1999-06-01 00:00:00' - INTERVAL 730 DAY",
    ("order_txn",),
)
def _(t: Tables):
    kept = store.retained(t.order_txn, "transactions", datetime(1999, 6, 1))
    return plain(kept.select("transaction_id", "timestamp"))


@query(
    "p4_erasure",
    "SELECT transaction_id FROM txn WHERE NOT is_fraud",
    ("txn",),
)
def _(t: Tables):
    return store.erased(t.txn, t.txn.where("is_fraud")).select("transaction_id")


def _dated(t: Tables, name: str) -> str:
    """Transactions as a stored table, one folder for each date."""
    path = _folder(t, name)
    t.txn.withColumn("date", F.to_date("timestamp")).write.partitionBy("date").parquet(path)
    return path


@query(
    "p3_retention_stored",
    "SELECT transaction_id, timestamp FROM txn WHERE timestamp >= TIMESTAMP '2026-01-15 12:00:00' - INTERVAL 730 DAY",
    ("txn",),
)
def _(t: Tables):
    """Whole dates are removed, the date the period begins in is rewritten."""
    path = _dated(t, "retained")
    store.retain_stored(t.spark, path, "transactions", datetime(2026, 1, 15, 12))
    return plain(t.spark.read.parquet(path).select("transaction_id", "timestamp"))


@query("p4_erasure_stored", "SELECT transaction_id, amount FROM txn WHERE NOT is_fraud", ("txn",))
def _(t: Tables):
    path = _dated(t, "erased")
    store.erase_stored(t.spark, path, t.txn.where("is_fraud"))
    return plain(t.spark.read.parquet(path).select("transaction_id", "amount"))


@query(
    "o_drift_report_table",
    """SELECT 'first' AS batch_id, 'DATA_DRIFT' AS report_type, min(timestamp) AS current_start,
      max(timestamp) AS current_end, false AS compared, CAST(NULL AS BIGINT) AS columns FROM txn
      WHERE timestamp < TIMESTAMP '2024-01-16 00:00:00'
    UNION ALL SELECT 'second', 'DATA_DRIFT', min(timestamp), max(timestamp), true, 14 FROM txn
      WHERE timestamp >= TIMESTAMP '2024-01-16 00:00:00'""",
    ("txn",),
)
def _(t: Tables):
    """The first batch becomes the reference, the second is compared; both reports are stored."""
    folder = _folder(t, "drift")
    matrix = checkpointed(with_features(t.txn, keep=("transaction_id", "timestamp")))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    for name, rows in (("first", F.col("timestamp") < cut), ("second", F.col("timestamp") >= cut)):
        batch = matrix.where(rows)
        report = drift.detect_drift(t.spark, batch, name, f"{folder}/reference")
        drift.store_report(
            t.spark, f"{folder}/reports", report, "DATA_DRIFT", current_period=drift.period(batch)
        )
    found = drift.read_reports(t.spark, f"{folder}/reports")
    return plain(
        found.select(
            "batch_id", "report_type", "current_start", "current_end",
            F.col("drift_score").isNotNull().alias("compared"),
            F.get_json_object("metrics", "$.n_columns").cast("bigint").alias("columns"),
        )
    )


@query("n9_quality_after_injection", "SELECT true AS ranks_frauds_first, true AS beats_the_share")
def _(t: Tables):
    """Inject anomalies, fit on one part, score the other: injected rows rank first."""
    rows = injection.inject(_with_address(t), injection.AnomalyMix(rate=0.05)).select(*t.txn.columns)
    matrix = checkpointed(with_features(rows, keep=("transaction_id", "timestamp", "is_fraud")))
    split = checkpointed(sampling.stratified_split(matrix))
    names = feature_names(t.txn.columns)
    scorer = EnsembleScorer().fit(split.where("NOT is_test"), names)
    scored = scorer.score(split.where("is_test"))
    metrics = evaluation.ranking_metrics(scored)
    share = scored.agg(F.avg(F.col("is_fraud").cast("double"))).scalar()
    return metrics.select(
        (F.col("roc_auc") > 0.6).alias("ranks_frauds_first"), (F.col("pr_auc") > share).alias("beats_the_share")
    )


# --- anomaly injection ------------------------------------------------------------------------


def _hash(tag: str, column: str = "transaction_id") -> str:
    return f"CAST(concat('0x', substr(md5(concat('{tag}|', {column})), 1, 8)) AS BIGINT)"


def _unit(tag: str, column: str = "transaction_id") -> str:
    return f"({_hash(tag, column)} / 4294967296.0)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values: list[str], tag: str, column: str = "transaction_id") -> str:
    return f"({_list(values)})[{_hash(tag, column)} % {len(values)} + 1]"


_IP = (
    f"concat({_pick(injection.SUSPICIOUS_NETWORKS, 'net')}, {_hash('ip3')} % 256, '.', {_hash('ip4')} % 256)"
)


def _maximum(category: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN {v}" for c, v in injection.CATEGORY_MAXIMA.items())
    return f"CAST(CASE {category} {cases} ELSE {injection.DEFAULT_MAXIMUM} END AS DOUBLE)"


def _outlier(category: str) -> str:
    return f"round({_maximum(category)} * (10.0 + {_unit('outlier')} * 40.0), 2)"


def _with_address(t: Tables):
    return t.txn.withColumn("ip_address", F.lit(None).cast("string"))


def _injected(t: Tables, kind: str, columns: list[str]):
    return plain(injection.injected(_with_address(t), kind).select(*columns, "is_fraud"), 2)


@query(
    "r1_amount_outliers",
    f"""SELECT transaction_id, {_outlier('merchant_category')} AS amount,
    {_pick(injection.SUSPICIOUS_DOMAINS, 'mail')} AS email_domain, {_IP} AS ip_address,
    {_pick(injection.COUNTRIES, 'ship')} AS shipping_country, true AS is_fraud FROM txn""",
    ("txn",),
)
def _(t: Tables):
    columns = ["transaction_id", "amount", "email_domain", "ip_address", "shipping_country"]
    return _injected(t, "amount_outlier", columns)


_BURST = f"""WITH b AS (SELECT concat(transaction_id, '_v', i) AS transaction_id, timestamp, card_id, i
  FROM txn, range(0, 5) r(i)), c AS (SELECT *, {_pick(list(injection.CATEGORY_MAXIMA), 'burst')} AS category FROM b)
 SELECT transaction_id, timestamp + to_minutes(i * (1 + {_hash('step')} % 2)) AS timestamp, card_id,
  concat(category, '_', {_hash('shop')} % 50) AS merchant_id, category AS merchant_category,
  round({_maximum('category')} * (0.01 + {_unit('paid')} * 0.99), 2) AS amount,
  concat('device_', substr(md5(transaction_id), 1, 8)) AS device_id, {_IP} AS ip_address, true AS is_fraud FROM c"""


@query("r2_velocity_bursts", _BURST, ("txn",))
def _(t: Tables):
    columns = [
        "transaction_id", "timestamp", "card_id", "merchant_id", "merchant_category", "amount",
        "device_id", "ip_address",
    ]
    return _injected(t, "velocity", columns)


def _other(tag: str) -> str:
    others = f"list_filter({_list(injection.COUNTRIES)}, lambda x: x <> coalesce(billing_country, 'USA'))"
    return f"({others})[{_hash(tag)} % 9 + 1]"


@query(
    "r3_geographic",
    f"""SELECT transaction_id, {_other('ship')} AS shipping_country, {_other('card')} AS card_country,
    {_IP} AS ip_address, true AS is_fraud FROM txn""",
    ("txn",),
)
def _(t: Tables):
    return _injected(t, "geographic", ["transaction_id", "shipping_country", "card_country", "ip_address"])


@query(
    "r4_off_hours",
    f"""SELECT transaction_id, CASE WHEN {_unit('moved')} < 0.3
     THEN date_trunc('day', timestamp) + to_hours(1 + {_hash('hour')} % 4) + (timestamp - date_trunc('hour', timestamp))
     ELSE timestamp END AS timestamp, round(amount * (2.0 + {_unit('factor')} * 3.0), 2) AS amount,
     {_IP} AS ip_address, true AS is_fraud FROM txn""",
    ("txn",),
)
def _(t: Tables):
    return _injected(t, "off_hours", ["transaction_id", "timestamp", "amount", "ip_address"])


@query(
    "r5_near_duplicates",
    f"""WITH d AS (SELECT concat(transaction_id, '_d') AS transaction_id, timestamp, amount, merchant_id, card_id
      FROM txn WHERE NOT is_fraud)
    SELECT transaction_id, timestamp + to_seconds(1 + {_hash('late')} % 29) AS timestamp, amount, merchant_id,
     card_id, true AS is_fraud FROM d""",
    ("txn",),
)
def _(t: Tables):
    return _injected(t, "duplicate", ["transaction_id", "timestamp", "amount", "merchant_id", "card_id"])


@query(
    "r6_unusual_merchants",
    f"""SELECT transaction_id, concat('electronics_', {_hash('shop')} % 50) AS merchant_id,
    'electronics' AS merchant_category, {_outlier("'electronics'")} AS amount,
    {_pick(injection.SUSPICIOUS_DOMAINS, 'mail')} AS email_domain, true AS is_fraud FROM txn""",
    ("txn",),
)
def _(t: Tables):
    columns = ["transaction_id", "merchant_id", "merchant_category", "amount", "email_domain"]
    return _injected(t, "merchant", columns)


def _limits() -> list[tuple[str, float]]:
    mix, upper, out = injection.AnomalyMix(rate=0.2), 0.0, []
    for name, share in mix.shares().items():
        upper += mix.rate * share / (injection.BURST_ROWS if name == "velocity" else 1)
        out.append((name, upper))
    return out


_KIND = "CASE " + " ".join(f"WHEN u < {limit!r} THEN '{n}'" for n, limit in _limits()) + " END"


@query(
    "r_injected_table",
    f"""WITH k AS (SELECT *, {_KIND} AS kind FROM (SELECT *, {_unit('inject')} AS u FROM txn) x)
    SELECT is_fraud, count(*) AS rows, count(DISTINCT transaction_id) AS ids FROM (
     SELECT transaction_id, CASE WHEN kind IS NULL OR kind IN ('velocity', 'duplicate') THEN is_fraud ELSE true END AS is_fraud FROM k
     UNION ALL SELECT concat(transaction_id, '_v', i), true FROM k, range(0, 5) r(i) WHERE kind = 'velocity'
     UNION ALL SELECT concat(transaction_id, '_d'), true FROM k WHERE kind = 'duplicate' AND NOT is_fraud) a
    GROUP BY is_fraud""",
    ("txn",),
)
def _(t: Tables):
    out = injection.inject(_with_address(t), injection.AnomalyMix(rate=0.2))
    return out.groupBy("is_fraud").agg(
        F.count("*").alias("rows"), F.count_distinct("transaction_id").alias("ids")
    )


# --- streams ----------------------------------------------------------------------------------

_STREAM_RULES = f"""WITH f AS (SELECT transaction_id, amount AS raw_amount, {', '.join(FAST_SQL)} FROM txn)
 SELECT transaction_id, round(least(greatest(
  0.25 * least(greatest(ln(1 + raw_amount / 5000) / ln(11), 0), 1) * CASE WHEN raw_amount > 5000 THEN 1 ELSE 0.3 END
  + 0.10 * CASE WHEN is_night = 1 AND raw_amount > 500 THEN 0.8 WHEN is_night = 1 THEN 0.3 ELSE 0 END
  + 0.15 * CASE WHEN country_mismatch = 1 THEN 0.7 ELSE 0 END
  + 0.10 * CASE WHEN suspicious_email = 1 THEN 0.8 ELSE 0 END, 0), 1), 6) + 0.0 AS rule_score FROM f"""


#: Rows a landed file is meant to hold, so that no task writes or reads a share of the whole table.
_LANDED_ROWS = 250_000


def _files_a_slice(rows: int, slices: int) -> int:
    return max(1, -(-rows // (slices * _LANDED_ROWS)))


def _landed(t: Tables, slices: int) -> tuple[str, int]:
    """Transactions as a folder of files, ordered by time, for a stream to pick up; files a slice of time."""
    path, files = _folder(t, "landing"), _files_a_slice(t.txn.count(), slices)
    t.txn.repartitionByRange(slices * files, "timestamp").write.parquet(path)
    # streams take files by their time of change, which parallel writers do not keep in order
    folder = t.spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(t.spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in system.listStatus(folder) if f.getPath().getName().startswith("part"))
    for k, name in enumerate(names):
        system.setTimes(t.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), 1_700_000_000_000 + 1000 * k, -1)
    return path, files


def _stream(t: Tables, slices: int, per_trigger: int | None = None):
    """The table as a stream; ``per_trigger`` are slices of time a micro-batch takes."""
    path, files = _landed(t, slices)
    files_per_trigger = per_trigger and per_trigger * files
    return jobs.transaction_stream(t.spark, path, t.txn.schema, files_per_trigger=files_per_trigger)


def _drained(t: Tables, stream, name: str):
    """Run a stream over all that is there, into files, and read them back."""
    out = _folder(t, name)
    running = (
        stream.writeStream.format("parquet")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{out}/data")


@query(
    "s1_incremental_scoring",
    """SELECT transaction_id, CAST(1 AS BIGINT) AS times, CAST(1 AS BIGINT) AS same_score,
     CAST(1 AS BIGINT) AS same_flag FROM txn""",
    ("txn",),
)
def _(t: Tables):
    """Every row scored once by the stream, as the batch scores it with the same frozen range."""
    names = feature_names(t.txn.columns)
    matrix = checkpointed(with_features(t.txn))
    scorer = EnsembleScorer().fit(matrix, names)
    folder = _folder(t, "scoring")
    jobs.incremental_scoring(_stream(t, 2, 1), folder, scorer).awaitTermination()
    got = tables.read_scores(t.spark, f"{folder}/scores").groupBy("transaction_id").agg(
        F.count("*").alias("times"), F.max("ensemble_score").alias("got"), F.max("is_flagged").alias("flag")
    )
    want = scorer.score(matrix).select("transaction_id", F.col("ensemble_score").alias("want"))
    both = want.join(got, "transaction_id", "left")
    near = F.abs(F.col("got").cast("double") - F.col("want")) < 0.000051  # stored with four decimals
    agree = (F.col("flag") == (F.col("want") >= 0.5)) | (F.abs(F.col("want") - 0.5) < 1e-9)
    return plain(
        both.select(
            "transaction_id", "times", F.coalesce(near, F.lit(False)).cast("int").alias("same_score"),
            F.coalesce(agree, F.lit(False)).cast("int").alias("same_flag"),
        )
    )


@query("s2_stream_rules", _STREAM_RULES, ("txn",))
def _(t: Tables):
    stream = jobs.rule_scores(_stream(t, 4)).select("transaction_id", "rule_score")
    return plain(_drained(t, stream, "rules"))


@query(
    "s3_stream_history",
    f"SELECT transaction_id, {', '.join(HISTORY_SQL)} FROM txn",
    ("txn",),
)
def _(t: Tables):
    """The table lands in three time slices, with one run of the stream after each; all columns."""
    folder, landing = _folder(t, "history"), _folder(t, "landing")
    groups = FeatureGroups(temporal=False, risk=False)
    at = F.col("timestamp")
    first, second = F.lit(datetime(2024, 1, 11)), F.lit(datetime(2024, 1, 21))
    for rows in (at < first, (at >= first) & (at < second), at >= second):
        t.txn.where(rows).write.mode("append").parquet(landing)
        stream = jobs.transaction_stream(t.spark, landing, t.txn.schema)
        jobs.trailing_features(stream, folder, groups).awaitTermination()
    found = t.spark.read.parquet(f"{folder}/features").drop("epoch", "amount", "amount_log")
    return plain(found, fine=FINE)


@query("s4_stream_without_repeats", "SELECT transaction_id, amount FROM txn", ("txn",))
def _(t: Tables):
    path, _ = _landed(t, 2)
    t.txn.write.mode("append").parquet(path)
    stream = jobs.transaction_stream(t.spark, path, t.txn.schema)
    unique = jobs.without_repeats(stream, delay="60 days").select("transaction_id", "amount")
    return plain(_drained(t, unique, "unique"))


@query(
    "s5_velocity_panel",
    """SELECT card_id, window_start, count(*) AS txn_count, round(sum(amount), 4) AS amount_sum FROM (
     SELECT card_id, amount, date_trunc('hour', timestamp) - to_hours(i) AS window_start
     FROM txn, range(0, 24) r(i) WHERE card_id IS NOT NULL) x GROUP BY card_id, window_start""",
    ("txn",),
)
def _(t: Tables):
    return plain(jobs.velocity_panel(t.txn, delay=None), 4)
