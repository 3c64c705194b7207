"""Queries on filters, joins, aggregations, rankings, set operations and data quality."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from riskloom.monitoring import quality
from riskloom.operators import relational as rel
from riskloom.operators import sampling
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import plain, query
from riskloom.schema import SCORING_RESULTS, canonical_transactions, conform
from riskloom.session import shared_dir
from riskloom.sources.pending import PendingTables

AS_OF = datetime(2024, 1, 31)

_TXN_PLAIN = (
    "transaction_id, timestamp, amount, merchant_id, merchant_category, card_id, card_type, is_online"
)

# --- extraction, filters, joins ---------------------------------------------------------------


@query(
    "a7_insert_if_absent",
    """SELECT transaction_id, min(batch_id) AS batch_id FROM (
      SELECT t.transaction_id, 'batch_new' AS batch_id FROM txn t
      UNION ALL SELECT t.transaction_id, 'batch_new' FROM txn t) n
    WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.transaction_id = n.transaction_id)
    GROUP BY transaction_id""",
    ("txn", "scores"),
)
def _(t: Tables):
    incoming = t.txn.select("transaction_id", F.lit("batch_new").alias("batch_id"))
    return rel.insert_if_absent(t.scores, incoming.unionByName(incoming), ["transaction_id"])


@query(
    "a8_extract_unscored",
    f"""SELECT {_TXN_PLAIN} FROM txn t WHERE data_source = 'SYNTHETIC'
    AND NOT EXISTS (SELECT 1 FROM scores s WHERE s.transaction_id = t.transaction_id)
    ORDER BY timestamp, transaction_id LIMIT 10000""",
    ("txn", "scores"),
)
def _(t: Tables):
    batch = rel.extract_unscored_batch(t.txn, t.scores, data_source="SYNTHETIC")
    return plain(batch.select(*[c.strip() for c in _TXN_PLAIN.split(",")]))


_UNSCORED = f"""SELECT {_TXN_PLAIN} FROM txn t WHERE data_source = 'SYNTHETIC'
    AND NOT EXISTS (SELECT 1 FROM scores s WHERE s.transaction_id = t.transaction_id)
    ORDER BY timestamp, transaction_id LIMIT {{}}"""


def _pending(t: Tables) -> PendingTables:
    """Bucketed tables filled in three steps: two thirds of the rows, the scores, and the rest late."""
    at = uuid.uuid4().hex
    tables = PendingTables(t.spark, f"{shared_dir(t.spark)}/pending-{at}", f"pending_{at}", buckets=8)
    rows = canonical_transactions(t.txn)
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    tables.add_transactions(rows.where(~late))
    tables.add_scores(conform(t.scores.withColumn("flag_threshold", F.lit(0.5)), SCORING_RESULTS), rows.where(~late))
    tables.add_transactions(rows.where(late))
    tables.add_scores(conform(t.scores.withColumn("flag_threshold", F.lit(0.5)), SCORING_RESULTS), rows)
    return tables


@query("a8_pending_batch", _UNSCORED.format(10000), ("txn", "scores"))
def _(t: Tables):
    batch = _pending(t).next_batch(10_000, "SYNTHETIC")
    return plain(batch.select(*[c.strip() for c in _TXN_PLAIN.split(",")]))


@query("a8_pending_first_days", _UNSCORED.format(40), ("txn", "scores"))
def _(t: Tables):
    batch = _pending(t).next_batch(40, "SYNTHETIC")
    return plain(batch.select(*[c.strip() for c in _TXN_PLAIN.split(",")]))


@query(
    "d2_pending_days",
    """SELECT CAST(timestamp AS DATE) AS day, data_source, CAST(count(*) AS BIGINT) AS rows FROM txn t
    WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.transaction_id = t.transaction_id) GROUP BY 1, 2""",
    ("txn", "scores"),
)
def _(t: Tables):
    return _pending(t).pending()


@query("c1_flagged", "SELECT transaction_id, batch_id FROM scores WHERE is_flagged", ("scores",))
def _(t: Tables):
    return rel.flagged_only(t.scores).select("transaction_id", "batch_id")


@query(
    "c2_alerts",
    "SELECT transaction_id, ensemble_score FROM scores WHERE ensemble_score > 0.8",
    ("scores",),
)
def _(t: Tables):
    return plain(rel.alerts(t.scores))


@query(
    "c3_recent_failures",
    """SELECT timestamp, batch_id, operation, status, records_processed, duration_seconds FROM audit_log
    WHERE status = 'FAILED' AND timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR""",
    ("audit_log",),
)
def _(t: Tables):
    return plain(rel.recent_failures(t.audit_log, AS_OF, 240))


@query(
    "c4_batch_history",
    """SELECT timestamp, batch_id, operation, status, records_processed, duration_seconds
    FROM audit_log WHERE batch_id = 'batch_3'""",
    ("audit_log",),
)
def _(t: Tables):
    return plain(rel.batch_history(t.audit_log, "batch_3"))


@query(
    "c5_optional_source",
    """SELECT t.transaction_id, t.data_source FROM txn t
    WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.transaction_id = t.transaction_id)
    ORDER BY timestamp, transaction_id LIMIT 500""",
    ("txn", "scores"),
)
def _(t: Tables):
    return rel.extract_unscored_batch(t.txn, t.scores, 500).select("transaction_id", "data_source")


@query(
    "c6_membership",
    """SELECT merchant_category, CAST(count(*) AS BIGINT) AS n FROM txn
    WHERE merchant_category IN ('jewelry', 'luxury', 'electronics', 'travel', 'gambling',
     'cryptocurrency', 'wire_transfer', 'gift_cards') GROUP BY merchant_category""",
    ("txn",),
)
def _(t: Tables):
    from riskloom.operators.features import HIGH_RISK_CATEGORIES

    rows = t.txn.where(F.col("merchant_category").isin(HIGH_RISK_CATEGORIES))
    return rows.groupBy("merchant_category").agg(F.count("*").alias("n"))


@query(
    "d2_unscored",
    """SELECT t.transaction_id, t.amount FROM txn t LEFT JOIN scores s
    ON t.transaction_id = s.transaction_id WHERE s.transaction_id IS NULL""",
    ("txn", "scores"),
)
def _(t: Tables):
    return plain(rel.unscored(t.txn, t.scores).select("transaction_id", "amount"))


@query(
    "d3_flagged_view",
    """SELECT t.transaction_id, t.timestamp, t.amount, t.merchant_id, t.merchant_category, t.card_id,
     t.is_online, s.ensemble_score, s.rule_score, s.isolation_forest_score, s.autoencoder_score,
     CAST(NULL AS VARCHAR) AS reason_codes, s.scored_at, s.batch_id, t.is_fraud AS ground_truth
    FROM txn t JOIN scores s ON t.transaction_id = s.transaction_id WHERE s.is_flagged""",
    ("txn", "scores"),
)
def _(t: Tables):
    return plain(rel.flagged_transactions(t.txn, t.scores))


@query(
    "d4_with_labels",
    """SELECT s.transaction_id, s.ensemble_score, t.is_fraud FROM scores s
    LEFT JOIN txn t ON s.transaction_id = t.transaction_id""",
    ("txn", "scores"),
)
def _(t: Tables):
    out = rel.with_labels(t.scores, t.txn)
    return plain(out.select("transaction_id", "ensemble_score", "is_fraud"))


@query(
    "d6_keyed_columns",
    """SELECT t.transaction_id, t.amount, s.ensemble_score, s.batch_id FROM txn t
    JOIN scores s ON t.transaction_id = s.transaction_id""",
    ("txn", "scores"),
)
def _(t: Tables):
    out = t.txn.select("transaction_id", "amount").join(t.scores, "transaction_id")
    return plain(out.select("transaction_id", "amount", "ensemble_score", "batch_id"))


# --- aggregations -----------------------------------------------------------------------------


@query(
    "e1_totals_by_label",
    """SELECT is_fraud, count(*) AS count, round(avg(amount), 6) AS avg_amount, max(amount) AS max_amount
    FROM txn WHERE data_source = 'SYNTHETIC' GROUP BY is_fraud""",
    ("txn",),
)
def _(t: Tables):
    return plain(rel.totals_by_label(t.txn))


@query(
    "e2_batch_summary",
    """SELECT batch_id, min(scored_at) AS batch_start, max(scored_at) AS batch_end,
     count(*) AS total_scored, CAST(sum(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS total_flagged,
     round(avg(ensemble_score), 6) AS avg_score,
     round(quantile_cont(ensemble_score, 0.5), 6) AS median_score,
     round(quantile_cont(ensemble_score, 0.95), 6) AS p95_score
    FROM scores GROUP BY batch_id""",
    ("scores",),
)
def _(t: Tables):
    return plain(rel.batch_summary(t.scores))


@query(
    "e3_batch_statistics",
    """SELECT count(*) AS total, CAST(sum(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
     round(avg(CASE WHEN is_flagged THEN 1.0 ELSE 0 END), 6) AS flag_rate,
     round(avg(ensemble_score), 6) AS mean_score, round(max(ensemble_score), 6) AS max_score,
     round(quantile_cont(ensemble_score, 0.95), 6) AS p95_score FROM scores""",
    ("scores",),
)
def _(t: Tables):
    return plain(rel.batch_statistics(t.scores))


_STATS = """SELECT {count} AS total_transactions,
     round(avg(CASE WHEN is_fraud THEN 1.0 ELSE 0 END), 6) AS fraud_rate,
     {cards} AS unique_cards, min(timestamp) AS start, max(timestamp) AS "end",
     round(avg(amount), 6) AS amount_mean, round(stddev_samp(amount), 4) AS amount_std,
     min(amount) AS amount_min, max(amount) AS amount_max,
     round(quantile_cont(amount, 0.5), 6) AS amount_median FROM txn {rows}"""


@query(
    "e4_dataset_statistics",
    _STATS.format(count="count(*)", cards="count(DISTINCT card_id)", rows=""),
    ("txn",),
)
def _(t: Tables):
    return plain(rel.dataset_statistics(t.txn), fine={"amount_std": 4})


_HASHED = "CAST(concat('0x', substr(md5(concat('42|', transaction_id)), 1, 8)) AS BIGINT)"


@query(
    "e4_sampled_statistics",
    _STATS.format(
        count="count(*) * 10",
        cards="count(DISTINCT card_id) * 10",
        rows=f"WHERE {_HASHED} < 429496729",
    ),
    ("txn",),
)
def _(t: Tables):
    return plain(rel.dataset_statistics(t.txn, sample=0.1), fine={"amount_std": 4})


@query(
    "e5_value_counts",
    "SELECT merchant_category, count(*) AS count FROM txn GROUP BY merchant_category",
    ("txn",),
)
def _(t: Tables):
    return rel.value_counts(t.txn, "merchant_category")


@query(
    "e6_generation_summary",
    """SELECT count(*) AS total_transactions,
     CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_transactions,
     round(avg(CASE WHEN is_fraud THEN 1.0 ELSE 0 END), 6) AS fraud_rate,
     count(DISTINCT card_id) AS unique_cards, count(DISTINCT merchant_id) AS unique_merchants,
     min(timestamp) AS first_at, max(timestamp) AS last_at FROM txn""",
    ("txn",),
)
def _(t: Tables):
    return plain(rel.generation_summary(t.txn))


# --- sorts, limits, set operations, scalar functions ------------------------------------------


@query("g1_sorted", "SELECT transaction_id, timestamp FROM txn ORDER BY timestamp", ("txn",))
def _(t: Tables):
    return plain(t.txn.select("transaction_id", "timestamp").orderBy("timestamp"))


@query(
    "g2_top_flagged",
    """SELECT s.transaction_id, s.ensemble_score, t.amount, t.is_fraud FROM scores s
    JOIN txn t ON s.transaction_id = t.transaction_id WHERE s.is_flagged
    ORDER BY s.ensemble_score DESC, s.transaction_id LIMIT 5""",
    ("txn", "scores"),
)
def _(t: Tables):
    scored = t.scores.join(t.txn.select("transaction_id", "amount", "is_fraud"), "transaction_id")
    return plain(rel.top_flagged(scored, 5))


@query(
    "g3_latest_audit",
    """SELECT timestamp, batch_id, operation, status, records_processed, duration_seconds
    FROM audit_log ORDER BY timestamp DESC LIMIT 10""",
    ("audit_log",),
)
def _(t: Tables):
    return plain(rel.latest(t.audit_log, 10))


_G4 = """WITH long AS (
 SELECT transaction_id, 0 AS p, 'ensemble' AS feature, ensemble_score AS v FROM scores
 UNION ALL SELECT transaction_id, 1, 'rules', rule_score FROM scores
 UNION ALL SELECT transaction_id, 2, 'forest', isolation_forest_score FROM scores),
ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY v DESC, p DESC) AS k FROM long)
SELECT transaction_id, string_agg(feature, ',' ORDER BY k) AS top_features FROM ranked WHERE k <= 2
GROUP BY transaction_id"""


@query("g4_top_features_per_row", _G4, ("scores",))
def _(t: Tables):
    pairs = [
        ("ensemble", F.col("ensemble_score")),
        ("rules", F.col("rule_score")),
        ("forest", F.col("isolation_forest_score")),
    ]
    top = F.transform(rel.top_per_row(pairs, 2), lambda e: e["feature"])
    return t.scores.select("transaction_id", F.concat_ws(",", top).alias("top_features"))


@query(
    "h1_row_union",
    """SELECT transaction_id, card_id, amount, customer_id FROM txn
    UNION ALL SELECT transaction_id, card_id, amount, NULL FROM order_txn""",
    ("txn", "order_txn"),
)
def _(t: Tables):
    both = t.txn.unionByName(t.order_txn, allowMissingColumns=True)
    return plain(both.select("transaction_id", "card_id", "amount", "customer_id"))


@query(
    "i_scalar_functions",
    """SELECT transaction_id, round(ln(1 + amount), 6) AS log_amount, round(abs(amount - 500), 6) AS distance,
     least(greatest(amount / 5000, 0), 1) AS clipped, lower(card_type) AS card_type,
     starts_with(email_domain, 'temp') AS temporary, timestamp - INTERVAL 24 HOUR AS day_before,
     printf('$%.2f', amount) AS shown, substr(md5(customer_id), 1, 8) AS device
    FROM txn""",
    ("txn",),
)
def _(t: Tables):
    amount = F.col("amount").cast("double")
    return plain(
        t.txn.select(
            "transaction_id",
            F.log1p(amount).alias("log_amount"),
            F.abs(amount - 500).alias("distance"),
            F.least(F.greatest(amount / 5000, F.lit(0.0)), F.lit(1.0)).alias("clipped"),
            F.lower("card_type").alias("card_type"),
            F.startswith("email_domain", F.lit("temp")).alias("temporary"),
            (F.col("timestamp") - F.expr("INTERVAL 24 HOURS")).alias("day_before"),
            F.format_string("$%.2f", amount).alias("shown"),
            F.substring(F.md5("customer_id"), 1, 8).alias("device"),
        ),
        digits=6,
    )


# --- data quality -----------------------------------------------------------------------------

_NOT_NULL, _UNIQUE = "expect_column_values_to_not_be_null", "expect_column_values_to_be_unique"
_EXISTS, _BETWEEN = "expect_column_to_exist", "expect_column_values_to_be_between"


def _suite_sql() -> str:
    found = """WITH c AS (SELECT count(*) - count(transaction_id) AS transaction_id,
      count(*) - count(timestamp) AS timestamp, count(*) - count(amount) AS amount,
      count(*) - count(card_id) AS card_id, count(*) - count(merchant_id) AS merchant_id,
      count(*) FILTER (WHERE amount < 0 OR amount > 1000000) AS outside FROM dq_txn),
    u AS (SELECT coalesce(sum(n), 0) AS repeated FROM (SELECT count(*) AS n FROM dq_txn
      WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING count(*) > 1) x)"""
    lines = []
    for expectation, column in quality.SUITE:
        number = {
            _EXISTS: "0",
            _NOT_NULL: f"(SELECT {column} FROM c)",
            _UNIQUE: "(SELECT repeated FROM u)",
            _BETWEEN: "(SELECT outside FROM c)",
        }[expectation]
        lines.append(
            f"SELECT '{expectation}' AS expectation, '{column}' AS \"column\", "
            f"CAST({number} AS BIGINT) AS unexpected_count"
        )
    return (
        f"{found} SELECT expectation, \"column\", unexpected_count, unexpected_count = 0 AS success "
        f"FROM ({' UNION ALL '.join(lines)}) r"
    )


@query("j2_expectation_suite", _suite_sql(), ("dq_txn",))
def _(t: Tables):
    return quality.expectation_suite(t.dq_txn).drop("position")


_BASIC = """WITH c AS (SELECT count(*) AS rows, count(*) - count(transaction_id) AS null_ids,
  count(DISTINCT transaction_id) + CASE WHEN count(*) > count(transaction_id) THEN 1 ELSE 0 END AS ids,
  count(*) FILTER (WHERE amount < 0 OR amount > 1000000) AS outside,
  count(*) - count(amount) AS null_amounts FROM dq_txn),
 r AS (""" + " UNION ALL ".join(
    [
        f"SELECT 'column_exists' AS expectation, '{c}' AS \"column\", CAST(0 AS BIGINT) AS unexpected_count"
        for c in quality.REQUIRED_COLUMNS
    ]
    + [
        "SELECT 'no_null_transaction_ids', 'transaction_id', CAST(null_ids AS BIGINT) FROM c",
        "SELECT 'unique_transaction_ids', 'transaction_id', CAST(rows - ids AS BIGINT) FROM c",
        "SELECT 'valid_amount_range', 'amount', CAST(outside AS BIGINT) FROM c",
        "SELECT 'no_null_amounts', 'amount', CAST(null_amounts AS BIGINT) FROM c",
    ]
) + ") SELECT *, unexpected_count = 0 AS success FROM r"


@query("j3_basic_suite", _BASIC, ("dq_txn",))
def _(t: Tables):
    return quality.basic_suite(t.dq_txn).drop("position")


_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END), 6) AS null_rate,
    {f'round(avg({c}), 4)' if c == 'amount' else 'CAST(NULL AS DOUBLE)'} AS mean,
    {f'round(stddev_samp({c}), 4)' if c == 'amount' else 'CAST(NULL AS DOUBLE)'} AS std,
    {f'round(min({c}), 4)' if c == 'amount' else 'CAST(NULL AS DOUBLE)'} AS min,
    {f'round(max({c}), 4)' if c == 'amount' else 'CAST(NULL AS DOUBLE)'} AS max FROM dq_txn"""
    for c in ("transaction_id", "timestamp", "amount", "merchant_id", "card_id")
)


@query("j5_batch_profile", _PROFILE, ("dq_txn",))
def _(t: Tables):
    return plain(quality.batch_profile(t.dq_txn), 4, fine={"null_rate": 6})


@query(
    "j5_batch_quality",
    """SELECT CAST(sum(n) AS BIGINT) AS rows, round((sum(n) - count(*)) / sum(n), 6) AS duplicate_rate,
    true AS schema_ok FROM (SELECT count(*) AS n FROM dq_txn GROUP BY transaction_id) x""",
    ("dq_txn",),
)
def _(t: Tables):
    return plain(quality.batch_quality(t.dq_txn))


# --- samples and splits -----------------------------------------------------------------------


@query(
    "q1_hash_sample",
    f"SELECT transaction_id, amount FROM txn WHERE {_HASHED} < 1073741824",
    ("txn",),
)
def _(t: Tables):
    return plain(sampling.hash_sample(t.txn, 0.25).select("transaction_id", "amount"))


_SPLIT = f"""SELECT transaction_id, is_fraud,
  row_number() OVER (PARTITION BY is_fraud ORDER BY {_HASHED}, transaction_id)
  <= floor(count(*) OVER (PARTITION BY is_fraud) * 0.2 + 0.5) AS is_test FROM txn"""


@query("q2_stratified_split", _SPLIT, ("txn",))
def _(t: Tables):
    split = sampling.stratified_split(t.txn)
    return split.select("transaction_id", "is_fraud", "is_test")


@query(
    "q2_split_summary",
    f"""SELECT is_test, count(*) AS rows, round(avg(CASE WHEN is_fraud THEN 1.0 ELSE 0 END), 6) AS fraud_rate
    FROM ({_SPLIT}) s GROUP BY is_test""",
    ("txn",),
)
def _(t: Tables):
    return plain(sampling.split_summary(sampling.stratified_split(t.txn)))
