"""Queries on drift and evaluation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from riskloom.monitoring import drift, evaluation
from riskloom.operators.features import FeatureGroups, with_features
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import plain, query
from riskloom.plans.registry.history import counts_sql, gap_sql, stats_sql
from riskloom.plans.registry.mapping import BASE_SQL, RISK_SQL, TEMPORAL_SQL

_CUT = datetime(2024, 1, 16)

# Both engines group on equal values, so both sides round the features the same way first.
_FEATURES_SQL = (
    "SELECT transaction_id, timestamp, "
    + ", ".join(
        BASE_SQL
        + TEMPORAL_SQL
        + RISK_SQL
        + [gap_sql("card_id"), *counts_sql("card_id"), *stats_sql("card_id", ("zscore",))]
    )
    + " FROM txn"
)
_REF = "timestamp < TIMESTAMP '2024-01-16 00:00:00'"


def _sides(t: Tables):
    """Feature rows before and from the cut, rounded."""
    names = drift.NUMERIC_FEATURES + drift.CATEGORICAL_FEATURES
    features = with_features(t.txn, FeatureGroups(), keep=("transaction_id", "timestamp"))
    out = plain(
        features.select("transaction_id", "timestamp", *names), fine={"card_amount_zscore_24h": 4}
    )
    cut = F.lit(_CUT).cast("timestamp_ntz")
    return out.where(F.col("timestamp") < cut), out.where(F.col("timestamp") >= cut)


_LONG_NUMERIC = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, {_REF} AS r FROM f" for f in drift.NUMERIC_FEATURES
)
_NUMERIC_BODY = f"""WITH f AS ({_FEATURES_SQL}), l AS ({_LONG_NUMERIC}),
 g AS (SELECT feature, v, count(*) FILTER (WHERE r) AS nr, count(*) FILTER (WHERE NOT r) AS nc FROM l GROUP BY feature, v),
 c AS (SELECT feature, v, nr, nc,
   sum(nr) OVER w / sum(nr) OVER (PARTITION BY feature) AS fr,
   sum(nc) OVER w / sum(nc) OVER (PARTITION BY feature) AS fc,
   lead(v) OVER (PARTITION BY feature ORDER BY v) AS nv,
   sum(nr) OVER (PARTITION BY feature) AS tr, sum(nc) OVER (PARTITION BY feature) AS tc
   FROM g WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
 k AS (SELECT feature, max(abs(fr - fc)) AS d, sum(abs(fr - fc) * coalesce(nv - v, 0)) AS w1,
   max(tr) AS tr, max(tc) AS tc FROM c GROUP BY feature),
 s AS (SELECT feature, stddev_pop(v) AS sd FROM l WHERE r GROUP BY feature),
 q AS (SELECT k.feature, d, w1 / greatest(sd, 1e-3) AS w, sqrt(tr * tc / (tr + tc)) * d AS lam
   FROM k JOIN s ON k.feature = s.feature),
 p AS (SELECT feature, d, w, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest((
   SELECT sum((CASE WHEN i % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) x(i)), 0), 1) END AS pv FROM q)"""


@query(
    "o1_numeric_drift",
    _NUMERIC_BODY
    + """ SELECT feature, round(d, 6) AS ks_statistic, round(pv, 6) AS p_value, round(w, 6) AS wasserstein,
    pv < 0.05 AS drift_detected FROM p""",
    ("txn",),
)
def _(t: Tables):
    return plain(drift.numeric_drift(*_sides(t)))


_LONG_CATEGORY = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS v, {_REF} AS r FROM f"
    for f in drift.CATEGORICAL_FEATURES
)
_CATEGORY_BODY = f"""WITH f AS ({_FEATURES_SQL}), l AS ({_LONG_CATEGORY}),
 g AS (SELECT feature, v, CAST(count(*) FILTER (WHERE r) AS DOUBLE) AS nr,
   CAST(count(*) FILTER (WHERE NOT r) AS DOUBLE) AS nc FROM l GROUP BY feature, v),
 t AS (SELECT *, sum(nr) OVER (PARTITION BY feature) AS tr, sum(nc) OVER (PARTITION BY feature) AS tc FROM g),
 u AS (SELECT feature, nr, nc, tr, tc, nr / tr AS p, nc / tc AS q, (nr / tr + nc / tc) / 2 AS m,
   (nr + nc) * tr / (tr + tc) AS er, (nr + nc) * tc / (tr + tc) AS ec FROM t),
 j AS (SELECT feature, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END)
   + (CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END)) / 2, 0)) AS js,
   sum((nr - er) * (nr - er) / er + (nc - ec) * (nc - ec) / ec) AS chi FROM u GROUP BY feature)"""


@query(
    "o2_categorical_drift",
    _CATEGORY_BODY
    + """ SELECT feature, round(js, 6) AS js_distance, round(chi, 6) AS chi_square,
    js >= 0.1 AS drift_detected FROM j""",
    ("txn",),
)
def _(t: Tables):
    return plain(drift.categorical_drift(*_sides(t)))


@query(
    "o3_dataset_drift",
    f"""WITH n AS ({_NUMERIC_BODY} SELECT feature, pv < 0.05 AS hit FROM p),
    c AS ({_CATEGORY_BODY} SELECT feature, js >= 0.1 AS hit FROM j),
    v AS (SELECT * FROM n UNION ALL SELECT * FROM c)
    SELECT count(*) AS n_columns, count(*) FILTER (WHERE hit) AS n_drifted_columns,
    round(count(*) FILTER (WHERE hit) / count(*), 6) AS drift_share,
    count(*) FILTER (WHERE hit) / count(*) >= 0.5 AS drift_detected FROM v""",
    ("txn",),
)
def _(t: Tables):
    return plain(drift.dataset_drift(drift.column_drift(*_sides(t))))


@query(
    "o4_drift_tests",
    f"""WITH n AS ({_NUMERIC_BODY} SELECT feature, pv < 0.05 AS hit FROM p),
    c AS ({_CATEGORY_BODY} SELECT feature, js >= 0.1 AS hit FROM j),
    v AS (SELECT * FROM n UNION ALL SELECT * FROM c)
    SELECT 'share_of_drifted_columns' AS name,
     CASE WHEN count(*) FILTER (WHERE hit) / count(*) < 0.3 THEN 'SUCCESS' ELSE 'FAIL' END AS status FROM v
    UNION ALL SELECT concat('column_drift:', feature), CASE WHEN hit THEN 'FAIL' ELSE 'SUCCESS' END FROM n
    WHERE feature IN ('amount', 'amount_log', 'hour_sin', 'hour_cos', 'card_hours_since_last')""",
    ("txn",),
)
def _(t: Tables):
    return drift.drift_tests(drift.column_drift(*_sides(t))).select("name", "status")


# --- evaluation -------------------------------------------------------------------------------

_LABELLED = "SELECT s.*, t.is_fraud, t.amount, t.merchant_category, t.timestamp FROM scores s JOIN txn t ON s.transaction_id = t.transaction_id"
_REPORT = """count(*) AS n_samples,
 round(count(*) FILTER (WHERE is_fraud) / count(*), 6) AS fraud_rate,
 round(count(*) FILTER (WHERE is_flagged) / count(*), 6) AS flag_rate,
 round(coalesce(count(*) FILTER (WHERE is_fraud AND is_flagged) / nullif(count(*) FILTER (WHERE is_flagged), 0), 0), 6) AS precision,
 round(coalesce(count(*) FILTER (WHERE is_fraud AND is_flagged) / nullif(count(*) FILTER (WHERE is_fraud), 0), 0), 6) AS recall,
 round(coalesce(2 * count(*) FILTER (WHERE is_fraud AND is_flagged) / nullif(count(*) FILTER (WHERE is_fraud) + count(*) FILTER (WHERE is_flagged), 0), 0), 6) AS f1,
 count(*) FILTER (WHERE NOT is_fraud AND NOT is_flagged) AS true_negatives,
 count(*) FILTER (WHERE NOT is_fraud AND is_flagged) AS false_positives,
 count(*) FILTER (WHERE is_fraud AND NOT is_flagged) AS false_negatives,
 count(*) FILTER (WHERE is_fraud AND is_flagged) AS true_positives"""


def _labelled(t: Tables):
    facts = t.txn.select("transaction_id", "is_fraud", "amount", "merchant_category", "timestamp")
    return t.scores.join(facts, "transaction_id")


@query(
    "o6_classification_report",
    f"WITH d AS ({_LABELLED}) SELECT {_REPORT} FROM d",
    ("txn", "scores"),
)
def _(t: Tables):
    return plain(evaluation.classification_report(_labelled(t)))


def _ranking_sql(score: str) -> str:
    return f"""WITH d AS ({_LABELLED}),
 g AS (SELECT {score} AS s, count(*) FILTER (WHERE is_fraud) AS p, count(*) FILTER (WHERE NOT is_fraud) AS n FROM d GROUP BY 1),
 c AS (SELECT s, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
 SELECT round(sum(n * (tp - p / 2)) / (sum(p) * sum(n)), 6) AS roc_auc,
  round(sum(p * (tp / (tp + fp))) / sum(p), 6) AS pr_auc FROM c"""


@query("o7_ranking_metrics", _ranking_sql("ensemble_score"), ("txn", "scores"))
def _(t: Tables):
    return plain(evaluation.ranking_metrics(_labelled(t)))


@query("o8_ranking_metrics_ties", _ranking_sql("floor(ensemble_score * 100) / 100"), ("txn", "scores"))
def _(t: Tables):
    tied = _labelled(t).withColumn("ensemble_score", F.floor(F.col("ensemble_score") * 100) / 100)
    return plain(evaluation.ranking_metrics(tied))


_BAND = """CASE WHEN amount <= 100 THEN 'up to 100' WHEN amount <= 1000 THEN 'up to 1000'
 WHEN amount <= 5000 THEN 'up to 5000' ELSE 'over 5000' END"""


@query(
    "o11_subgroup_report",
    f"""WITH d AS (SELECT *, {_BAND} AS band, extract(hour FROM timestamp) AS hour FROM ({_LABELLED}) x)
    SELECT band, merchant_category, CAST(hour AS BIGINT) AS hour, {_REPORT} FROM d GROUP BY band, merchant_category, hour""",
    ("txn", "scores"),
)
def _(t: Tables):
    data = _labelled(t).withColumn("band", evaluation.amount_band()).withColumn("hour", F.hour("timestamp"))
    return plain(evaluation.classification_report(data, by=["band", "merchant_category", "hour"]))


_SETS = [["band"], ["merchant_category", "hour"], ["risk"], []]
_SETS_SQL = "GROUPING SETS ((band), (merchant_category, hour), (risk), ())"
_SET_COLUMNS = "band, merchant_category, hour, risk"


@query(
    "o11_grouping_sets",
    f"""WITH d AS (SELECT *, CASE WHEN merchant_category = 'gambling' THEN 'high' END AS risk,
      {_BAND} AS band, extract(hour FROM timestamp) AS hour FROM ({_LABELLED}) x),
    r AS (SELECT CAST(grouping({_SET_COLUMNS}) AS BIGINT) AS grouping, {_SET_COLUMNS}, {_REPORT} FROM d GROUP BY {_SETS_SQL}),
    g AS (SELECT CAST(grouping({_SET_COLUMNS}) AS BIGINT) AS grouping, {_SET_COLUMNS}, ensemble_score AS s,
      count(*) FILTER (WHERE is_fraud) AS p, count(*) FILTER (WHERE NOT is_fraud) AS n FROM d
      GROUP BY GROUPING SETS ((band, s), (merchant_category, hour, s), (risk, s), (s))),
    c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM g
      WINDOW w AS (PARTITION BY grouping, {_SET_COLUMNS} ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
    a AS (SELECT grouping, {_SET_COLUMNS},
      CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN round(sum(n * (tp - p / 2)) / (sum(p) * sum(n)), 6) END AS roc_auc,
      CASE WHEN sum(p) > 0 THEN round(sum(p * (tp / (tp + fp))) / sum(p), 6) END AS pr_auc
      FROM c GROUP BY grouping, {_SET_COLUMNS})
    SELECT r.* REPLACE (CAST(r.hour AS BIGINT) AS hour), a.roc_auc, a.pr_auc FROM r JOIN a ON r.grouping = a.grouping
     AND r.band IS NOT DISTINCT FROM a.band AND r.merchant_category IS NOT DISTINCT FROM a.merchant_category
     AND r.hour IS NOT DISTINCT FROM a.hour AND r.risk IS NOT DISTINCT FROM a.risk""",
    ("txn", "scores"),
)
def _(t: Tables):
    """A column with NULL values among the sets: the grouping id tells them from the columns left out."""
    data = _labelled(t).withColumn("band", evaluation.amount_band()).withColumn("hour", F.hour("timestamp"))
    data = data.withColumn("risk", F.when(F.col("merchant_category") == "gambling", F.lit("high")))
    return plain(evaluation.subgroup_report(data, _SETS))
