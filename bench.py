"""Headline queries on one machine; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import time

from riskloom.models.ensemble import EnsembleScorer
from riskloom.models.rules import RuleScorer
from riskloom.monitoring import drift, evaluation, quality
from riskloom.operators.features import (
    FeatureGroups,
    feature_names,
    history_measures,
    with_fast_features,
    with_features,
)
from riskloom.operators.relational import batch_summary, card_velocity, extract_unscored_batch
from riskloom.operators.trailing import trailing
from riskloom.plans.fixtures import Tables
from riskloom.session import checkpointed, local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df) -> None:
    """Compute every row and column without collecting or writing anything."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, app="riskloom-bench")
    t = Tables(spark, FOLDER)
    drain(t.txn)  # start executors and the parquet reader before anything is timed
    times: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        out = run()
        times[name] = round(time.perf_counter() - started, 3)
        return out

    timed("b12_fast_features", lambda: drain(with_fast_features(t.txn)))
    timed("f2_txn_counts", lambda: drain(
        with_features(t.txn, FeatureGroups(aggregations=False, temporal=False, risk=False))))
    timed("f8_full_features", lambda: drain(with_features(t.txn)))
    measures = history_measures("merchant_id", t.txn.columns, FeatureGroups())
    for form in ("frame", "cells"):
        timed(f"f_merchant_{form}", lambda: drain(
            trailing(t.txn, "merchant_id", measures, gap="gap", strategy=form)))
    # merchants see more than 100 rows a week: all of them take the split path
    timed("f_merchant_split", lambda: drain(
        trailing(t.txn, "merchant_id", measures, gap="gap", strategy="auto", limit=100)))
    timed("a8_extract_unscored", lambda: drain(extract_unscored_batch(t.txn, t.scores)))
    requests = t.txn.selectExpr("transaction_id AS request_id", "card_id", "timestamp AS reference_time")
    timed("d5_card_velocity", lambda: drain(card_velocity(t.txn, requests)))
    timed("e2_batch_summary", lambda: drain(batch_summary(t.scores)))
    timed("j2_expectation_suite", lambda: drain(quality.expectation_suite(t.dq_txn)))

    matrix = checkpointed(with_features(t.txn, keep=("transaction_id", "timestamp", "is_fraud")))
    timed("k8_rule_score", lambda: drain(RuleScorer().score(matrix)))
    names = feature_names(t.txn.columns)
    scorer = timed("n9_ensemble_fit", lambda: EnsembleScorer().fit(matrix, names))
    timed("n9_ensemble_score", lambda: drain(scorer.results(scorer.score(matrix))))
    half = matrix.agg({"timestamp": "avg"}).first()[0]
    old, new = (matrix.where(f"unix_timestamp(timestamp) {op} {half}") for op in ("<", ">="))
    timed("o3_dataset_drift", lambda: drain(drift.dataset_drift(drift.column_drift(old, new))))
    labelled = t.scores.join(t.txn.select("transaction_id", "is_fraud"), "transaction_id")
    timed("o7_ranking_metrics", lambda: drain(evaluation.ranking_metrics(labelled)))

    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
