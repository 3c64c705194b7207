from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from riskloom.monitoring import drift, evaluation
from riskloom.operators import cumulative, sampling


def test_running_sums_match_a_sorted_scan(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aaab"), i, rng.randrange(100)) for i in range(300)]
    rng.shuffle(rows)
    df = cumulative.ranged(spark.createDataFrame(rows, "k string, v int, x int").repartition(5), ["k", "v"])
    for inclusive in (True, False):
        out = cumulative.running_sums(df, ["k"], "v", {"s": "x"}, inclusive=inclusive, totals=True)
        got = {(r["k"], r["v"]): (r["s"], r["total_s"]) for r in out.collect()}
        for key in "ab":
            upto = 0
            mine = sorted(r for r in rows if r[0] == key)
            total = sum(r[2] for r in mine)
            for _, v, x in mine:
                assert got[key, v] == (upto + x if inclusive else upto, total)
                upto += x


def test_percentiles_match_numpy(spark):
    values = np.random.default_rng(0).integers(0, 50, 501).astype(float)
    df = spark.createDataFrame([("k", float(v)) for v in values] + [("k", None)], "k string, v double")
    got = cumulative.exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95, "p98": 0.98}).first()
    for name, p in (("p50", 50), ("p95", 95), ("p98", 98)):
        assert got[name] == pytest.approx(np.percentile(values, p))


def test_no_window_without_partition(spark):
    """Global running sums must not gather the rows: the only global window is over cells."""
    df = spark.createDataFrame([(i, 1) for i in range(50)], "v int, x int")
    out = cumulative.running_sums(cumulative.ranged(df, ["v"]), [], "v", {"s": "x"})
    assert [r["s"] for r in out.orderBy("v").collect()] == list(range(1, 51))


def auc_brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_ranking_metrics_match_brute_force(spark):
    rng = random.Random(8)
    scores = [rng.randrange(20) / 20 for _ in range(200)]
    labels = [rng.random() < 0.2 + s / 2 for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "ensemble_score double, is_fraud boolean")
    got = evaluation.ranking_metrics(df).first()
    assert got["roc_auc"] == pytest.approx(auc_brute(scores, labels))
    ap, tp, fp, positives = 0.0, 0, 0, sum(labels)
    for s in sorted(set(scores), reverse=True):
        p = sum(y for v, y in zip(scores, labels) if v == s)
        n = sum(not y for v, y in zip(scores, labels) if v == s)
        tp, fp = tp + p, fp + n
        ap += p / positives * tp / (tp + fp)
    assert got["pr_auc"] == pytest.approx(ap)


def test_performance_report_edges(spark):
    pred = spark.createDataFrame(
        [("a", 0.9, True), ("b", 0.1, False)], "transaction_id string, ensemble_score double, is_flagged boolean"
    )
    labels = spark.createDataFrame([("a", True), ("b", True)], "transaction_id string, is_fraud boolean")
    assert evaluation.performance_report(pred, labels.drop("is_fraud"), "x")["error"] == "no ground truth labels"
    one = evaluation.performance_report(pred, labels, "x")
    assert one["error"] == "no class variation" and one["fraud_count"] == 2
    mixed = labels.withColumn("is_fraud", F.col("transaction_id") == "a")
    full = evaluation.performance_report(pred, mixed, "x")
    assert full["precision"] == full["recall"] == full["f1"] == full["roc_auc"] == 1.0


def test_no_flag_gives_zero_ratios(spark):
    df = spark.createDataFrame([(True, False), (False, False)], "is_fraud boolean, is_flagged boolean")
    row = evaluation.classification_report(df).first()
    assert row["precision"] == row["recall"] == row["f1"] == 0.0


def test_drift_of_equal_and_shifted_tables(spark):
    base = spark.range(2000).select((F.col("id") % 500).cast("double").alias("amount"), (F.col("id") % 2).alias("is_night"))
    same = drift.column_drift(base, base)
    assert not any(r["drift_detected"] for r in same.collect())
    moved = base.select((F.col("amount") + 300).alias("amount"), F.lit(1).alias("is_night"))
    rows = {r["feature"]: r for r in drift.column_drift(base, moved).collect()}
    assert rows["amount"]["drift_detected"] and rows["is_night"]["drift_detected"]
    number = drift.numeric_drift(base, moved).first()
    assert number["ks_statistic"] == pytest.approx(0.6)
    assert number["wasserstein"] == pytest.approx(300 / np.std(np.arange(500)), rel=1e-9)
    assert drift.dataset_drift(drift.column_drift(base, moved)).first()["drift_share"] == 1.0
    tests = {r["name"]: r["status"] for r in drift.drift_tests(drift.column_drift(base, moved)).collect()}
    assert tests == {"share_of_drifted_columns": "FAIL", "column_drift:amount": "FAIL"}


def test_first_batch_becomes_the_reference(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("double").alias("amount"))
    path = str(tmp_path / "reference")
    assert drift.detect_drift(spark, df, "b1", path)["note"] == "reference data initialized"
    second = drift.detect_drift(spark, df, "b2", path)
    assert second["n_columns"] == 1 and not second["drift_detected"]


def test_split_is_exact_per_class(tables):
    split = sampling.stratified_split(tables.txn)
    for r in split.groupBy("is_fraud").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("k")).collect():
        assert r["k"] == int(r["n"] * 0.2 + 0.5)
    again = sampling.stratified_split(tables.txn.repartition(9))
    assert split.where("is_test").select("transaction_id").exceptAll(
        again.where("is_test").select("transaction_id")
    ).isEmpty()


def test_split_without_label(tables):
    split = sampling.stratified_split(tables.txn, 0.3, label=None)
    assert split.where("is_test").count() == int(tables.txn.count() * 0.3 + 0.5)


@pytest.mark.parametrize("listed, buckets", [(20_000, 1024), (3, 4), (0, 2)])
def test_selected_percentiles_against_sorting(spark, monkeypatch, listed, buckets):
    """Skewed, tied, infinite and missing values, NULL among the keys, in one round and in many."""
    monkeypatch.setattr(cumulative, "LISTED_ROWS", listed)
    monkeypatch.setattr(cumulative, "BUCKETS", buckets)
    monkeypatch.setattr(cumulative, "ROUNDS", 40)
    rng = random.Random(11)
    draws = {
        "even": lambda: rng.random(), "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300),
        "tied": lambda: float(rng.randrange(3)), "one": lambda: 7.5, "ends": lambda: rng.choice([-1.7e308, 1.7e308, 0.0]),
        None: lambda: rng.choice([rng.gauss(0, 1), float("inf"), float("-inf"), 0.0]),
    }
    rows = [(k, draw()) for k, draw in draws.items() for _ in range(60)]
    rows += [("even", None), ("single", 3.0), ("none", None), ("bad", float("nan")), ("bad", 1.0), ("bad", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    points = {"p0": 0.0, "p33": 0.33, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in cumulative.exact_percentiles(df, ["k"], "v", points).collect()}
    assert got.keys() == {*draws, "single", "bad"}
    for key, line in got.items():
        values = sorted((v for k, v in rows if k == key and v is not None), key=lambda v: (math.isnan(v), v))
        for name, p in points.items():
            rank = p * (len(values) - 1)
            low, high = values[math.floor(rank)], values[math.ceil(rank)]
            want = low + (high - low) * (rank - math.floor(rank)) if low != high else low
            assert line[name] == pytest.approx(want, rel=1e-12, nan_ok=True), (key, name)


def test_selection_shuffles_counts_only(spark):
    """Eight times the distinct values: what is shuffled are bucket counts, so it hardly grows."""
    store = spark._jsc.sc().statusStore()

    def written(rows: int) -> int:
        df = spark.range(0, rows, 1, 4).selectExpr("id % 3 AS k", "pow(abs(sin(id)), 3) AS v")
        last = max((s.stageId() for s in _stages(store)), default=-1)
        got = cumulative.exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95}).orderBy("k").collect()
        found = [s.shuffleWriteBytes() for s in _stages(store) if s.stageId() > last]
        want = df.groupBy("k").agg(*[F.expr(f"percentile(v, {p})") for p in (0.5, 0.95)]).orderBy("k").collect()
        assert [tuple(r) for r in got] == [pytest.approx(tuple(r), rel=1e-12) for r in want]
        return sum(found)

    assert written(800_000) < 2 * written(100_000)


def _stages(store):
    found = store.stageList(None, False, False, _no_doubles(), None)
    return [found.apply(i) for i in range(found.size())]


def _no_doubles():
    gateway = SparkContext._gateway
    return gateway.new_array(gateway.jvm.double, 0)


def test_many_keys_are_ranked_instead(spark, monkeypatch):
    monkeypatch.setattr(cumulative, "SELECTED_KEYS", 4)
    df = spark.range(300).selectExpr("id % 10 AS k", "cast(id * id % 97 AS double) AS v")
    got = cumulative.exact_percentiles(df, ["k"], "v", {"p": 0.3}).orderBy("k").collect()
    want = df.groupBy("k").agg(F.expr("percentile(v, 0.3)")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [pytest.approx(tuple(r)) for r in want]
