from __future__ import annotations

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.models import ensemble, reconstruction
from riskloom.models.forest import IsolationForest, average_path, top_entries
from riskloom.models.reconstruction import ReconstructionModel
from riskloom.operators.relational import top_per_row

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def planted(spark):
    """400 ordinary rows on a plane and 5 rows far away from it."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 400))
    rows = [(f"n{i:03d}", float(a[i]), float(b[i]), float(a[i] + b[i]), float(a[i] - b[i])) for i in range(400)]
    rows += [(f"out{i}", 9.0, -9.0, 9.0, 9.0 + i) for i in range(5)]
    schema = "transaction_id string, a double, b double, c double, d double"
    return spark.createDataFrame(rows, schema).repartition(4).persist()


@pytest.fixture(scope="module")
def forest(planted):
    return IsolationForest(n_estimators=40).fit(planted, NAMES)


def ids_on_top(df, column, n):
    return {r["transaction_id"] for r in df.orderBy(F.desc(column)).limit(n).collect()}


def test_forest_ranks_planted_outliers_first(planted, forest):
    scored = forest.score(planted)
    assert all(i.startswith("out") for i in ids_on_top(scored, "isolation_forest_score", 5))
    low, high = scored.agg(F.min("isolation_forest_score"), F.max("isolation_forest_score")).first()
    assert low == 0.0 and high == pytest.approx(1.0)


def test_forest_is_reproducible_and_bounded(planted, forest):
    again = IsolationForest(n_estimators=40).fit(planted.repartition(7), NAMES)
    assert forest.nodes.equals(again.nodes)
    assert forest.nodes["tree"].nunique() == 40
    assert forest.nodes.groupby("tree").size().max() <= 2 * 256 - 1
    assert (forest.nodes.loc[forest.nodes["node"] == 0, "size"] == 256).all()
    assert forest.importances.sum() == pytest.approx(1.0)


def test_forest_on_large_tables_gives_each_tree_its_own_rows(spark):
    df = spark.range(6000).select(
        F.col("id").cast("string").alias("transaction_id"), F.rand(1).alias("a"), F.rand(2).alias("b")
    )
    model = IsolationForest(n_estimators=5, max_samples=64).fit(df, ["a", "b"])
    roots = model.nodes[model.nodes["node"] == 0]
    assert len(roots) == 5 and (roots["size"] == 64).all()


def test_frozen_range_scores_rows_alone(planted, forest):
    forest.calibrate(planted)
    whole = {r[0]: r[1] for r in forest.score(planted, calibration="fit").select("transaction_id", "isolation_forest_score").collect()}
    one = forest.score(planted.where("transaction_id = 'out1'"), calibration="fit").first()
    assert one["isolation_forest_score"] == pytest.approx(whole["out1"])
    alone = forest.score(planted.where("transaction_id = 'out1'")).first()
    assert alone["isolation_forest_score"] == 0.0  # a batch of one has no range


def test_average_path():
    assert average_path(np.array([1, 2]))[1] == 1.0
    assert average_path(np.array([256]))[0] == pytest.approx(10.2448, abs=1e-3)


def test_contributions_name_the_deviating_feature(planted, forest):
    row = planted.where("transaction_id = 'out4'").select(forest.contributions(2).alias("t")).first()
    assert row["t"][0]["feature"] == "d" and len(row["t"]) == 2


def test_forest_round_trip(spark, planted, forest, tmp_path):
    forest.calibrate(planted)
    forest.save(spark, str(tmp_path / "f"))
    loaded = IsolationForest.load(spark, str(tmp_path / "f"))
    a = forest.score(planted).orderBy("transaction_id").toPandas()
    b = loaded.score(planted).orderBy("transaction_id").toPandas()
    assert a.equals(b) and loaded.bounds == forest.bounds


def test_reconstruction_finds_rows_off_the_plane(spark, planted, tmp_path):
    model = ReconstructionModel(bottleneck=2).fit(planted, NAMES)
    scored = model.score(planted)
    assert all(i.startswith("out") for i in ids_on_top(scored, "autoencoder_score", 5))
    bounds = scored.agg(F.min("autoencoder_score"), F.max("autoencoder_score")).first()
    assert 0.0 <= bounds[0] and bounds[1] == 1.0
    model.save(spark, str(tmp_path / "r"))
    loaded = ReconstructionModel.load(spark, str(tmp_path / "r"))
    a = scored.orderBy("transaction_id").toPandas()
    b = loaded.score(planted).orderBy("transaction_id").toPandas()
    assert a.equals(b)
    latent = model.encode(planted).first()["latent"]
    assert len(latent) == 2
    both = model.score_with_residuals(planted).orderBy("transaction_id").toPandas()
    assert np.allclose(both["autoencoder_score"], a["autoencoder_score"])


def test_reconstruction_with_constant_column(planted):
    df = planted.withColumn("k", F.lit(3.0))
    model = ReconstructionModel(bottleneck=2).fit(df, [*NAMES, "k"])
    assert model.score(df).where(F.isnan("autoencoder_score")).count() == 0


def test_zero_threshold(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "e double")
    assert [r[0] for r in df.select(reconstruction.scaled_error("e", 0.0)).collect()] == [0.0, 1.0]


def test_weights_are_redistributed():
    w = ensemble.redistribute(ensemble.DEFAULT_WEIGHTS, "autoencoder")
    assert w["rules"] == pytest.approx(0.4615, abs=1e-4) and w["autoencoder"] == 0.0
    assert sum(w.values()) == pytest.approx(1.0)


def test_strongest_reasons_keep_order_of_equals(spark):
    names = "model string, rule string, feature string, score double, contribution double, reconstruction_error double, reason string"
    rows = [
        ("rules", "r1", None, 0.5, None, None, "x"),
        ("rules", "r2", None, 0.8, None, None, "x"),
        ("isolation_forest", None, "f1", None, 0.5, None, "x"),
        ("isolation_forest", None, "f2", None, 0.9, None, "x"),
        ("autoencoder", None, "g1", None, None, 7.0, "x"),
        ("autoencoder", None, "g2", None, None, 9.0, "x"),
    ]
    df = spark.createDataFrame([(rows,)], f"r array<struct<{', '.join(n.replace(' ', ':') for n in names.split(', '))}>>")
    got = df.select(ensemble.strongest(F.col("r")).alias("r")).first()["r"]
    assert [x["rule"] or x["feature"] for x in got] == ["f2", "r2", "r1", "f1", "g1"]


def test_ensemble_scores_and_round_trip(spark, planted, tmp_path):
    df = planted.withColumn("amount", F.abs("d") * 1000)
    names = [*NAMES, "amount"]
    scorer = ensemble.EnsembleScorer().fit(df, names, n_estimators=20)
    out = scorer.results(scorer.score(df))
    rows = out.orderBy("transaction_id").toPandas()
    assert rows["ensemble_score"].between(0, 1).all()
    assert (rows["is_flagged"] == (rows["ensemble_score"] >= 0.5)).all()
    top = rows.sort_values("ensemble_score").iloc[-1]
    reasons = json.loads(top["reason_codes"])
    assert top["transaction_id"].startswith("out") and 0 < len(reasons) <= 5
    assert all({"model", "reason"} <= set(r) for r in reasons)
    assert json.loads(top["model_versions"]).keys() == {"ensemble", "rules", "isolation_forest", "autoencoder"}
    scorer.save(spark, str(tmp_path / "e"))
    loaded = ensemble.EnsembleScorer.load(spark, str(tmp_path / "e"))
    again = loaded.results(loaded.score(df)).orderBy("transaction_id").toPandas()
    assert rows.equals(again)


def test_ensemble_without_autoencoder(planted):
    scorer = ensemble.EnsembleScorer(use_autoencoder=False).fit(planted, NAMES, n_estimators=5)
    row = scorer.results(scorer.score(planted)).first()
    assert row["autoencoder_score"] is None
    assert scorer.weights["autoencoder"] == 0.0


def test_features_go_to_python_once_a_pass(planted):
    """Trees, residuals and both kinds of reasons share one trip, and only what is asked for is computed."""
    scorer = ensemble.EnsembleScorer(calibration="fit").fit(planted, NAMES, n_estimators=20)
    scored = scorer.score(planted)
    for df, functions in ((scored, 4), (scored.select("ensemble_score"), 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        line = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
        assert len(line) == 1 and "SortArray" not in plan
        assert len(set(re.findall(r"\b(score|top|error)\(", line[0]))) == (3 if functions == 4 else 2)


def test_top_entries_are_those_of_the_sorted_row(spark):
    """Ties: the later column first; NaN is largest, NULL and values up to the limit are left out."""
    nan, names = float("nan"), ["a", "b", "c", "d"]
    rows = [(0.3, 0.3, 0.3, 0.3), (0.1, 5.0, nan, 0.2), (None, None, 0.5, 0.05), (0.0, 0.0, 0.0, 0.1), (1.0, 2.0, 2.0, 3.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double, c double, d double")
    sorted_row = F.filter(top_per_row([(n, F.col(n)) for n in names], 3), lambda e: e["value"] > 0.1)
    want = [[(e.position, e.feature) for e in r[0]] for r in df.orderBy("id").select(sorted_row).collect()]
    values = np.array([[nan if v is None else v for v in r] for r in rows])
    known = np.array([[v is not None for v in r] for r in rows])
    got = top_entries(values, ~(values <= 0.1) & known, names, 3).to_pylist()
    assert [[(e["position"], e["feature"]) for e in r] for r in got] == want
