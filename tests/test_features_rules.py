from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.expressions import display_name
from riskloom.models.rules import RULE_WEIGHTS, RuleScorer
from riskloom.operators import features as feat


@pytest.fixture(scope="module")
def hundred(spark):
    """100 hourly transactions with known counts of risky values."""
    amounts = np.random.default_rng(1).lognormal(4, 1, 100).round(2)
    rows = [
        (
            f"txn_{i:04d}",
            datetime(2024, 1, 15, 12) + timedelta(hours=i),
            float(amounts[i]),
            f"m{i % 10}",
            f"c{i % 20}",
            f"u{i % 15}",
            "gmail.com" if i < 90 else "tempmail.com",
            "USA" if i < 95 else "GBR",
            "USA" if i < 90 else "CAN",
            i < 80,
            "grocery" if i < 50 else "electronics" if i < 80 else "jewelry",
        )
        for i in range(100)
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id string, timestamp timestamp, amount double, merchant_id string, card_id string, "
        "customer_id string, email_domain string, billing_country string, shipping_country string, "
        "is_online boolean, merchant_category string",
    )


def test_known_counts(hundred):
    out = feat.with_features(hundred).toPandas()
    assert len(out) == 100 and not out.isna().any().any()
    assert out["suspicious_email"].sum() == 10
    assert out["country_mismatch"].sum() == 10
    assert out["high_risk_category"].sum() == 50
    assert "card_billing_mismatch" not in out.columns  # no card country in the table


def test_all_groups_make_53_columns(tables):
    names = feat.feature_names(tables.txn.columns)
    assert len(names) == 53
    assert feat.with_features(tables.txn).columns == ["transaction_id", *names]


def test_groups_and_fast_set(tables):
    only = feat.FeatureGroups(velocity=False, aggregations=False, risk=False)
    assert len(feat.feature_names(tables.txn.columns, only)) == 12
    assert len(feat.with_fast_features(tables.txn).columns) == 14


def test_cold_start_choice(tables):
    """Without history the score is amount / 1e-6, or 0 if asked for."""
    for choice, expected in (("raw", F.col("amount") / F.lit(1e-6)), ("zero", F.lit(0.0))):
        df = feat.with_features(tables.txn, feat.FeatureGroups(cold_start=choice))
        cold = df.where("card_txn_count_24h = 0")
        assert cold.count() > 0
        assert cold.where(F.abs(F.col("card_amount_zscore_24h") - expected) > 1e-3).isEmpty()


def test_result_does_not_depend_on_partitioning(tables):
    key = "transaction_id"
    a = feat.with_features(tables.txn).toPandas().sort_values(key).reset_index(drop=True)
    shuffled = tables.txn.orderBy(F.rand(3)).repartition(7)
    b = feat.with_features(shuffled).toPandas().sort_values(key).reset_index(drop=True)
    assert a.equals(b[a.columns])


def test_missing_countries_are_a_mismatch(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("b", "USA", None), ("c", "USA", "USA")],
        "id string, billing_country string, shipping_country string",
    )
    from riskloom.functions.expressions import differs

    got = {r[0]: r[1] for r in df.select("id", differs("billing_country", "shipping_country")).collect()}
    assert got == {"a": 1, "b": 1, "c": 0}


def test_display_names(spark):
    df = spark.createDataFrame([("is_night",), ("other",)], "f string")
    assert [r[0] for r in df.select(display_name(F.col("f"))).collect()] == [
        "Night Transaction (10pm-5am)",
        "other",
    ]


def rising(df, scorer):
    return [r["rule_score"] for r in scorer.score(df).orderBy("i").collect()]


def test_scores_rise_with_amount_and_velocity(spark):
    by_amount = spark.createDataFrame([(0, 500.0), (1, 5000.0), (2, 10000.0)], "i int, amount double")
    s = rising(by_amount, RuleScorer(amount_threshold=1000))
    assert s[0] < s[1] < s[2]
    by_count = spark.createDataFrame([(0, 1), (1, 5), (2, 10)], "i int, card_txn_count_1h int")
    s = rising(by_count, RuleScorer(velocity_threshold_1h=3))
    assert s[0] < s[1] < s[2]


def test_score_and_reasons_of_one_row(spark):
    df = spark.createDataFrame(
        [(10000.0, 5, 20, 1, 1, 1, 1)],
        "amount double, card_txn_count_1h int, card_txn_count_24h int, is_night int, "
        "country_mismatch int, suspicious_email int, high_risk_category int",
    )
    row = RuleScorer().score(df).first()
    parts = {
        "high_amount": math.log1p(2) / math.log1p(10),
        "velocity_1h": math.log1p(1) / math.log1p(5),
        "velocity_24h": 1.0,
        "night_activity": 0.8,
        "country_mismatch": 0.7,
        "suspicious_email": 0.8,
        "high_risk_merchant": 0.5,
    }
    assert row["rule_score"] == pytest.approx(sum(RULE_WEIGHTS[r] * v for r, v in parts.items()))
    assert [r["rule"] for r in row["rule_reasons"]] == list(parts)
    assert row["rule_reasons"][0]["reason"] == "Amount $10000.00 exceeds threshold $5000.00"
    assert row["rule_reasons"][1]["reason"] == "5 transactions in last hour (threshold: 5)"


def test_night_rule_without_amount(spark):
    df = spark.createDataFrame([(1,), (0,)], "is_night int")
    scores = {r["is_night"]: r["rule_score"] for r in RuleScorer().score(df).collect()}
    assert scores[1] == pytest.approx(0.05) and scores[0] == 0.0


def test_catalogue_quotes_limits(spark):
    rows = {r["rule"]: r["description"] for r in RuleScorer(amount_threshold=250).catalogue(spark).collect()}
    assert rows["high_amount"] == "Transaction amount exceeds $250" and len(rows) == 7
