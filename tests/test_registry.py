from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as spark_entry
from riskloom.plans import registry
from tests.conftest import SMALL

# the corpus operators have tests and tables of their own
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
# quick ones of every section; tools/compare.py runs them all
PICKED = [
    "b1_external_to_canonical",
    "b11_risk_indicators",
    "f2_card_txn_count",
    "f7_unique_merchants",
    "d3_flagged_view",
    "e2_batch_summary",
    "j2_expectation_suite",
    "k9_rule_reasons",
    "n5_top_reasons",
    "o6_classification_report",
    "r2_velocity_bursts",
    "q2_stratified_split",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 100
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[0] == "transaction_id" and df.count() == 1000


@pytest.mark.parametrize("name", PICKED)
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(map(repr, (tuple(r[names.index(c)] for c in sorted(names)) for r in result.fetchall())))
    got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    assert sorted(names) == sorted(df.columns) and got == want


@pytest.mark.parametrize("name", sorted(set(ORACLES)))
def test_oracle_runs(duck, name):
    duck.execute(ORACLES[name]).fetchone()
