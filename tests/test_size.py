"""What keeps a task's memory and the shuffled volume in step with the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import trailing as tr
from riskloom.plans import registry
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry import operations
from riskloom.session import COMPILED_METHOD_BYTES, PARTITION_BYTES, checkpointed
from tests.conftest import ROW_SCHEMA, SMALL, make_rows

KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cells_sort_backwards_for_maxima_only(spark):
    df = spark.createDataFrame(make_rows(2, 40), ROW_SCHEMA)
    sums = [tr.count("n", 24)] + [tr.statistic(k, k, "amount", 24) for k in ("sum", "mean", "std")]
    assert "DESC" not in plan(tr.trailing(df, "card_id", sums, strategy="cells"))
    both = plan(tr.trailing(df, "card_id", [*sums, tr.statistic("max", "m", "amount", 24)], strategy="cells"))
    backwards = [line for line in both.splitlines() if "Window" in line and "DESC" in line]
    assert backwards and not any("sum(" in line.split(" DESC")[0] for line in backwards)


def test_tasks_are_small_unless_the_session_says(spark):
    held = spark.conf.get(KEY)
    try:
        spark.conf.unset(KEY)
        Tables(spark, SMALL)
        assert spark.conf.get(KEY) == f"{PARTITION_BYTES}b"
        spark.conf.set(KEY, "16m")
        Tables(spark, SMALL)
        assert spark.conf.get(KEY) == "16m"
    finally:
        spark.conf.set(KEY, held)


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    held = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        Tables(spark, SMALL)
        assert spark.conf.get(key) == str(COMPILED_METHOD_BYTES)
        spark.conf.set(key, "60000")
        Tables(spark, SMALL)
        assert spark.conf.get(key) == "60000"
    finally:
        spark.conf.set(key, held)


def test_written_copies_give_single_columns(spark):
    copy = checkpointed(spark.range(10).selectExpr("id", "id * 2 AS two"))
    assert "ReadSchema: struct<two:bigint>" in copy.select("two")._jdf.queryExecution().toString()


def test_ranking_of_contributions_shuffles_nothing(spark):
    for name in ("l6_top_contributions", "m6_top_residuals"):
        text = plan(registry.queries()[name](spark, SMALL))
        assert not any(word in text for word in ("Window", "Join", "Generate", "Aggregate")), name


def test_features_are_read_from_one_written_table(spark):
    for name in ("l1_standardised_all", "m1_normalised_all"):
        assert "Window" not in plan(registry.queries()[name](spark, SMALL)), name


def test_landed_files_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(operations, "_LANDED_ROWS", 100)
    path, files = operations._landed(Tables(spark, SMALL), 2)
    held = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert files == 5 and len(held) >= 8 and max(held) <= 200
