"""Finding unscored rows at the cost of a batch: bucketed tables, the ledger, and the SQL function."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators.relational import extract_unscored_batch, insert_if_absent, insert_written_if_absent
from riskloom.schema import SCORING_RESULTS, canonical_transactions, conform
from riskloom.sources import sql_surface
from riskloom.sources.pending import PendingTables

START = datetime(2024, 3, 1)


def txns(spark, ids, days=10, source=lambda i: f"s{i % 2}"):
    rows = [
        (f"t{i:04d}", START + timedelta(days=i % days, minutes=(i * 37) % 1440), float(i), f"c{i % 7}", "m", source(i))
        for i in ids
    ]
    schema = "transaction_id string, timestamp timestamp, amount double, card_id string, merchant_id string, data_source string"
    return canonical_transactions(spark.createDataFrame(rows, schema))


def scores_of(rows, batch="b0"):
    stamped = rows.select("transaction_id").withColumns(
        {"batch_id": F.lit(batch), "scored_at": F.lit(START), "ensemble_score": F.lit(0.5),
         "is_flagged": F.lit(False), "flag_threshold": F.lit(0.5)}
    )
    return conform(stamped, SCORING_RESULTS)


def store(spark, tmp_path, buckets=4):
    return PendingTables(spark, str(tmp_path / "store"), f"t_{uuid.uuid4().hex}", buckets)


def ids(df):
    return [r.transaction_id for r in df.collect()]


def test_batches_follow_each_other_until_nothing_waits(spark, tmp_path):
    held, rows = store(spark, tmp_path), txns(spark, range(200))
    assert held.low_water_mark() is None and held.next_batch(5).collect() == []
    assert held.add_transactions(rows) == 200 and held.add_transactions(rows) == 0
    want, got = ids(rows.orderBy("timestamp", "transaction_id")), []
    for k in range(8):
        batch = held.next_batch(30)
        got += ids(batch)
        done = spark.createDataFrame(batch.collect(), batch.schema)
        assert held.add_scores(scores_of(done, f"b{k}"), done) == min(30, 200 - 30 * k if k < 7 else 0)
        assert held.add_scores(scores_of(done, f"b{k}"), done) == 0
    assert got == want and held.pending().collect() == []


def test_late_rows_reopen_their_day(spark, tmp_path):
    held = store(spark, tmp_path)
    early = txns(spark, range(0, 100, 2))
    held.add_transactions(early)
    held.add_scores(scores_of(early), early)
    assert held.low_water_mark() is None
    late = txns(spark, [33, 51, 3])
    held.add_transactions(late)
    assert held.low_water_mark() == (START + timedelta(days=1)).date()
    assert ids(held.next_batch(2)) == ids(late.orderBy("timestamp", "transaction_id"))[:2]


def test_agrees_with_the_plain_extraction(spark, tmp_path):
    held, rows = store(spark, tmp_path), txns(spark, range(300))
    held.add_transactions(rows)
    some = rows.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) > 0)
    held.add_scores(scores_of(some), some)
    held.add_scores(scores_of(some.limit(20), "again"), some)  # a second score takes nothing off
    for source in (None, "s1", "nowhere"):
        for size in (1, 17, 1000):
            want = ids(extract_unscored_batch(rows, held.scores, size, source))
            assert ids(held.next_batch(size, source)) == want


def test_plan_has_no_exchange_below_the_join_and_prunes_days(spark, tmp_path):
    held, rows = store(spark, tmp_path), txns(spark, range(200))
    held.add_transactions(rows)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = held.next_batch(10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "LeftAnti" in plan and "Exchange" not in plan
    filters = re.findall(r"PartitionFilters: \[[^\]]*day[^\]]*\]", plan)
    assert len(filters) == 2 and "2024-03-01" in filters[0] and "2024-03-02" not in filters[0]


def test_a_writer_that_died_costs_a_look_and_no_row(spark, tmp_path):
    held, rows = store(spark, tmp_path), txns(spark, range(60))
    held.add_transactions(rows)
    # entered, but never written: the first day seems to hold a thousand rows
    ghost = spark.range(1000).select(F.lit(START).cast("date").alias("day"), F.lit("s0").alias("data_source"))
    held._enter(ghost, 1)
    assert ids(held.next_batch(40)) == ids(rows.orderBy("timestamp", "transaction_id").limit(40))
    held.recount()
    assert sum(r["rows"] for r in held.pending().collect()) == 60
    # scores written, but never taken off
    held._enter = lambda *_: None
    held.add_scores(scores_of(rows), rows)
    assert held.next_batch(10).collect() == []


def test_compaction_and_a_second_session(spark, tmp_path):
    held = store(spark, tmp_path)
    for part in range(3):
        held.add_transactions(txns(spark, range(part, 90, 3), days=2))
    before = sorted(ids(held.transactions))
    files = list((tmp_path / "store/transactions/day=2024-03-01").glob("*.parquet"))
    held.compact_day(START.date())
    held.compact_ledger()
    after = list((tmp_path / "store/transactions/day=2024-03-01").glob("*.parquet"))
    assert len(after) <= 4 < len(files) and sorted(ids(held.transactions)) == before
    assert len(list((tmp_path / "store/ledger").glob("*.parquet"))) == 1
    again = PendingTables(spark, held.folder, f"t_{uuid.uuid4().hex}", 4)
    assert ids(again.next_batch(7)) == ids(held.next_batch(7)) and len(before) == 90


@pytest.mark.parametrize("size", [1, 40, 155, 10_000])
def test_sql_function_at_every_cut(spark, size):
    rows = txns(spark, range(150)).unionByName(
        # one instant with many rows, so that the cut falls between ties
        txns(spark, range(200, 300)).withColumn("timestamp", F.lit(START + timedelta(days=3)))
    )
    some = rows.where("amount % 5 = 0")
    sql_surface.register_views(spark, rows, scores_of(some))
    sql_surface.register_functions(spark)
    want = ids(extract_unscored_batch(rows, scores_of(some), size))
    got = spark.sql(f"SELECT transaction_id FROM extract_unscored_batch({size}) ORDER BY timestamp, transaction_id")
    assert ids(got) == want
    assert ids(spark.sql(f"SELECT * FROM extract_unscored_batch({size}, 'nowhere')")) == []


def test_sql_function_ranks_no_table_in_one_task(spark):
    rows = txns(spark, range(150))
    sql_surface.register_views(spark, rows, scores_of(rows.where("amount < 5")))
    sql_surface.register_functions(spark)
    plan = spark.sql("SELECT * FROM extract_unscored_batch()")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    single = [k for k, line in enumerate(lines) if "SinglePartition" in line]
    # one row an hour is all that meets in one task
    assert single and all("HashAggregate(keys=[_hour" in lines[k + 1] for k in single)


@pytest.mark.parametrize("few", [10_000, 0])
def test_written_rows_are_moved_only_for_odd_keys(spark, monkeypatch, few):
    monkeypatch.setattr("riskloom.operators.relational.BROADCAST_KEYS", few)
    schema = "a string, b string, x int"
    known = spark.createDataFrame([("k", "1", 0), ("m", "1", 0), (None, "1", 0)], schema)
    fresh = spark.createDataFrame([("p", "1", 7), ("q", "1", 8), (None, "1", 9)], schema)
    assert insert_written_if_absent(known, fresh, ["a", "b"]) is fresh
    odd = [("k", "1", 1), ("k", "2", 2), ("n", "1", 3), ("n", "1", 3), (None, "1", 4), (None, "1", 4), ("m", None, 5)]
    rows = fresh.unionByName(spark.createDataFrame(odd, schema)).where("x <> 9")
    for keys in (["a", "b"], ["a"]):
        want, got = insert_if_absent(known, rows, keys), insert_written_if_absent(known, rows, keys)
        assert sorted(map(str, got.select(*keys).collect())) == sorted(map(str, want.select(*keys).collect()))
