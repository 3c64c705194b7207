from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.monitoring import quality
from riskloom.monitoring.audit import AuditLog
from riskloom.operators import feature_store, injection
from riskloom.operators.features import FeatureGroups, with_features
from riskloom.operators.relational import extract_unscored_batch, recent_failures
from riskloom.plans.scoring_run import ScoringRun
from riskloom.session import shared_dir
from riskloom.sources import external
from riskloom.sources import tables as store_tables
from riskloom.streaming import jobs


def test_checkpoint_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_batch_id_format():
    assert re.fullmatch(r"batch_20240102_030405_[0-9a-f]{8}", store_tables.new_batch_id(datetime(2024, 1, 2, 3, 4, 5)))


def test_write_dataframe_modes(spark):
    df = spark.range(10)
    spark.sql("DROP TABLE IF EXISTS written_rows")
    assert store_tables.write_dataframe(df, "written_rows", if_exists="fail") == 10
    assert store_tables.write_dataframe(df, "written_rows", if_exists="append") == 10
    assert store_tables.row_count(spark, "written_rows") == 20 and store_tables.table_exists(spark, "written_rows")
    with pytest.raises(Exception):
        store_tables.write_dataframe(df, "written_rows", if_exists="fail")
    store_tables.write_dataframe(df, "written_rows", if_exists="replace")
    assert store_tables.row_count(spark, "written_rows") == 10


def test_parts_cover_the_table(spark):
    df = spark.range(95)
    chunks = list(store_tables.parts(df, 30))
    assert len(chunks) == 4
    assert sorted(r["id"] for c in chunks for r in c.collect()) == list(range(95))


def test_external_csv_reads_wanted_columns_only(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    header = "TransactionID,TransactionDT,TransactionAmt,ProductCD,card1,card4,addr2,isFraud,V1,C1,M1,other"
    (tmp_path / "x.csv").write_text(header + "\n7,60,0.125,W,007,Visa,87.0,1,1.5,2,T,zzz\n8,61,9.5,?,8,,,0,,3,F,zzz\n")
    raw = external.read_transactions_csv(spark, path)
    assert "other" not in raw.columns
    rows = {r["transaction_id"]: r for r in external.to_canonical(raw).collect()}
    first, second = rows["ieee_7"], rows["ieee_8"]
    assert first["timestamp"] == datetime(2017, 11, 30, 0, 1) and first["amount"] == 0.12
    assert first["card_id"] == "ieee_card_007" and first["card_type"] == "VISA"
    assert first["billing_country"] == "USA" and first["is_fraud"] is True
    assert second["card_type"] == "UNKNOWN" and second["billing_country"] == "OTHER"
    assert second["merchant_category"] == "unknown" and second["device_id"] == "unknown"
    assert "ieee_m1" not in first.asDict() and first["ieee_v1"] == 1.5


def test_validation_strict_and_missing_columns(spark):
    bad = spark.createDataFrame([("a", -1.0), ("a", None)], "transaction_id string, amount double")
    with pytest.raises(quality.ValidationFailed):
        quality.validate(bad, "b", strict=True)
    outcome = quality.validate(bad, "b", suite="basic")
    failed = {(e["expectation"], e["column"]): e["unexpected_count"] for e in outcome["failed_expectations"]}
    assert failed[("unique_transaction_ids", "transaction_id")] == 1
    assert failed[("valid_amount_range", "amount")] == 1
    assert failed[("no_null_amounts", "amount")] == 1
    assert ("columns_present", "timestamp,merchant_id,card_id") in failed
    assert len(outcome["expectations"]) == 9


def test_good_table_passes(tables, spark):
    clean = tables.txn.where("card_id IS NOT NULL")
    assert quality.validate(clean, "b")["success"]


def test_audit_steps_and_failures(spark, tmp_path):
    audit = AuditLog(spark, str(tmp_path / "audit"))
    with audit.step("b1", "SCORE") as facts:
        facts["records_processed"] = 8
    with pytest.raises(RuntimeError):
        with audit.step("b1", "PERSIST"):
            raise RuntimeError("disk full")
    rows = audit.read().orderBy("timestamp").collect()
    assert [(r["operation"], r["status"]) for r in rows] == [
        ("SCORE", "STARTED"), ("SCORE", "COMPLETED"), ("PERSIST", "STARTED"), ("PERSIST", "FAILED"),
    ]
    assert rows[1]["records_processed"] == 8 and rows[3]["error_message"] == "disk full"
    assert recent_failures(audit.read(), datetime.now() + timedelta(hours=1), 24).count() == 1


def test_scores_are_persisted_once(spark, tables, tmp_path):
    results = tables.scores.select("transaction_id", "ensemble_score", "is_flagged", "rule_score")
    path = str(tmp_path / "scores")
    first = store_tables.as_scoring_results(results, "b1")
    n = store_tables.persist_scores(spark, first, path, batch_id="b1")
    assert n == results.count()
    assert store_tables.persist_scores(spark, first, path, batch_id="b1") == 0
    assert store_tables.persist_scores(spark, store_tables.as_scoring_results(results, "b2"), path) == n
    assert dict(store_tables.read_scores(spark, path).dtypes)["ensemble_score"] == "decimal(5,4)"


def test_source_filter_reaches_the_scan(tables):
    plan = extract_unscored_batch(tables.txn, tables.scores, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_scoring_run_end_to_end(spark, tables, tmp_path):
    run = ScoringRun(spark, str(tmp_path), batch_size=600, forest_options={"n_estimators": 10})
    first = run.run(tables.txn)
    assert first.rows == first.persisted == 600 and first.statistics["total"] == 600
    assert first.drift["note"] == "reference data initialized"
    second = run.run(tables.txn, past=tables.txn)
    assert second.rows == 400 and second.drift["n_columns"] == 14
    assert run.run(tables.txn).rows == 0
    stored = store_tables.read_scores(spark, f"{tmp_path}/scores")
    assert stored.count() == stored.select("transaction_id").distinct().count() == 1000
    done = AuditLog(spark, f"{tmp_path}/audit_log").read().where("status = 'COMPLETED'")
    assert done.where("operation = 'PERSIST'").count() == 2
    assert quality.validation_summary(spark, f"{tmp_path}/validation").count() == 2


def test_injection_mix_is_checked(tables):
    with pytest.raises(ValueError):
        injection.inject(tables.txn, injection.AnomalyMix(velocity=0.9))


def test_injection_is_deterministic_and_labelled(tables):
    source = tables.txn.withColumn("ip_address", F.lit(None).cast("string"))
    mix = injection.AnomalyMix(rate=0.3)
    out = injection.inject(source, mix)
    assert out.columns == source.columns
    again = injection.inject(source.repartition(6), mix)
    assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()
    assert out.count() > source.count()
    assert out.select("transaction_id").distinct().count() == out.count()
    extra = out.join(source.select("transaction_id"), "transaction_id", "left_anti")
    assert extra.where("NOT is_fraud").isEmpty()
    geo = injection.injected(source, "geographic")
    assert geo.where("shipping_country = billing_country OR card_country = billing_country").isEmpty()


def test_store_windows_grow(tables):
    store = feature_store.materialise(tables.txn, datetime(2024, 1, 31))
    n = {
        r["feature_window"]: r["n"]
        for r in store.where("entity_type = 'MERCHANT'").groupBy("feature_window").agg(
            F.sum(F.col("features")["txn_count"]).alias("n")).collect()
    }
    assert n.get("1H", 0) <= n["24H"] <= n["7D"] <= n["30D"]
    assert feature_store.valid_features(store, datetime(2024, 2, 2)).isEmpty()


VELOCITY = FeatureGroups(aggregations=False, temporal=False, risk=False)


def test_stream_of_slices_equals_the_batch(spark, tables, tmp_path):
    """History features of a stream that lands in slices equal those of the whole table."""
    landing, folder = str(tmp_path / "landing"), str(tmp_path / "job")
    cut = F.lit(datetime(2024, 1, 15))
    for rows in (F.col("timestamp") < cut, F.col("timestamp") >= cut):
        tables.txn.where(rows).write.mode("append").parquet(landing)
        stream = jobs.transaction_stream(spark, landing, tables.txn.schema)
        jobs.trailing_features(stream, folder, VELOCITY).awaitTermination()
    got = spark.read.parquet(f"{folder}/features").drop("epoch").toPandas()
    want = with_features(tables.txn, VELOCITY).toPandas()
    order = "transaction_id"
    got = got.sort_values(order).reset_index(drop=True)[want.columns]
    assert got.equals(want.sort_values(order).reset_index(drop=True))


def test_stream_drops_repeats(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    for _ in range(2):
        tables.txn.write.mode("append").parquet(landing)
    stream = jobs.without_repeats(jobs.transaction_stream(spark, landing, tables.txn.schema), delay="60 days")
    query = stream.writeStream.format("memory").queryName("unique_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("unique_rows").count() == tables.txn.count()


# --- chunks, audit, stored tables ---------------------------------------------------------------


def test_chunks_have_their_size_even_for_equal_rows(spark):
    rows = spark.range(90).selectExpr("1 AS a", "'x' AS _chunk").repartition(7)
    chunks = list(store_tables.parts(rows, 30))
    assert [c.count() for c in chunks] == [30, 30, 30]
    assert all(c.columns == ["a", "_chunk"] for c in chunks)
    assert [c.count() for c in store_tables.parts(rows.limit(31), 30)] == [30, 1]
    assert [c.count() for c in store_tables.parts(rows.limit(0), 30)] == [0]
    numbered = spark.range(1000).repartition(5)
    seen = [r.id for c in store_tables.parts(numbered, 64) for r in c.collect()]
    assert sorted(seen) == list(range(1000))


def test_failed_step_keeps_the_whole_message_and_its_facts(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path / "audit"))
    with pytest.raises(ValueError):
        with log.step("b1", "SCORE") as facts:
            facts["records_processed"] = 7
            facts["metadata"] = {"why": "test"}
            raise ValueError("x" * 5000)
    (failed,) = log.read().where("status = 'FAILED'").collect()
    assert failed.error_message == "x" * 5000
    assert failed.records_processed == 7 and "test" in failed.metadata


def test_stored_tables_lose_only_what_they_must(spark, tmp_path):
    path = str(tmp_path / "rows")
    start = datetime(2024, 1, 1)
    rows = [(f"t{i}", start + timedelta(hours=6 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp")
    df.selectExpr("*", "to_date(timestamp) AS date").write.partitionBy("date").parquet(path)

    def left():
        return {r.transaction_id for r in spark.read.parquet(path).collect()}

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "rows").rglob("*.parquet")}

    before = files()
    hit = feature_store.erase_stored(spark, path, spark.createDataFrame([("t4",), ("t5",), ("t6",), ("t7",), ("t20",)], "transaction_id string"))
    assert sorted(map(str, hit)) == ["2024-01-02", "2024-01-06"]
    assert left() == {f"t{i}" for i in range(40)} - {"t4", "t5", "t6", "t7", "t20"}
    untouched = {p for p in before if "2024-01-06" not in str(p) and "2024-01-02" not in str(p)}
    assert all(files()[p] == before[p] for p in untouched)
    assert feature_store.erase_stored(spark, path, df.where("transaction_id = 'none'")) == []
    feature_store.retain_stored(spark, path, "feature_store", datetime(2024, 2, 2, 9))
    assert left() == {f"t{i}" for i in range(40) if rows[i][1] >= datetime(2024, 1, 3, 9)} - {"t20"}


def test_every_tree_takes_rows_with_one_probability(spark):
    from riskloom.models.forest import IsolationForest

    model = IsolationForest(n_estimators=40, max_samples=16)
    model.sample_size, model.features = 16, ["x"]
    for n in (50, 3000):
        df = spark.range(n).selectExpr("cast(id AS string) AS transaction_id", "cast(id AS double) AS x")
        drawn = model._samples(df, n)
        assert drawn.count() == drawn.select("tree", "_id").distinct().count()
        sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
        want = min(n, 1.5 * 16 + 50)
        assert len(sizes) == 40 and abs(sum(sizes) / 40 - want) < 0.15 * want + 1
        assert {(r.tree, r._id) for r in drawn.collect()} == {(r.tree, r._id) for r in drawn.repartition(5).collect()}


def test_split_is_exact_when_hashes_tie(spark):
    from riskloom.operators.sampling import stratified_split

    rows = [("same", True)] * 50 + [(f"t{i}", i % 3 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "transaction_id string, is_fraud boolean")
    out = stratified_split(df, 0.3)
    assert out.count() == 250
    for r in out.groupBy("is_fraud").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect():
        assert r.t == int(r.n * 0.3 + 0.5)
