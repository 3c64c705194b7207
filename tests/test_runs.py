"""Tables that grow by epochs: merged runs, the last-seen table, and features that read them."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from riskloom.operators.features import FeatureGroups, with_features_after
from riskloom.sources.runs import LastSeen, Run, Runs, history, with_day

START = datetime(2024, 1, 1)
NUMBER = T.StructType([T.StructField("n", T.LongType())])
TXN = "transaction_id string, timestamp timestamp, amount decimal(18,2), card_id string, merchant_id string"


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], NUMBER)


def test_runs_stay_few_and_keep_every_row(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"), NUMBER, fan=3)
    assert runs.before().collect() == [] and runs.next_epoch() == 0
    most = 0
    for epoch in range(30):
        runs.merge(epoch)
        runs.append(numbers(spark, epoch, epoch), epoch)
        most = max(most, len(runs.runs()))
        if epoch % 7 == 0:
            assert sorted(r.n for r in runs.before(epoch).collect()) == sorted(2 * list(range(epoch)))
    assert most <= 3 * 4 and runs.next_epoch() == 30
    folders = [p.name for p in (tmp_path / "runs").iterdir() if p.is_dir()]
    assert sorted(folders) == sorted(r.name for r in runs.runs())
    assert sorted(r.n for r in runs.before().collect()) == sorted(2 * list(range(30)))


def test_replay_replaces_its_run_and_sees_earlier_ones_only(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"), NUMBER, fan=2)
    for epoch in range(4):
        runs.merge(epoch)
        runs.append(numbers(spark, epoch), epoch)
    for _ in range(2):
        runs.merge(3)
        assert [r.n for r in runs.append(numbers(spark, 30), 3).collect()] == [30]
        assert sorted(r.n for r in runs.before(3).collect()) == [0, 1, 2]
    assert sorted(r.n for r in runs.before().collect()) == [0, 1, 2, 30]


def test_an_unfinished_merge_is_ignored(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"), NUMBER, fan=2)
    for epoch in range(2):
        runs.append(numbers(spark, epoch), epoch)
    half = tmp_path / "runs" / Run(1, 0, 1).name
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    assert sorted(r.n for r in runs.before().collect()) == [0, 1]
    runs.merge(2)
    assert [r.name for r in runs.runs()] == ["level1-0-1"]
    assert sorted(r.n for r in runs.before().collect()) == [0, 1]


def rows_of(rng, n, first_day, days, cards=12):
    out = []
    for _ in range(n):
        at = START + timedelta(days=first_day, minutes=rng.randrange(days * 1440))
        card = None if rng.random() < 0.1 else f"c{rng.randrange(cards)}"
        out.append((f"t{rng.getrandbits(40):011d}", at, None, card, f"m{rng.randrange(3)}"))
    return out


def test_last_seen_against_all_rows(spark, tmp_path):
    rng = random.Random(3)
    seen = LastSeen(spark, str(tmp_path / "seen"), ("card_id", "merchant_id", "customer_id"), fan=3)
    everything = []
    for epoch in range(14):
        rows = rows_of(rng, 25, epoch * 6, 7) + rows_of(rng, 2, max(0, epoch * 6 - 20), 3)
        seen.update(spark.createDataFrame(rows, TXN), epoch)
        everything.append(rows)
        if epoch % 4 < 3:
            continue
        for before, back in ((epoch, 0), (epoch, 8), (None, 2)):
            day = (START + timedelta(days=epoch * 6 - back)).date()
            known = [r for e in everything[: before if before is not None else epoch + 1] for r in e]
            for entity, place in (("card_id", 3), ("merchant_id", 4)):
                want = {}
                for r in known:
                    if r[place] is not None and r[1].date() < day:
                        want[r[place]] = max(want.get(r[place], r[1]), r[1])
                got = {}
                for r in seen.seen_before(entity, day, before).collect():
                    got[r[0]] = max(got.get(r[0], r[1]), r[1])
                assert got == want
    assert seen.seen_before("card_id", START.date()) is None  # folded: the caller reads the past
    assert seen.seen_before("customer_id", (START + timedelta(days=90)).date()).collect() == []


@pytest.mark.parametrize("late", [False, True])
def test_features_with_the_table_equal_features_without(spark, tmp_path, late):
    rng = random.Random(8)
    groups = FeatureGroups(aggregations=False, temporal=False, risk=False)
    schema = "transaction_id string, timestamp timestamp, amount decimal(18,2), card_id string, merchant_id string, email_domain string, is_online boolean"
    past = [(*r, None, True) for r in rows_of(rng, 150, 0, 60, cards=40)]
    batch = [(*r, None, True) for r in rows_of(rng, 30, 20 if late else 60, 2, cards=40)]
    df = spark.createDataFrame(past, schema)
    stored = history(spark, str(tmp_path / "history"), df.schema, fan=2)
    seen = LastSeen(spark, str(tmp_path / "seen"), ("card_id", "merchant_id", "customer_id"), fan=2)
    for epoch in range(5):
        part = spark.createDataFrame(past[epoch::5], schema)
        stored.merge(epoch)
        stored.append(with_day(part), epoch)
        seen.update(part, epoch)
    asked = spark.createDataFrame(batch, schema)
    plain = with_features_after(asked, df, groups)
    table = with_features_after(asked, stored.before(5), groups, last_seen=seen, before=5, day="day")
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, plain.collect()))
    gaps = {r["card_hours_since_last"] for r in plain.collect()}
    assert any(168 < g < 9999 for g in gaps)


def test_a_batch_reads_the_days_it_reaches(spark, tmp_path):
    rng = random.Random(9)
    stored = history(spark, str(tmp_path / "history"), spark.createDataFrame([], TXN).schema)
    stored.append(with_day(spark.createDataFrame(rows_of(rng, 200, 0, 60), TXN)), 0)
    seen = LastSeen(spark, str(tmp_path / "seen"), ("card_id", "merchant_id"))
    seen.update(stored.before(1), 0)
    batch = spark.createDataFrame(rows_of(rng, 10, 60, 1), TXN)
    groups = FeatureGroups(aggregations=False, temporal=False, risk=False)
    batch = batch.selectExpr("*", "'a' AS email_domain", "true AS is_online")
    past = stored.before(1).selectExpr("*", "'a' AS email_domain", "true AS is_online")
    out = with_features_after(batch, past, groups, last_seen=seen, before=1, day="day")
    files = [f for f in out.inputFiles() if "history" in f]
    days = {f.split("day=")[1][:10] for f in files}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and days
