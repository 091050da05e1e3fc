"""Load writers: idempotence and write-then-swap behaviour."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fareflow.operators import loads as L
from fareflow.plans import inputs as I
from fareflow.plans import models as M
from fareflow.plans.q_relational import snapshots
from fareflow.sources import driver as D


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_swaps(spark, tmp):
    p = f"{tmp}/t"
    L.write_swap(spark.range(3), p)
    L.write_swap(spark.read.parquet(p).withColumn("id", F.col("id") + 10), p)
    assert _rows(spark.read.parquet(p)) == [(10,), (11,), (12,)]
    assert sorted(os.listdir(tmp)) == ["t"]


def test_failed_rename_keeps_the_old_table(spark, tmp, monkeypatch):
    import pytest
    p = f"{tmp}/t"
    L.write_swap(spark.range(3), p)
    real = L.rename_path
    monkeypatch.setattr(L, "rename_path", lambda s, a, b: False if "staged" in a else real(s, a, b))
    with pytest.raises(OSError):
        L.write_swap(spark.range(9), p)
    monkeypatch.setattr(L, "rename_path", real)
    assert spark.read.parquet(p).count() == 3
    # A crash between the two renames: the next use restores the table.
    os.rename(p, p + ".old")
    assert L.table_exists(spark, p) and spark.read.parquet(p).count() == 3


def test_upsert_twice_equals_once(spark, sf_small, tmp):
    old, new = snapshots(spark, sf_small)
    p = f"{tmp}/cust"
    L.write_swap(old, p)
    L.upsert_table(spark, p, new, ["c_custkey"])
    once = _rows(spark.read.parquet(p))
    L.upsert_table(spark, p, new, ["c_custkey"])
    assert _rows(spark.read.parquet(p)) == once
    assert len(once) == old.select("c_custkey").union(new.select("c_custkey")).distinct().count()


def test_insert_only_merge_twice_adds_nothing(spark, sf_small, tmp):
    from fareflow.plans.q_loads import _landed_yellow
    src = _landed_yellow(spark, sf_small, "f.csv")
    p = f"{tmp}/landed"
    first = L.insert_only_table(spark, p, src, "unique_row_id")
    again = L.insert_only_table(spark, p, src, "unique_row_id")
    assert first == src.count() and again == 0
    assert spark.read.parquet(p).count() == src.count()


def test_interval_rerun_is_noop(spark, sf_small):
    staging = I.staging_trips(spark, sf_small)
    rep = M.trips_report(staging, I.ALL_START, I.ALL_END)
    again = L.replace_interval(rep, M.trips_report(staging, "1997-01-01 00:00:00", "1997-03-01 00:00:00"),
                               "trip_date", "1997-01-01 00:00:00", "1997-03-01 00:00:00", date_grain=True)
    assert rep.exceptAll(again).count() == 0 and again.exceptAll(rep).count() == 0


def test_partitioned_interval_replace_deletes_empty_days(spark, tmp):
    p = f"{tmp}/daily"
    rows = [(dt.datetime(2024, 1, d, 10), dt.date(2024, 1, d), d) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, day date, v int")
    df.write.partitionBy("day").parquet(p)
    new = spark.createDataFrame([(dt.datetime(2024, 1, 1, 11), dt.date(2024, 1, 1), 9)],
                                "ts timestamp_ntz, day date, v int")
    L.replace_interval_table(spark, p, new, "ts", "2024-01-01 00:00:00", "2024-01-03 00:00:00", "day")
    got = sorted((r.day, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(dt.date(2024, 1, 1), 9), (dt.date(2024, 1, 3), 3)]


def test_scd2_properties(spark, sf_small):
    old, new = snapshots(spark, sf_small)
    d1 = old.withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    d2 = new.withColumn("updated_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    h = L.scd2(None, d1, ["c_custkey"], "updated_at", ["c_acctbal", "c_mktsegment"])
    h = L.scd2(h, d2, ["c_custkey"], "updated_at", ["c_acctbal", "c_mktsegment"])
    open_rows = h.filter(F.col("valid_to").isNull())
    assert open_rows.count() == open_rows.select("c_custkey").distinct().count()
    assert h.filter(F.col("valid_to") <= F.col("valid_from")).count() == 0
    # applying the same snapshot again changes nothing
    h2 = L.scd2(h, d2, ["c_custkey"], "updated_at", ["c_acctbal", "c_mktsegment"])
    assert h2.exceptAll(h).count() == 0 and h.exceptAll(h2).count() == 0


def test_high_water_mark_first_run_takes_all(spark, sf_small):
    o = D.table(spark, sf_small, "orders")
    assert L.high_water_mark(None, o, "o_orderdate").count() == o.count()
    empty = o.limit(0)
    assert L.high_water_mark(empty, o, "o_orderdate").count() == o.count()


def test_replace_then_append(spark, tmp):
    p = f"{tmp}/chunks"
    chunks = [spark.range(0, 3), spark.range(3, 5)]
    L.replace_then_append(spark, chunks, p)
    assert spark.read.parquet(p).count() == 5


def test_skip_if_exists(spark, tmp):
    p = f"{tmp}/once"
    assert L.skip_if_exists(spark, p, lambda: spark.range(2))
    assert not L.skip_if_exists(spark, p, lambda: spark.range(5))
    assert spark.read.parquet(p).count() == 2


def test_daily_job_overwrites_only_its_day(spark, sf_small, tmp):
    p = f"{tmp}/daily_orders"
    o = D.table(spark, sf_small, "orders")
    days = [r[0].date().isoformat() for r in o.select("o_orderdate").distinct().limit(2).collect()]
    for d in days:
        L.daily_job(o, "o_orderdate", d, p)
    L.daily_job(o, "o_orderdate", days[0], p)
    got = spark.read.parquet(p)
    want = o.filter(F.to_date("o_orderdate").isin(days)).count()
    assert got.count() == want


def test_partition_scoped_upsert_equals_full_rewrite(spark, sf_small, tmp):
    from fareflow.functions.columns import hash_bucket
    old, new = snapshots(spark, sf_small)
    b_old = old.withColumn("bucket", hash_bucket(8, "c_custkey"))
    b_new = new.withColumn("bucket", hash_bucket(8, "c_custkey"))
    p = f"{tmp}/bucketed"
    L.upsert_table(spark, p, b_old, ["c_custkey"], partition_col="bucket")
    changed = b_new.join(b_old, ["c_custkey", "c_acctbal", "c_mktsegment", "bucket"], "left_anti")
    L.upsert_table(spark, p, changed, ["c_custkey"], partition_col="bucket")
    got = spark.read.parquet(p).select("c_custkey", "c_acctbal", "c_mktsegment")
    want = L.upsert(old, new, ["c_custkey"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_daily_job_without_rows_empties_its_day(spark, tmp):
    df = spark.createDataFrame([(1, "2024-01-01 05:00:00"), (2, "2024-01-02 05:00:00")], "k int, t string")
    df = df.withColumn("ts", F.col("t").cast("timestamp_ntz"))
    for d in ("2024-01-01", "2024-01-02"):
        L.daily_job(df, "ts", d, f"{tmp}/t")
    L.daily_job(df.filter("k <> 1"), "ts", "2024-01-01", f"{tmp}/t")
    assert [r.k for r in spark.read.parquet(f"{tmp}/t").collect()] == [2]
    L.daily_job(df.limit(0), "ts", "2024-03-01", f"{tmp}/t")  # a day that never had rows
    assert spark.read.parquet(f"{tmp}/t").count() == 1


def test_archive_keeps_equal_rows_and_repeats_open_runs(spark, tmp):
    import fareflow.operators.layout as LY
    from fareflow.session import touch
    row = spark.createDataFrame([(1, "1990-01-01"), (2, "2024-01-01")], "k int, t string").withColumn(
        "ts", F.col("t").cast("timestamp_ntz"))
    hot, cold = f"{tmp}/hot", f"{tmp}/cold"
    row.write.parquet(hot)
    run = lambda: LY.archive_split(spark.read.parquet(hot), "ts", "2000-01-01 00:00:00", hot, cold)
    count = lambda p: spark.read.parquet(p).count()
    assert run() == 1
    L.append(row.filter("k = 1"), hot)
    assert run() == 2 and count(cold) == 2 and count(hot) == 1
    # Stopped after the cold half: the hot table still holds the old rows.
    L.append(row.filter("k = 1"), hot)
    touch(spark, f"{cold}/_open_3")
    row.filter("k = 1").write.parquet(f"{cold}/archive_run=3")
    assert run() == 3 and count(cold) == 3 and count(hot) == 1
    # Stopped after the swap, before the run was closed: a new run begins.
    touch(spark, f"{cold}/_open_3")
    assert run() == 4 and count(cold) == 3 and count(hot) == 1
