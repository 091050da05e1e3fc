"""Streaming: closed windows equal batch, late rows dropped, restarts add
nothing, CDC replay equals the final table (SURVEY §5 item 5)."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from fareflow.sources import driver as D
from fareflow.streaming import jobs as S


def _split_by_day(spark, sf, root):
    """The events table as one file per day (the stream's arrival order)."""
    ev = D.table(spark, sf, "events")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    for i, d in enumerate(days):
        ev.filter(F.to_date("ts") == F.lit(d)).coalesce(1).write.parquet(f"{root}/part-{i:03d}")
    return ev, days


def test_closed_windows_equal_batch(spark, sf_small, tmp):
    ev, _ = _split_by_day(spark, sf_small, f"{tmp}/in")
    stream = S.event_time(S.file_stream(spark, f"{tmp}/in/*", ev.schema, max_files_per_trigger=3))
    S.run_available(S.tumbling_counts(stream, "ts", "event_type"), f"{tmp}/out", f"{tmp}/ck")
    got = spark.read.parquet(f"{tmp}/out")
    batch = S.tumbling_counts(S.event_time(ev), "ts", "event_type", watermark=None)
    wm = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    closed = batch.filter(F.col("window_end") <= F.lit(wm))
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0


def test_late_rows_are_dropped(spark, tmp):
    schema = "event_id bigint, ts timestamp_ntz, event_type string"
    t0 = dt.datetime(2024, 1, 1, 14, 0)
    # Late rows are judged against the previous batch's watermark (Spark
    # 3.4+): after b0 the watermark is 14:10, so the 14:01 row arriving in
    # b2 belongs to a window already emitted and is dropped.
    batches = [
        [(1, t0, "a"), (2, t0 + dt.timedelta(minutes=20), "a")],
        [(4, t0 + dt.timedelta(minutes=40), "a")],
        [(3, t0 + dt.timedelta(minutes=1), "a")],            # 39 min behind: dropped
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp}/in/b{i}")
        # the file source orders by modification time: make arrival order explicit
        for f in glob.glob(f"{tmp}/in/b{i}/*.parquet"):
            os.utime(f, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    stream = S.event_time(S.file_stream(spark, f"{tmp}/in/*/*.parquet", schema, max_files_per_trigger=1))
    S.run_available(S.tumbling_counts(stream, "ts", "event_type"), f"{tmp}/out", f"{tmp}/ck")
    got = {(r.window_start, r.n) for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert (t0, 1) in got and (t0, 2) not in got


def test_restart_from_checkpoint_adds_nothing(spark, sf_small, tmp):
    ev, _ = _split_by_day(spark, sf_small, f"{tmp}/in")
    def run():
        s = S.file_stream(spark, f"{tmp}/in/*", ev.schema)
        S.run_available(S.stateless_clean(s), f"{tmp}/out", f"{tmp}/ck")
    run()
    n = spark.read.parquet(f"{tmp}/out").count()
    run()
    assert spark.read.parquet(f"{tmp}/out").count() == n == ev.filter("value >= 0").count()


def test_idempotent_foreach_batch_replay(spark, tmp):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    w = S.idempotent_append(f"{tmp}/sink")
    w(df, 0)
    w(df, 0)  # replay of the same batch id
    assert spark.read.parquet(f"{tmp}/sink").count() == 10


def test_cdc_replay_equals_final_table(spark, sf_small):
    from fareflow.plans.q_relational import snapshots
    from fareflow.streaming.q_streaming import cdc_changes
    old, new = snapshots(spark, sf_small)
    start = old.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"),
                       F.col("c_acctbal").alias("balance"))
    final = S.apply_changes(start, cdc_changes(spark, sf_small))
    want = new.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"),
                      F.col("c_acctbal").alias("balance"))
    assert final.exceptAll(want).count() == 0 and want.exceptAll(final).count() == 0


def test_late_older_changes_do_not_win(spark, tmp):
    row = "op string, before struct<id: bigint, name: string, balance: double>, " \
          "after struct<id: bigint, name: string, balance: double>, seq bigint"
    S.init_cdc_table(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)],
                                           "id bigint, name string, balance double"), f"{tmp}/t")
    w = S.cdc_writer(f"{tmp}/t")
    batch = lambda rows: spark.createDataFrame(rows, row)
    w(batch([("u", (1, "a", 1.0), (1, "a5", 5.0), 5), ("d", (2, "b", 2.0), None, 6)]), 0)
    w(batch([("u", (1, "a", 1.0), (1, "a3", 3.0), 3), ("u", (2, "b", 2.0), (2, "b4", 4.0), 4),
             ("c", None, (4, "d", 4.0), 7)]), 1)
    want = [(1, "a5", 5.0), (3, "c", 3.0), (4, "d", 4.0)]
    read = lambda: sorted(tuple(r) for r in S.read_cdc(spark, f"{tmp}/t").collect())
    assert read() == want
    S.compact_cdc(spark, f"{tmp}/t")
    w(batch([("u", (2, "b", 2.0), (2, "zz", 9.0), 2)]), 2)  # older than the deletion
    assert read() == want


def test_stream_and_batch_share_transform(spark, sf_small):
    ev = D.table(spark, sf_small, "events")
    batch = {r.event_type: r.n for r in S.count_by_key(ev, "event_type").collect()}
    stream = S.run_to_table(S.count_by_key(S.file_stream(spark, f"{sf_small}/events.parquet", ev.schema),
                                           "event_type"), "shared", mode="complete")
    assert {r.event_type: r.n for r in stream.collect()} == batch


def test_dedup_within_watermark(spark, sf_small):
    ev = D.table(spark, sf_small, "events")
    s1 = S.event_time(S.file_stream(spark, f"{sf_small}/events.parquet", ev.schema))
    s2 = S.event_time(S.file_stream(spark, f"{sf_small}/events.parquet", ev.schema))
    out = S.run_to_table(S.dedup_events(s1.unionByName(s2), ["event_id"], "ts"), "dedup")
    assert out.count() == ev.count()


def test_processing_time_trigger(spark, sf_small, tmp):
    ev = D.table(spark, sf_small, "events")
    q = S.start_micro_batches(S.stateless_clean(S.file_stream(spark, f"{sf_small}/events.parquet", ev.schema)),
                              f"{tmp}/out", f"{tmp}/ck", "1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{tmp}/out").count() == ev.filter("value >= 0").count()


def test_restart_processes_only_new_files(spark, sf_small, tmp):
    ev, days = _split_by_day(spark, sf_small, f"{tmp}/all")
    import shutil
    os.makedirs(f"{tmp}/in")
    parts = sorted(glob.glob(f"{tmp}/all/part-*"))
    half = len(parts) // 2
    for p in parts[:half]:
        shutil.copytree(p, f"{tmp}/in/{os.path.basename(p)}")
    def run():
        s = S.file_stream(spark, f"{tmp}/in/*/*.parquet", ev.schema)
        S.run_available(S.stateless_clean(s), f"{tmp}/out", f"{tmp}/ck")
    run()
    first = spark.read.parquet(f"{tmp}/out").count()
    for p in parts[half:]:
        shutil.copytree(p, f"{tmp}/in/{os.path.basename(p)}")
    run()
    assert first < spark.read.parquet(f"{tmp}/out").count() == ev.filter("value >= 0").count()
