"""Keyed state: per-event trailing rules and a profile that learns, restarted in mid-stream."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.session import scratch_path
from fareflow.streaming import jobs as S
from fareflow.streaming import trailing as TR

SCHEMA = "id long, k string, ts timestamp, v double, c string"


def _events(spark, n):
    """A hot key, NULL keys and values, repeated times, chunk bounds."""
    r = lambda m, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m))
    sec = F.when(F.col("id") % 50 == 0, F.floor(F.col("id") / 50) * 3600).otherwise(F.col("id") * 9 + r(5, 1))
    return spark.range(n).select(
        "id", F.when(r(10, 2) == 0, F.lit(None)).when(r(3, 3) == 0, F.lit("hot"))
        .otherwise(r(4, 4).cast("string")).alias("k"),
        F.timestamp_seconds(sec + 1_700_000_000).alias("ts"),
        F.when(r(9, 5) > 0, r(1000, 6) / 8).when(F.col("id") % 2 == 0, F.lit(float("nan"))).alias("v"),
        r(6, 7).cast("string").alias("c"))


def _in_two_runs(spark, events, cut, build, name):
    """Run over the first part, stop, add the second part, run again."""
    src, out, ck = (scratch_path(spark, f"{name}-{p}") for p in ("in", "out", "ck"))
    for part in (events.filter(F.col("id") < cut), events.filter(F.col("id") >= cut)):
        part.coalesce(1).write.mode("append").parquet(src)
        with TR.rocksdb_state(spark):
            frame = build(S.file_stream(spark, src, SCHEMA))
            S.run_available(frame, out, ck)
    return spark.read.schema(frame.schema).parquet(out), ck


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_trailing_average_over_a_restart(spark):
    ev = _events(spark, 1500).filter("id % 50 <> 0 or id < 10")
    got, _ = _in_two_runs(spark, ev, 700, lambda d: TR.trailing_average(
        d, "ts", "k", "id", "v", span_seconds=120, chunk_seconds=600, watermark="1 minute"), "avg")
    end = ev.agg(F.max("ts")).first()[0]
    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-120_000_000, 0)
    x = F.when(~F.isnan("v"), F.col("v"))
    want = ev.select("k", "id", "ts", F.round(F.avg(x).over(w), 6).alias("a"), F.count(x).over(w).alias("n"))
    want = want.filter(F.col("ts") <= F.lit(end) - F.expr("INTERVAL 1 MINUTE"))
    rows = _rows(got.withColumn("avg_value", F.round("avg_value", 6)))
    assert len(rows) > 1400 and rows == _rows(want)


def test_trailing_categories_over_a_restart(spark):
    ev = _events(spark, 900).filter("id % 50 <> 0")
    got, _ = _in_two_runs(spark, ev, 400, lambda d: TR.trailing_categories(
        d, "ts", "k", "id", "c", span_seconds=300, chunk_seconds=300, watermark="1 minute"), "cat")
    end = ev.agg(F.max("ts")).first()[0]
    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-300_000_000, 0)
    want = ev.select("k", "id", "ts", F.array_sort(F.collect_set("c").over(w)))
    assert _rows(got) == _rows(want.filter(F.col("ts") <= F.lit(end) - F.expr("INTERVAL 1 MINUTE")))


def test_profile_learns_and_survives_a_restart(spark):
    ev = _events(spark, 600)
    past, now = ev.filter("id < 20"), ev.filter("id >= 20")
    got, ck = _in_two_runs(spark, now, 300, lambda d: TR.learning_place_alerts(
        d, past, "ts", "k", "c", "id"), "place")
    known = {(r.k, r.c) for r in past.collect()}
    want = []
    for part in ("id < 300", "id >= 300"):
        for r in now.filter(part).orderBy("ts", "id").collect():
            if r.k is not None and (r.k, r.c) not in known:
                known.add((r.k, r.c))
                want.append(r.id)
    assert want and sorted(r.id for r in got.collect()) == sorted(want)
    learned = TR.learned_places(spark, ck, "k", "c")
    assert {(r.k, r.c) for r in learned.collect()} == {p for p in known if p[0] is not None}


def test_state_setting_is_put_back(spark):
    before = spark.conf.get(TR.PROVIDER, None)
    with TR.rocksdb_state(spark):
        assert spark.conf.get(TR.PROVIDER) == TR.ROCKSDB
    assert spark.conf.get(TR.PROVIDER, None) == before


def _state_groups(spark, ck, name):
    state = spark.read.format("statestore").option("path", ck).option("stateVarName", name).load()
    return state.select("key").distinct().count()


def test_many_keys_share_a_bucket_of_state(spark, monkeypatch):
    """A group is a bucket of keys: groups do not grow with the keys; NaN and NULL are keys."""
    monkeypatch.setattr(TR, "KEY_BUCKETS", 4)
    ev = spark.range(600).select(
        "id", F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).when(F.col("id") % 7 > 0, F.col("id") % 200 / 2)
        .alias("k"), F.timestamp_seconds(F.col("id") * 5 + 1_700_000_000).alias("ts"),
        (F.col("id") % 5).cast("string").alias("c"))
    src, out, ck = (scratch_path(spark, f"many-{p}") for p in ("in", "out", "ck"))
    ev.write.parquet(src)
    with TR.rocksdb_state(spark):
        frame = TR.trailing_categories(S.file_stream(spark, src, ev.schema), "ts", "k", "id", "c",
                                       span_seconds=1500, chunk_seconds=86_400, watermark="1 minute")
        S.run_available(frame, out, ck)
    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-1_500_000_000, 0)
    want = ev.select("k", "id", "ts", F.array_sort(F.collect_set("c").over(w)))
    end = ev.agg(F.max("ts")).first()[0]
    got = spark.read.schema(frame.schema).parquet(out)
    assert got.count() > 550
    assert _rows(got) == _rows(want.filter(F.col("ts") <= F.lit(end) - F.expr("INTERVAL 1 MINUTE")))
    assert 0 < _state_groups(spark, ck, "rows") <= 2 * 4


def test_many_places_share_a_bucket_of_state(spark, monkeypatch):
    monkeypatch.setattr(TR, "PLACE_BUCKETS", 4)
    ev = spark.range(400).select("id", (F.col("id") % 40).alias("k"), (F.col("id") % 70).cast("string").alias("c"),
                                 F.timestamp_seconds(F.col("id")).alias("ts"))
    src, out, ck = (scratch_path(spark, f"places-{p}") for p in ("in", "out", "ck"))
    ev.filter("id >= 50").write.parquet(src)
    with TR.rocksdb_state(spark):
        frame = TR.learning_place_alerts(S.file_stream(spark, src, ev.schema), ev.filter("id < 50"),
                                         "ts", "k", "c", "id")
        S.run_available(frame, out, ck)
    first = {}
    for i in range(400):
        first.setdefault((i % 40, i % 70), i)
    got = spark.read.schema(frame.schema).parquet(out).collect()
    assert sorted(r.id for r in got) == sorted(i for i in first.values() if i >= 50)
    assert TR.learned_places(spark, ck, "k", "c").count() == len(first)
    assert 0 < _state_groups(spark, ck, "seen") <= 4
