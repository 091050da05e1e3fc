"""Skew: one key holding about a third of all rows.

The skewed inputs are derived from the driver tables; every skew-handling
path must return exactly what the plain computation returns.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators import aggregates as A
from fareflow.operators import joins as J
from fareflow.operators import windows as W
from fareflow.plans import inputs as I
from fareflow.sources import driver as D


def _same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.exceptAll(a.select(*b.columns)).count() == 0


def _skewed_trips(spark, sf):
    """Trips where the short-line third of all rows starts in zone 0."""
    t = I.notebook_trips(spark, sf)
    return t.withColumn("PULocationID", F.when(F.col("passenger_count") <= 2, F.lit(0))
                        .otherwise(F.col("PULocationID")))


def test_hot_key_is_found_and_joins_agree(spark, sf_small):
    t = _skewed_trips(spark, sf_small)
    share = t.filter(F.col("PULocationID") == 0).count() / t.count()
    assert share > 0.25
    z = D.zones(spark, sf_small).select(F.col("locationid").alias("PULocationID"), "borough")
    plain = t.join(z, "PULocationID")
    hot = J.hot_keys(t, "PULocationID", 0.2)
    assert hot == [0]
    assert _same(J.split_hot_join(t, z, "PULocationID", hot), plain)
    assert _same(J.salted_join(t, z, "PULocationID", 16, ["pickup_datetime", "dropoff_datetime", "fare_amount"]),
                 plain)


def test_salted_sum_under_skew(spark, sf_small):
    t = _skewed_trips(spark, sf_small)
    plain = t.groupBy("PULocationID").agg(F.round(F.sum("fare_amount"), 2).alias("s"))
    salted = A.salted_sum(t, "PULocationID", "fare_amount", 16, ["pickup_datetime", "fare_amount"])
    salted = salted.select("PULocationID", F.round("sum_fare_amount", 2).alias("s"))
    assert _same(plain, salted)


def test_dedup_with_a_hot_key(spark, sf_small):
    u = I.unioned(spark, sf_small)
    from fareflow.plans.models import FCT_KEY
    # a third of the rows collapse onto one key
    hot = u.withColumn("vendor_id", F.when(F.col("passenger_count") <= 2, F.lit(9)).otherwise(F.col("vendor_id")))
    hot = hot.withColumn("trip_distance", F.when(F.col("vendor_id") == 9, F.lit(0).cast("decimal(18,3)"))
                         .otherwise(F.col("trip_distance")))
    for c in ("pickup_datetime", "dropoff_datetime"):
        hot = hot.withColumn(c, F.when(F.col("vendor_id") == 9, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
                             .otherwise(F.col(c)))
    for c in ("pickup_location_id", "dropoff_location_id"):
        hot = hot.withColumn(c, F.when(F.col("vendor_id") == 9, F.lit(0)).otherwise(F.col(c)))
    a = W.keep_first(hot, FCT_KEY, ["pickup_datetime"])
    b = W.keep_first_aggregate(hot, FCT_KEY, ["pickup_datetime"])
    assert _same(a, b)
    assert a.filter(F.col("vendor_id") == 9).count() == 1


def test_chunked_moving_average_with_a_hot_user(spark, sf_small):
    ev = D.table(spark, sf_small, "events").withColumn(
        "user_id", F.when(F.col("event_type").isin("view", "click"), F.lit(0)).otherwise(F.col("user_id")))
    assert ev.filter("user_id = 0").count() / ev.count() > 0.3
    got = W.moving_average(ev, "user_id", "ts", "value", 300, chunk_seconds=1800)
    secs = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    w = Window.partitionBy("user_id").orderBy(secs).rangeBetween(-300, 0)
    want = ev.withColumn("moving_avg", F.avg("value").over(w))
    r = lambda d: d.select("event_id", F.round("moving_avg", 9).alias("m"))
    assert _same(r(got), r(want))


def test_hot_keys_equal_the_full_count(spark, sf_small):
    t = _skewed_trips(spark, sf_small).select("PULocationID").unionByName(
        spark.range(500).select(F.lit(None).cast("int").alias("PULocationID")))
    n = t.count()
    for share in (0.3, 0.05, 0.03, 0.0001):
        want = {r[0] for r in t.groupBy("PULocationID").count().collect()
                if r[0] is not None and r[1] >= n * share}
        assert set(J.hot_keys(t, "PULocationID", share)) == want
    assert J.hot_keys(t.limit(0), "PULocationID", 0.1) == []


def test_ranges_of_all_scales(spark):
    """One hot second, ranges from a microsecond to decades, bounds on both sides of 1970."""
    base = F.timestamp_micros
    events = spark.range(1500).select("id", base(
        F.when(F.col("id") % 3 == 0, F.lit(1_000_000)).otherwise(
            F.pmod(F.xxhash64("id"), F.lit(4 * 10**15)) - 2 * 10**15)).alias("ts"))
    events = events.unionByName(spark.range(3).select("id", F.lit(None).cast("timestamp").alias("ts")))
    at = F.pmod(F.xxhash64("r", F.lit(1)), F.lit(4 * 10**15)) - 2 * 10**15
    ranges = spark.range(60).withColumnRenamed("id", "r").select(
        "r", base(F.when(F.col("r") % 4 == 0, F.lit(1_000_000)).otherwise(at)).alias("lo"),
        F.pow(F.lit(10), F.col("r") % 17).cast("long").alias("len"))
    ranges = ranges.withColumn("hi", base(F.unix_micros("lo") + F.col("len")))
    ranges = ranges.unionByName(spark.sql(
        "select 90L r, timestamp'2000-01-01' lo, 0L len, timestamp'2000-01-01' hi union all "
        "select 91L, null, 0L, timestamp'2000-01-01'"))
    plain = events.join(ranges, (F.col("ts") >= F.col("lo")) & (F.col("ts") < F.col("hi")))
    assert plain.count() > 5000
    used = J.levels_in_use(ranges, "lo", "hi")
    for kw in ({}, {"used": used}, {"unit_seconds": 60, "levels": 12}, {"levels": 13, "salts": 1}):
        assert _same(J.multiscale_range_join(events, ranges, "ts", "lo", "hi", **kw), plain)
    pieces = J.range_pieces(ranges, "lo", "hi").filter("__level < 15").groupBy("r", "__level").count()
    assert pieces.agg(F.max("count")).first()[0] <= 6
    empty = ranges.limit(0)
    assert J.levels_in_use(empty, "lo", "hi") == []
    assert J.multiscale_range_join(events, empty, "ts", "lo", "hi", used=[]).count() == 0


def test_multiplied_events_are_not_broadcast(spark, tmp):
    """A small file, but 16 rows an event: the real size decides, not the file's."""
    spark.range(1).selectExpr("id", "timestamp'2024-01-01' ts", "explode(sequence(1, 60000)) n").drop(
        "n").write.parquet(f"{tmp}/events")
    events = spark.read.parquet(f"{tmp}/events")
    ranges = spark.range(100000).filter("id < 50").selectExpr("id r", "timestamp'2023-12-31' lo", "timestamp'2024-01-02' hi")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "300000")
    try:
        j = J.multiscale_range_join(events, ranges, "ts", "lo", "hi").groupBy("r").count()
        assert {tuple(x) for x in j.collect()} == {(i, 60000) for i in range(50)}
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "BuildLeft" not in plan.split("Initial Plan")[0] and "isFinalPlan=true" in plan
