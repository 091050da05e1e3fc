"""Sketches per period, merged: ranks, distinct counts, retention, replays."""

import random

from pyspark.sql import functions as F

from fareflow.operators import sketches as SK
from fareflow.plans.metrics import week_start, weekly_retention
from fareflow.streaming import jobs as S


def test_merged_quantiles_stay_in_bound(spark, tmp):
    rng = random.Random(1)
    rows = [(d, g, rng.lognormvariate(0, 2)) for d in range(10) for g in ("a", "b") for _ in range(3000)]
    rows += [(3, "none", None), (4, "none", float("nan"))]
    df = spark.createDataFrame(rows, "day int, g string, v double")
    SK.store_periods(SK.quantile_sketches(df, ["day", "g"], "v"), f"{tmp}/s", "day")
    merged = SK.merge_quantiles(SK.stored(spark, f"{tmp}/s"), ["g"])
    for p in (0.01, 0.5, 0.99):
        out = merged.withColumn("q", SK.quantile(p))
        got = {r.g: (r.n, r.q) for r in out.select("g", "n", "q").collect()}
        assert got["a"][0] == 30_000 and got["none"] == (0, None)
        miss = {r.g: r.miss for r in SK.rank_miss(df, out, "g", "v", "q", p).collect()}
        assert miss["a"] <= 2 * SK.quantile_rank_error(SK.QUANTILE_SIZE)
        assert miss["b"] <= 2 * SK.quantile_rank_error(SK.QUANTILE_SIZE)


def test_a_period_stored_again_replaces_itself(spark, tmp):
    df = spark.createDataFrame([(d, "a", float(i)) for d in (1, 2) for i in range(100)],
                               "day int, g string, v double")
    for part in (df, df.filter("day = 2")):
        SK.store_periods(SK.quantile_sketches(part, ["day", "g"], "v"), f"{tmp}/s", "day")
    r = SK.merge_quantiles(SK.stored(spark, f"{tmp}/s"), ["g"]).withColumn("q", SK.quantile(0.5)).first()
    assert r.n == 200 and 48 <= r.q <= 51


def test_few_values_are_exact(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (3, 1, 2, 2, 9)], "g string, v double")
    out = SK.quantile_sketches(df, ["g"], "v").withColumn("q", SK.quantile(0.5)).first()
    assert out.q == 2.0


def test_retention_from_sketches(spark, tmp):
    rng = random.Random(2)
    rows = [(u, f"2024-0{1 + w // 4}-{1 + 7 * (w % 4):02d} 10:00:00") for u in range(400)
            for w in range(8) if rng.random() < 0.3]
    df = spark.createDataFrame(rows, "u long, t string").select("u", F.col("t").cast("timestamp_ntz").alias("ts"))
    SK.store_periods(SK.distinct_sketches(df, [week_start("ts").alias("wk")], "u"), f"{tmp}/w", "wk")
    weekly = SK.stored(spark, f"{tmp}/w")
    got = {(str(r.cohort), r.offset): r.users for r in SK.retention(weekly, "wk").collect()}
    want = {(str(r.cohort_week), r.week_offset): r.users for r in weekly_retention(df, "u", "ts").collect()}
    assert got == want  # below the sketch's size the counts are exact
    assert SK.merge_distinct(weekly, []).select(SK.distinct_count()).first()[0] == df.select("u").distinct().count()


def test_large_distinct_counts_stay_in_bound(spark):
    df = spark.range(300_000).select((F.col("id") % 100_000).alias("u"), (F.col("id") % 3).alias("d"))
    n = SK.merge_distinct(SK.distinct_sketches(df, ["d"], "u"), []).select(SK.distinct_count()).first()[0]
    assert abs(n - 100_000) <= 5 * SK.distinct_error(SK.DISTINCT_LG) * 100_000


def test_a_replayed_batch_replaces_its_sketches(spark, tmp):
    df = spark.createDataFrame([(f"2024-01-01 00:00:{i:02d}", "a", float(i)) for i in range(50)],
                               "ts string, g string, v double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    write = S.sketch_batches(f"{tmp}/b", "ts", ["g"], "v")
    for batch_id in (0, 1, 1):
        write(df, batch_id)
    r = SK.merge_quantiles(spark.read.parquet(f"{tmp}/b"), ["day", "g"]).first()
    assert r.n == 100
