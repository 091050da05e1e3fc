"""Physical-plan assertions."""

import re

from pyspark.sql import functions as F

from fareflow.operators import joins as J
from fareflow.operators import layout as LY
from fareflow.plans import inputs as I
from fareflow.sources import driver as D


def test_zone_join_is_broadcast(spark, sf_small):
    t = I.notebook_trips(spark, sf_small)
    z = D.zones(spark, sf_small).select(F.col("locationid").alias("PULocationID"), "borough")
    j = J.hinted_join(t, z, "PULocationID", strategy="broadcast")
    assert "BroadcastHashJoin" in LY.join_strategies(j)


def test_building_a_query_starts_no_job(spark, sf_small):
    import __spark_entry__ as E
    qs = E.queries()
    names = ["job01_monthly_revenue_zone_id", "job02_fct_trips", "job05_staging_trips",
             "jon10_range_join_events", "jon16_filter_then_join", "agg27_zone_counts_duration"]
    for n in names:  # footers are read once per table
        qs[n](spark, sf_small)
    sc = spark.sparkContext
    sc.setJobGroup("building", "building")
    for n in names:
        qs[n](spark, sf_small)
    assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    sc.setJobGroup("tests", "tests")


def test_trip_lines_shuffle_each_large_table_once_per_key(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = LY.plan_text(D.trip_lines(spark, sf_small), "simple")
        for key in ("l_orderkey", "l_suppkey", "o_orderkey", "o_custkey", "c_custkey", "s_suppkey"):
            assert plan.count(f"Exchange hashpartitioning({key}") <= 1
        both = LY.plan_text(I.unioned(spark, sf_small), "formatted")
        assert both.count("lineitem.parquet") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_scan_equals_the_union_of_both_services(spark, sf_small):
    pairs = [(I.unioned, I.unioned_by_file), (I.ingestion_trips, I.ingestion_trips_by_file)]
    for one, two in pairs:
        a, b = one(spark, sf_small), two(spark, sf_small)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_and_shuffle_hash_hints(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = D.table(spark, sf_small, "orders")
        c = D.table(spark, sf_small, "customer").withColumnRenamed("c_custkey", "o_custkey")
        assert "SortMergeJoin" in LY.join_strategies(J.hinted_join(o, c, "o_custkey", strategy="merge"))
        assert "ShuffledHashJoin" in LY.join_strategies(J.hinted_join(o, c, "o_custkey", strategy="shuffle_hash"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_prunes_columns_and_pushes_filters(spark, sf_small):
    o = D.table(spark, sf_small, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = LY.plan_text(o)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_bucketed_join_has_no_exchange(spark, sf_small, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        li = D.table(spark, sf_small, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
        o = D.table(spark, sf_small, "orders").withColumnRenamed("o_orderkey", "orderkey")
        J.write_bucketed(li, "b_lineitem", "orderkey", 8, f"{tmp}/b_lineitem")
        J.write_bucketed(o, "b_orders", "orderkey", 8, f"{tmp}/b_orders")
        j = J.bucketed_join(spark, "b_lineitem", "b_orders", "orderkey")
        plan = LY.plan_text(j, "simple")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_copartitioned_join_adds_no_exchange_beyond_repartition(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        li = D.table(spark, sf_small, "lineitem").withColumnRenamed("l_orderkey", "k")
        o = D.table(spark, sf_small, "orders").withColumnRenamed("o_orderkey", "k")
        plan = LY.plan_text(J.copartitioned_join(li, o, "k", 8), "simple")
        assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L, 8\)", plan)) == 2
        assert plan.count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_range_join_is_an_equi_join_with_exact_bounds(spark, sf_small):
    ev = D.table(spark, sf_small, "events")
    ranges = ev.filter(F.col("event_type") == "signup").select(
        F.col("event_id").alias("range_id"), F.col("ts").alias("s"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("e"))
    wide, narrow = (J.range_join(ev, ranges, "ts", "s", "e", b) for b in (3600, 77))
    assert "BroadcastNestedLoopJoin" not in LY.join_strategies(wide)
    assert wide.count() == narrow.count()
    rows = [("in", "2024-01-01 00:00:00.000000"), ("in2", "2024-01-01 00:59:59.999999"),
            ("out", "2024-01-01 01:00:00.000000"), ("out2", "2023-12-31 23:59:59.999999")]
    e = spark.createDataFrame(rows, "k string, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    r = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 01:00:00")], "a string, b string")
    r = r.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("a", "b")])
    assert sorted(x.k for x in J.range_join(e, r, "t", "a", "b", 3600).collect()) == ["in", "in2"]


def test_range_join_deals_pairs_by_bucket_however_small_its_files(spark, tmp_path):
    """Pairs of two one-file tables are not left to the tasks of their few splits."""
    ev = spark.createDataFrame([(i, i % 40, i % 3 == 0) for i in range(400)] + [(400, None, False)],
                               "k long, m int, opens boolean")
    t = (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 150)).cast("timestamp_ntz")
    ev.withColumn("t", t).coalesce(1).write.parquet(f"{tmp_path}/events")
    ev = spark.read.parquet(f"{tmp_path}/events")
    ranges = ev.filter("opens").select(F.col("k").alias("r"), F.col("t").alias("lo"),
                                       (F.col("t") + F.expr("INTERVAL 20 MINUTES")).alias("hi"))
    j = J.range_join(ev, ranges, "t", "lo", "hi", 600)
    strategies = LY.join_strategies(j)
    assert "SortMergeJoin" in strategies and "BroadcastHashJoin" not in strategies
    assert j.columns == ["k", "m", "opens", "t", "r", "lo", "hi"]
    plain = ev.join(ranges, (F.col("t") >= F.col("lo")) & (F.col("t") < F.col("hi")))
    assert j.count() == plain.count() and j.exceptAll(plain).isEmpty()


def test_range_join_meets_events_in_blocks_and_tasks_are_not_coalesced(spark):
    """Busy times, NULLs, maps, equal rows and a column of the same name on both sides."""
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.when(F.col("id") < 2500, F.lit(5)).otherwise(F.col("id") * 7))
    ev = spark.range(4000).select(
        (F.col("id") % 900).alias("k"), F.when(F.col("id") != 3990, t).alias("t"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("v"),
        F.when(F.col("id") % 3 > 0, F.create_map(F.lit("a"), F.col("id") % 4)).alias("m"))
    ranges = spark.range(40).select(
        F.col("id").alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 500).alias("lo"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 590 + F.col("id") % 3 * 4000).alias("hi"))
    text = lambda d: d.toDF("k", "t", "v", "m", "k2", "lo", "hi").withColumn("m", F.to_json("m"))
    j = J.range_join(ev, ranges, "t", "lo", "hi", 600)
    plain = ev.join(ranges, (ev.t >= ranges.lo) & (ev.t < ranges.hi))
    assert j.columns == plain.columns and j.schema.simpleString() == plain.schema.simpleString()
    assert text(plain).count() > 9000
    assert text(j).exceptAll(text(plain)).isEmpty() and text(plain).exceptAll(text(j)).isEmpty()
    sizes = [r.n for r in J.event_blocks(ev.filter("t IS NOT NULL").withColumn("b", F.lit(1)), "b", "t")
             .select(F.size("__ats").alias("n")).collect()]
    assert sum(sizes) == 3999 and max(sizes) <= 1024 and len(sizes) < 40
    # Lists that nobody reads are not built; pairs have tasks of their own.
    plan = LY.plan_text(j.groupBy("lo").count(), "simple")
    tasks = J.PAIR_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "__event0" not in plan and "posexplode" in plan
    assert len(re.findall(rf"hashpartitioning\(__range_bucket#\w+, {tasks}\), REPARTITION_BY_NUM", plan)) == 2


def test_salted_join_equals_plain_join(spark, sf_small):
    t = I.notebook_trips(spark, sf_small)
    z = D.zones(spark, sf_small).select(F.col("locationid").alias("PULocationID"), "borough")
    a = J.salted_join(t, z, "PULocationID", 5, ["pickup_datetime", "fare_amount"])
    b = t.join(z, "PULocationID")
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
    hot = J.hot_keys(t, "PULocationID", 0.04)
    c = J.split_hot_join(t, z, "PULocationID", hot)
    assert c.exceptAll(b.select(*c.columns)).count() == 0 and c.count() == b.count()


def test_hot_join_with_null_keys_and_outer_kinds(spark):
    import pytest
    fact = spark.createDataFrame([(None if i % 2 else i % 5, i) for i in range(100)], "k int, v int")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (9, "z")], "k int, d string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = fact.join(dim, "k", how)
        got = J.split_hot_join(fact, dim, "k", [None, 0], how)
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    assert None not in J.hot_keys(fact, "k", 0.1)
    for how in ("right", "full", "outer"):
        with pytest.raises(ValueError):
            J.salted_join(fact, dim, "k", 4, ["v"], how)


def test_exact_percentile_equals_interpolated_quantile(spark):
    import random

    from fareflow.operators.aggregates import exact_percentile
    rng = random.Random(1)
    rows = [(g, rng.choice([rng.random(), float(rng.randrange(5)), rng.lognormvariate(0, 9)]))
            for g in ("a", "b", None) for _ in range(700)] + [("one", 4.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for p in (0.0, 0.25, 0.5, 0.99, 1.0):
        got = {r.g: r.p for r in exact_percentile(df, "g", "v", p).collect()}
        for g in {g for g, _ in rows}:
            v = sorted(x for k, x in rows if k == g and x is not None)
            if not v:
                assert got[g] is None
                continue
            k = int(p * (len(v) - 1))
            nxt = v[min(k + 1, len(v) - 1)]
            assert abs(got[g] - (v[k] + (nxt - v[k]) * (p * (len(v) - 1) - k))) <= 1e-9 * max(1, abs(got[g]))


def test_exact_percentile_plan_is_small(spark, sf_small):
    import re

    from fareflow.operators.aggregates import exact_percentile
    ev = D.table(spark, sf_small, "events")
    txt = LY.plan_text(exact_percentile(ev, "event_type", "value", 0.99), "simple")
    plan = txt.split("== Initial Plan ==")[-1]
    assert len(re.findall("FileScan|Scan parquet", plan)) <= 4 and len(re.findall("Join", plan)) <= 2


def test_top_k_ranks_by_the_full_score(spark):
    from fareflow.operators.aggregates import top_k_similar
    # Both scores round to the same six decimals; the larger id is the better one.
    store = spark.createDataFrame([(1, [1.0, 2e-7]), (2, [1.0, 1e-7]), (3, [1.0, 0.5])], "id long, v array<double>")
    q = spark.createDataFrame([(9, [1.0, -1.0])], "id long, v array<double>")
    out = top_k_similar(store, q, 1, "id", "v", "id", "v").collect()
    assert [(r.doc_id, r["rank"]) for r in out] == [(2, 1)]


def test_top_k_takes_any_number_of_queries(spark):
    import random

    from fareflow.operators.aggregates import top_k_similar
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(90)] + [(90, [0.0] * 6), (91, None)]
    store = spark.createDataFrame(rows, "id long, v array<double>")
    out = top_k_similar(store, store, 4, "id", "v", "id", "v", query_block=10, store_block=25)
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (
        sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)
    for i, a in rows[:90]:
        best = sorted((-round(cos(a, b), 12), j) for j, b in rows[:90])[:4]
        assert sorted(got[i]) == [(n + 1, j, round(-s, 6)) for n, (s, j) in enumerate(best)]
    assert set(got) == set(range(90))


def test_top_k_uses_partial_group_limit(spark, sf_small):
    from fareflow.operators.aggregates import top_k_similar
    emb = D.table(spark, sf_small, "embeddings")
    q = emb.groupBy("label").agg(F.first("embedding").alias("qv"))
    out = top_k_similar(emb, q, 3, "vec_id", "embedding", "label", "qv")
    assert "WindowGroupLimit" in LY.plan_text(out, "simple")
    assert out.groupBy("query_id").count().filter(F.col("count") != 3).count() == 0


def test_dedup_limits_each_key_before_the_shuffle(spark, sf_small):
    from fareflow.plans.models import FCT_KEY
    from fareflow.operators.windows import keep_first
    plan = LY.plan_text(keep_first(I.unioned(spark, sf_small), FCT_KEY, ["pickup_datetime"]), "simple")
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.rindex("Exchange hashpartitioning(vendor_id", 0, partial)
    assert exchange < partial  # the partial limit sits below (before) the exchange


def test_filter_before_join_is_the_same_plan(spark, sf_small):
    t = I.notebook_trips(spark, sf_small)
    z = D.zones(spark, sf_small).select(F.col("locationid").alias("PULocationID"), "zone")
    pred = (F.col("service_type") == "green") & (F.col("payment_type") == 1)
    before = t.filter(pred).join(z, "PULocationID")
    after = t.join(z, "PULocationID").filter(pred)
    opt = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    strip = lambda s: re.sub(r"#\d+L?", "", s)
    assert strip(opt(before)) == strip(opt(after))


def test_dataframe_and_sql_forms_agree(spark, sf_small):
    from fareflow.functions.columns import exact_avg
    import __spark_entry__ as E
    t = I.notebook_trips(spark, sf_small)
    df_form = (t.filter(F.col("fare_amount") > 50000).groupBy("PULocationID")
                .agg(exact_avg("tip_amount").alias("avg_tip")).orderBy(F.col("avg_tip").desc()))
    sql_form = E.queries()["agg20_sql_form"](spark, sf_small)
    assert df_form.exceptAll(sql_form).count() == 0 and sql_form.exceptAll(df_form).count() == 0
