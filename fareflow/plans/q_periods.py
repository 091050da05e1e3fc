"""Clustered layouts, stored sketches and repeated loads as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import columns as C
from fareflow.functions import sqlnames as SN
from fareflow.operators import clustering as CL
from fareflow.operators import digests as DG
from fareflow.operators import keyindex as K
from fareflow.operators import layout as LY
from fareflow.operators import loads as L
from fareflow.operators import sketches as SK
from fareflow.operators import variants as V
from fareflow.plans.catalog import query
from fareflow.plans.metrics import week_start, weekly_retention
from fareflow.plans.oracle import sql
from fareflow.plans.q_io import DAY
from fareflow.plans.q_loads import _ROW_ID_SQL, _landed_yellow
from fareflow.plans.q_relational import _SNAP_NEW, _SNAP_OLD, snapshots
from fareflow.session import scratch_path, staged
from fareflow.sources import driver as D
from fareflow.streaming import jobs as S

# ---------------------------------------------------------------- clustering
BOX = {"l_shipdate": ("1996-01-01", "1996-12-31"), "l_partkey": (0, 100)}


@query("lay06_curve_layout", ids=("LAY-06", "LAY-05"),
       oracle="""
SELECT l_returnflag, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS quantity, 32 AS files,
       TRUE AS opens_under_half
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate <= TIMESTAMP '1996-12-31' AND l_partkey BETWEEN 0 AND 100
GROUP BY 1""")
def lay06_curve(spark, sf):
    """The line items clustered by ship date and part; the rows of a box in
    both, and the files that their minimum and maximum leave to open."""
    path = scratch_path(spark, "lay06")
    li = D.table(spark, sf, "lineitem")
    CL.write_clustered(li, path, ["l_shipdate", "l_partkey"], files=32)
    box = {c: tuple(F.lit(x).cast(li.schema[c].dataType) for x in ends) for c, ends in BOX.items()}
    inside = F.lit(True)
    for c, (low, high) in box.items():
        inside = inside & F.col(c).between(low, high)
    rows = (spark.read.parquet(path).filter(inside).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")))
    pruned = CL.files_for_box(CL.file_bounds(spark, path, list(BOX)), box)
    files = lambda c: pruned.select(c).scalar()
    return rows.select("l_returnflag", "n", "quantity", files("files").cast("int").alias("files"),
                       (files("opened") * 2 < files("files")).alias("opens_under_half"))


# ---------------------------------------------------------------- sketches
P99 = 0.99


def _near(miss):
    """Within twice the 99 % bound of the sketch's rank."""
    return miss <= F.lit(2 * SK.quantile_rank_error(SK.QUANTILE_SIZE))


def _month_key():
    return F.concat_ws("|", F.date_format("day", "yyyy-MM"), "event_type")


def _checked(ev, merged):
    """Merged sketches with the miss of their p99, counted over all events."""
    m = merged.withColumn("p99", SK.quantile(P99)).withColumn("key", _month_key_of_month())
    rows = ev.withColumn("day", F.to_date("ts")).withColumn("key", _month_key())
    miss = SK.rank_miss(rows, m, "key", "value", "p99", P99)
    return m.join(miss, "key").select("month", "event_type", "n", _near(F.col("miss")).alias("p99_in_bound"))


def _month_key_of_month():
    return F.concat_ws("|", F.date_format("month", "yyyy-MM"), "event_type")


SKETCH_SQL = """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, count(value) AS n, TRUE AS p99_in_bound
FROM events GROUP BY 1, 2"""


@query("agg23_sketches_by_month", ids=("AGG-23", "AGG-26"), oracle=SKETCH_SQL)
def agg23_sketches(spark, sf):
    """Daily KLL sketches stored, then merged to months; one day is stored
    twice, which changes nothing."""
    path = scratch_path(spark, "agg23-sketches")
    ev = D.table(spark, sf, "events")
    daily = SK.quantile_sketches(ev, [F.to_date("ts").alias("day"), "event_type"], "value")
    SK.store_periods(daily, path, "day")
    again = ev.filter(F.to_date("ts") == F.lit("2024-01-15").cast("date"))
    SK.store_periods(SK.quantile_sketches(again, [F.to_date("ts").alias("day"), "event_type"], "value"),
                     path, "day")
    months = SK.merge_quantiles(SK.stored(spark, path), [F.trunc("day", "month").alias("month"), "event_type"])
    return _checked(ev, months)


@query("str15_sketch_stream", ids=("STR-15", "AGG-23", "STR-04"), oracle=SKETCH_SQL)
def str15_sketch_stream(spark, sf):
    """Each micro-batch stores its own daily sketches; months merge them."""
    out, ck = scratch_path(spark, "str15-sketches"), scratch_path(spark, "str15-ck")
    ev = D.table(spark, sf, "events")
    stream = S.event_time(S.file_stream(spark, f"{sf.rstrip('/')}/events.parquet", ev.schema))
    S.run_foreach_batch(stream, ck, S.sketch_batches(out, "ts", ["event_type"], "value"))
    months = SK.merge_quantiles(spark.read.parquet(out),
                                [F.trunc("day", "month").alias("month"), "event_type"])
    return _checked(ev, months)


@query("agg28_sketch_retention", ids=("AGG-28", "AGG-13"),
       oracle="""
WITH w AS (SELECT user_id, date_trunc('week', ts) AS wk FROM events),
f AS (SELECT user_id, min(wk) AS cohort FROM w GROUP BY 1)
SELECT CAST(f.cohort AS DATE) AS cohort_week,
       CAST(date_diff('day', f.cohort, w.wk) / 7 AS INTEGER) AS week_offset,
       count(DISTINCT w.user_id) AS users, TRUE AS in_bound
FROM w JOIN f USING (user_id) GROUP BY 1, 2""")
def agg28_sketches(spark, sf):
    """Retention from weekly theta sketches beside the exact counts: the
    estimate is within five standard errors of the week's users."""
    path = scratch_path(spark, "agg28-sketches")
    ev = D.table(spark, sf, "events")
    SK.store_periods(SK.distinct_sketches(ev, [week_start("ts").alias("week")], "user_id"), path, "week")
    weekly = SK.stored(spark, path)
    guess = SK.retention(weekly, "week").select(
        F.col("cohort").alias("cohort_week"), F.col("offset").alias("week_offset"),
        F.col("users").alias("guess"))
    size = weekly.select(F.col("week").alias("cohort_week"), SK.distinct_count().alias("in_week"))
    slack = F.lit(5 * SK.distinct_error(SK.DISTINCT_LG)) * F.col("in_week") + 0.5
    exact = weekly_retention(ev, "user_id", "ts")
    return (exact.join(guess, ["cohort_week", "week_offset"], "full").join(size, "cohort_week", "left")
            .select("cohort_week", "week_offset", "users",
                    (F.abs(F.coalesce("guess", F.lit(0)) - F.coalesce("users", F.lit(0))) <= slack)
                    .alias("in_bound")).filter(F.col("users").isNotNull()))


# ---------------------------------------------------------------- repeated loads
@query("load10_empty_rerun", ids=("LOAD-10", "LOAD-16", "SNK-10"),
       oracle=f"""
SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS n FROM orders
WHERE CAST(o_orderdate AS DATE) <> DATE '{DAY}' GROUP BY 1""")
def load10_empty(spark, sf):
    """A day is loaded, then rerun after all its orders were withdrawn."""
    path = scratch_path(spark, "load10-empty")
    o = D.table(spark, sf, "orders")
    LY.write_by_date(o, path, "o_orderdate", "dt")
    L.daily_job(o, "o_orderdate", DAY, path)
    L.daily_job(o, "o_orderdate", DAY, path, lambda d: d.filter(F.col("o_orderkey") < 0))
    return spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


PERIODS = {"to_1995.csv": ("1990-01-01", "1996-01-01"), "1996.csv": ("1996-01-01", "1997-01-01"),
           "1997.csv": ("1997-01-01", "1998-01-01"), "from_1998.csv": ("1998-01-01", "2030-01-01")}


@query("load06_key_index", ids=("LOAD-06", "LOAD-08", "LOAD-13", "JON-18"),
       oracle=sql("""
SELECT CASE WHEN tpep_pickup_datetime < TIMESTAMP '1996-01-01' THEN 'to_1995.csv'
            WHEN tpep_pickup_datetime < TIMESTAMP '1997-01-01' THEN '1996.csv'
            WHEN tpep_pickup_datetime < TIMESTAMP '1998-01-01' THEN '1997.csv' ELSE 'from_1998.csv' END AS filename,
       count(*) AS n, count(DISTINCT unique_row_id) AS ids, TRUE AS new_opens_few, TRUE AS rerun_opens_few
FROM (SELECT """ + _ROW_ID_SQL + """ AS unique_row_id, * FROM raw_yellow) GROUP BY 1"""))
def load06_key_index(spark, sf):
    """Trips loaded period by period through the key index, then 1996 again under
    another file name: every row is there once, and neither the last new period
    nor the rerun opens half of the table's files."""
    path = scratch_path(spark, "load06-keyed")
    trips = staged(_landed_yellow(spark, sf, ""), "load06-trips")
    n = trips.count()

    def load(period, filename):
        low, high = (F.lit(x).cast("timestamp_ntz") for x in PERIODS[period])
        at = F.col("tpep_pickup_datetime")
        rows = trips.filter((at >= low) & (at < high)).withColumn("filename", F.lit(filename))
        return K.insert_only_indexed(spark, path, rows, "unique_row_id", max(n // 16, 1))

    for period in PERIODS:
        new = load(period, period)
    rerun = load("1996.csv", "rerun.csv")
    return spark.read.parquet(path).groupBy("filename").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("unique_row_id").alias("ids"),
        F.lit(2 * new.opened < new.files).alias("new_opens_few"),
        F.lit(2 * rerun.opened < rerun.files).alias("rerun_opens_few"))


@query("lay13_archive_equal_rows", ids=("LAY-13",),
       oracle="""
SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'cold' ELSE 'hot' END AS part, 2 * count(*) AS n,
       CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 2 ELSE 0 END AS runs
FROM orders GROUP BY 1, 3""")
def lay13_equal(spark, sf):
    """Two archive runs; between them every order arrives once more."""
    hot, cold = scratch_path(spark, "lay13e-hot"), scratch_path(spark, "lay13e-cold")
    o = D.table(spark, sf, "orders")
    o.write.parquet(hot)
    for again in (True, False):
        LY.archive_split(spark.read.parquet(hot), "o_orderdate", "1997-01-01 00:00:00", hot, cold)
        if again:
            L.append(o, hot)
    parts = spark.read.parquet(cold).agg(F.lit("cold").alias("part"), F.count(F.lit(1)).alias("n"),
                                         F.count_distinct(LY.ARCHIVE_RUN).cast("int").alias("runs"))
    return parts.unionByName(spark.read.parquet(hot).agg(
        F.lit("hot").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(0).alias("runs")))


# ---------------------------------------------------------------- comparison
@query("set05_digest_compare", ids=("SET-05", "JON-20", "LOAD-11"),
       oracle=f"""
SELECT c_custkey, c_acctbal, c_mktsegment, sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows
FROM (SELECT *, 1 AS l, 0 AS r FROM ({_SNAP_OLD}) UNION ALL SELECT *, 0, 1 FROM ({_SNAP_NEW}))
GROUP BY 1, 2, 3 HAVING sum(l) <> sum(r)""")
def set05_digests(spark, sf):
    """Rows in which two versions of the customers differ, found through digests."""
    return DG.compare_tables(*snapshots(spark, sf))


@query("set05_digest_withdrawn", ids=("SET-05",),
       oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, 2 AS left_rows, 1 AS right_rows
FROM (SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
WHERE l_orderkey % 1000 = 7 AND n = 1""")
def set05_withdrawn(spark, sf):
    """Every line item twice against a copy from which some orders' second rows are
    gone: few buckets differ, and multiplicity decides."""
    li = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    once = li.groupBy(*li.columns).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
    copies = F.explode(F.sequence(F.lit(1), F.lit(2)))
    left = once.select("*", copies.alias("copy"))
    right = left.filter((F.col("l_orderkey") % 1000 != 7) | (F.col("copy") == 1))
    return DG.compare_tables(left.drop("copy"), right.drop("copy")).withColumns(
        {c: F.col(c).cast("int") for c in ("left_rows", "right_rows")})


# ---------------------------------------------------------------- raw JSON
@query("src15_variant_silver", ids=("SRC-15", "SCL-20", "PRJ-11"),
       oracle="""
SELECT event_type,
       CASE event_id % 10 WHEN 3 THEN 'dead' WHEN 5 THEN 'unfit' WHEN 7 THEN 'unfit' WHEN 6 THEN 'absent'
            ELSE 'read' END AS status,
       count(*) AS n,
       sum(CASE WHEN event_id % 10 NOT IN (3, 5, 6, 7) THEN CAST(json_extract(props, '$.k') AS BIGINT) END)::BIGINT AS total
FROM events WHERE props IS NOT NULL GROUP BY 1, 2""")
def src15_variant(spark, sf):
    """The events' records landed as VARIANT and read back typed.  By event id some
    are cut off (3), have their number as text (4), a word (5), nothing (6) or an
    object (7) in its place."""
    e = D.table(spark, sf, "events").filter("props IS NOT NULL")
    k, turn = F.get_json_object("props", "$.k"), F.col("event_id") % 10
    text = (F.when(turn == 3, F.concat(F.lit('{"k": '), k))
            .when(turn == 4, F.concat(F.lit('{"k": "'), k, F.lit('"}')))
            .when(turn == 5, F.lit('{"k": "many"}')).when(turn == 6, F.lit('{"other": [1, null]}'))
            .when(turn == 7, F.concat(F.lit('{"k": {"deep": '), k, F.lit("}}"))).otherwise(F.col("props")))
    good, dead = V.bronze(e.select("event_type", text.alias("raw")), "raw")
    typed = V.silver(staged(good, "variant-bronze"), {"k": ("$.k", "bigint")})
    status = (F.when(F.size(V.UNFIT) > 0, "unfit").when(F.col("k").isNull(), "absent").otherwise("read"))
    rows = typed.select("event_type", status.alias("status"), "k").unionByName(
        dead.select("event_type", F.lit("dead").alias("status"), F.lit(None).cast("long").alias("k")))
    return rows.groupBy("event_type", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


# ---------------------------------------------------------------- SQL names
def _when(column, names, other):
    return (f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + f" ELSE '{other}' END")


@query("udf02_sql_functions", ids=("UDF-02", "LOAD-17", "SCL-08", "SCL-09"),
       oracle=sql(f"""
SELECT {_when('VendorID', C.VENDOR_NAMES, C.VENDOR_OTHER)} AS vendor,
       {_when('payment_type', C.PAYMENT_DESCRIPTIONS, C.PAYMENT_OTHER)} AS payment,
       date_trunc('month', tpep_pickup_datetime)::TIMESTAMP AS month, count(*) AS trips,
       sum(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) // 60)::BIGINT AS minutes
FROM raw_yellow GROUP BY 1, 2, 3"""))
def udf02_sql(spark, sf):
    """A report in plain SQL over a view and the library's SQL functions; the later
    trips are landed after the view was made."""
    path = scratch_path(spark, "udf02")
    trips = D.raw_yellow(spark, sf)
    later = F.col("tpep_pickup_datetime") >= F.lit("1997-01-01").cast("timestamp_ntz")
    trips.filter(~later).write.parquet(path)
    SN.create_functions(spark)
    SN.create_view(spark, "yellow_landed", path)
    L.append(trips.filter(later), path)
    return spark.sql("""
        SELECT vendor_name(VendorID) AS vendor, payment_description(payment_type) AS payment,
               month_start(tpep_pickup_datetime) AS month, count(*) AS trips,
               sum(minutes_between(tpep_pickup_datetime, tpep_dropoff_datetime)) AS minutes
        FROM yellow_landed GROUP BY 1, 2, 3""")
