"""Relational operators (PRJ, FLT, JON, AGG, WIN, SRT, SET, SCL) as queries.

Each query applies one operator family to frames Spark derives from the
driver's tables, over the whole tables.  The oracle is the same computation
in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import columns as C
from fareflow.operators import aggregates as A
from fareflow.operators import joins as J
from fareflow.operators import loads as L
from fareflow.operators import projection as P
from fareflow.operators import windows as W
from fareflow.plans import inputs as I
from fareflow.plans import models as M
from fareflow.plans.catalog import query
from fareflow.plans.oracle import avg_sql, ratio_sql, sql
from fareflow.session import scratch_path, staged
from fareflow.sources import driver as D

MONTH_START, MONTH_END = "1998-11-01 00:00:00", "1998-12-01 00:00:00"
DAY = "1998-11-18"
TOP_ZONE = "NATION_7"


def _green_nb(spark, sf):
    return P.rename(D.raw_green(spark, sf), {"lpep_pickup_datetime": "pickup_datetime",
                                             "lpep_dropoff_datetime": "dropoff_datetime"})


# ---------------------------------------------------------------- projections
@query("prj01_fhvhv_select_filter", ids=("PRJ-01", "FLT-01"),
       oracle=sql("""
SELECT (l_shipdate + to_hours(CAST(l_linenumber AS BIGINT))) AS pickup_datetime,
       (l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) + to_minutes(CAST(CAST(l_quantity AS INTEGER) AS BIGINT))) AS dropoff_datetime,
       CAST(s_nationkey AS INTEGER) AS PULocationID, CAST(c_nationkey AS INTEGER) AS DOLocationID
FROM trip_lines WHERE 'HV000' || CAST(l_suppkey % 5 + 2 AS VARCHAR) = 'HV0003'"""))
def prj01(spark, sf):
    df = D.fhvhv_raw(spark, sf)
    return df.select("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID") \
             .filter(df.hvfhs_license_num == "HV0003")


@query("prj12_drop_columns", ids=("PRJ-12", "PRJ-07", "PRJ-13"),
       oracle=sql("""
SELECT * EXCLUDE (ehail_fee, trip_type), fare_amount * 2 AS fare_doubled
FROM raw_green"""))
def prj12(spark, sf):
    df = P.drop_columns(D.raw_green(spark, sf), ["ehail_fee", "trip_type"])
    return P.star_plus(df, {"fare_doubled": F.col("fare_amount") * 2})


@query("prj11_products_default", ids=("PRJ-11", "SCL-20"),
       oracle="""
SELECT COALESCE(CASE WHEN p_size > 45 THEN NULL ELSE p_brand END, 'N/A') AS brand,
       COALESCE(CAST(p_retailprice AS VARCHAR), 'N/A') AS price,
       'N/A' AS rating
FROM part""")
def prj11(spark, sf):
    products = D.table(spark, sf, "part").select(
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_retailprice").alias("price"))
    return P.project_with_default(products, ["brand", "price", "rating"])


# ---------------------------------------------------------------- filters
@query("flt06_month_short_trip_counts", ids=("FLT-06", "FLT-04", "FLT-08", "AGG-09"),
       oracle=sql(f"""
SELECT count(VendorID) AS VendorID, count(pickup_datetime) AS pickup_datetime,
       count(dropoff_datetime) AS dropoff_datetime, count(store_and_fwd_flag) AS store_and_fwd_flag,
       count(RatecodeID) AS RatecodeID, count(PULocationID) AS PULocationID,
       count(DOLocationID) AS DOLocationID, count(passenger_count) AS passenger_count,
       count(trip_distance) AS trip_distance, count(fare_amount) AS fare_amount,
       count(extra) AS extra, count(mta_tax) AS mta_tax, count(tip_amount) AS tip_amount,
       count(tolls_amount) AS tolls_amount, count(ehail_fee) AS ehail_fee,
       count(improvement_surcharge) AS improvement_surcharge, count(total_amount) AS total_amount,
       count(payment_type) AS payment_type, count(trip_type) AS trip_type,
       count(congestion_surcharge) AS congestion_surcharge
FROM nb_green
WHERE pickup_datetime >= TIMESTAMP '{MONTH_START}' AND pickup_datetime < TIMESTAMP '{MONTH_END}'
  AND trip_distance <= 10"""))
def flt06(spark, sf):
    g = _green_nb(spark, sf)
    f = g.filter(P.ts_range("pickup_datetime", MONTH_START, MONTH_END)).filter(F.col("trip_distance") <= 10)
    return A.non_null_counts(f)


@query("flt05_distinct_vendor_date_between", ids=("FLT-05", "AGG-12", "SCL-04"),
       oracle=sql("""
SELECT DISTINCT VendorID FROM raw_yellow
WHERE CAST(tpep_dropoff_datetime AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-15'"""))
def flt05(spark, sf):
    y = D.raw_yellow(spark, sf)
    return A.distinct_values(y.filter(P.date_between("tpep_dropoff_datetime", "1998-03-01", "1998-03-15")),
                             "VendorID")


@query("flt07_top_zone_on_day", ids=("FLT-07", "JON-03", "AGG-11", "SRT-03", "SRT-02"),
       oracle=sql(f"""
SELECT z.zone AS Zone, round(sum(g.total_amount), 2) AS total_amount
FROM nb_green g LEFT JOIN zones z ON g.PULocationID = z.locationid
WHERE CAST(g.pickup_datetime AS DATE) = DATE '{DAY}'
GROUP BY z.zone ORDER BY total_amount DESC NULLS LAST, Zone ASC NULLS LAST LIMIT 1"""))
def flt07(spark, sf):
    g = _green_nb(spark, sf).filter(P.on_day("pickup_datetime", DAY))
    z = D.zones(spark, sf).select(F.col("locationid"), F.col("zone").alias("Zone"))
    j = J.lookup_join(g, z, "PULocationID", "locationid")
    agg = j.groupBy("Zone").agg(F.round(F.sum("total_amount"), 2).alias("total_amount"))
    return A.top_n(agg, 1, F.col("total_amount").desc_nulls_last(), F.col("Zone").asc_nulls_last())


@query("jon04_top_tip_dropoff_zone", ids=("JON-04", "FLT-11", "SRT-03"),
       oracle=sql(f"""
SELECT g.tip_amount, d.zone AS DOZone
FROM nb_green g
LEFT JOIN zones p ON g.PULocationID = p.locationid
LEFT JOIN zones d ON g.DOLocationID = d.locationid
WHERE g.pickup_datetime >= TIMESTAMP '{MONTH_START}' AND g.pickup_datetime < TIMESTAMP '{MONTH_END}'
  AND p.zone = '{TOP_ZONE}'
ORDER BY g.tip_amount DESC NULLS LAST, DOZone ASC NULLS LAST LIMIT 1"""))
def jon04(spark, sf):
    z = D.zones(spark, sf)
    g = _green_nb(spark, sf).filter(P.ts_range("pickup_datetime", MONTH_START, MONTH_END))
    j = J.role_join(g, z, "PULocationID", "locationid", {"zone": "PUZone"})
    j = j.filter(F.col("PUZone") == TOP_ZONE)
    j = J.role_join(j, z, "DOLocationID", "locationid", {"zone": "DOZone"})
    return A.top_n(j.select("tip_amount", "DOZone"), 1,
                   F.col("tip_amount").desc_nulls_last(), F.col("DOZone").asc_nulls_last())


@query("agg10_max_distance_per_day", ids=("AGG-10", "FLT-08", "SRT-01"),
       oracle=sql("""
SELECT CAST(pickup_datetime AS DATE) AS day, max(trip_distance) AS trip_distance
FROM nb_green WHERE trip_distance <= 100 GROUP BY 1 ORDER BY trip_distance"""))
def agg10(spark, sf):
    g = _green_nb(spark, sf).filter(F.col("trip_distance") <= 100)
    return A.max_per_day(g, "pickup_datetime", "trip_distance")


@query("flt09_dropna_any", ids=("FLT-09",),
       oracle=sql("""
SELECT taxi_type, count(*) AS n FROM ingestion_trips
WHERE COLUMNS(*) IS NOT NULL GROUP BY taxi_type"""))
def flt09(spark, sf):
    return A.count_by(P.drop_any_null(I.ingestion_trips(spark, sf)), "taxi_type", name="n")


@query("flt10_chained_not_equal", ids=("FLT-10",),
       oracle=sql("""
SELECT service_type, count(*) AS n FROM notebook_trips
WHERE payment_type <> 3 AND VendorID <> 2 GROUP BY 1"""))
def flt10(spark, sf):
    t = I.notebook_trips(spark, sf)
    return A.count_by(t.filter(F.col("payment_type") != 3).filter(F.col("VendorID") != 2),
                      "service_type", name="n")


# ---------------------------------------------------------------- joins
@query("agg27_zone_counts_duration", ids=("AGG-27", "JON-06", "SCL-05", "SRT-02"),
       oracle=sql(f"""
SELECT z.zone AS zone_name, count(*) AS trip_count,
       {avg_sql("date_sub('minute', t.pickup_datetime, t.dropoff_datetime)")} AS avg_duration_min
FROM notebook_trips t JOIN zones z ON t.PULocationID = z.locationid
GROUP BY z.zone ORDER BY trip_count DESC"""))
def agg27(spark, sf):
    t = I.notebook_trips(spark, sf).withColumn(
        "duration_min", C.minutes_between("pickup_datetime", "dropoff_datetime"))
    z = D.zones(spark, sf).select(F.col("locationid").alias("PULocationID"), F.col("zone").alias("zone_name"))
    j = t.join(z, "PULocationID")
    return (j.groupBy("zone_name")
             .agg(F.count(F.lit(1)).alias("trip_count"), C.exact_avg("duration_min").alias("avg_duration_min"))
             .orderBy(F.col("trip_count").desc()))


@query("jon07_broadcast_hint", ids=("JON-07",),
       oracle=sql("""
SELECT z.borough, round(sum(t.fare_amount), 2) AS fare
FROM notebook_trips t JOIN zones z ON t.PULocationID = z.locationid GROUP BY 1"""))
def jon07(spark, sf):
    t = I.notebook_trips(spark, sf)
    z = D.zones(spark, sf).select(F.col("locationid").alias("PULocationID"), "borough")
    j = J.hinted_join(t, z, "PULocationID", strategy="broadcast")
    return j.groupBy("borough").agg(F.round(F.sum("fare_amount"), 2).alias("fare"))


_SEGMENT_SQL = """
SELECT c.c_mktsegment, count(*) AS orders, round(sum(o.o_totalprice), 2) AS total_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1"""


def _segment(spark, sf, strategy):
    o = D.table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = J.hinted_join(o, c, "o_custkey", strategy=strategy)
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"),
                                         F.round(F.sum("o_totalprice"), 2).alias("total_price"))


@query("jon08_merge_hint", ids=("JON-08",), oracle=_SEGMENT_SQL)
def jon08(spark, sf):
    return _segment(spark, sf, "merge")


@query("jon09_shuffle_hash_hint", ids=("JON-09",), oracle=_SEGMENT_SQL)
def jon09(spark, sf):
    return _segment(spark, sf, "shuffle_hash")


@query("jon15_copartitioned_join", ids=("JON-15", "LAY-02"),
       oracle="""
SELECT o.o_orderstatus, count(*) AS lines, round(sum(l.l_extendedprice), 2) AS gross
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def jon15(spark, sf):
    li = D.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice")
    o = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    j = J.copartitioned_join(li, o, "orderkey")
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("lines"),
                                          F.round(F.sum("l_extendedprice"), 2).alias("gross"))


@query("jon10_range_join_events", ids=("JON-10",),
       oracle="""
SELECT r.event_id AS range_id, count(*) AS events_in_range
FROM events e JOIN (SELECT event_id, ts AS range_start, ts + INTERVAL 1 HOUR AS range_end
                    FROM events WHERE event_type = 'signup') r
  ON e.ts >= r.range_start AND e.ts < r.range_end
GROUP BY 1""")
def jon10(spark, sf):
    ev = D.table(spark, sf, "events")
    ranges = ev.filter(F.col("event_type") == "signup").select(
        F.col("event_id").alias("range_id"), F.col("ts").alias("range_start"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("range_end"))
    j = J.range_join(ev.select("event_id", "ts"), ranges, "ts", "range_start", "range_end",
                     bucket_seconds=3600)
    return j.groupBy("range_id").agg(F.count(F.lit(1)).alias("events_in_range"))


@query("jon10_range_join_bucketed", ids=("JON-10",),
       oracle="""
SELECT r.event_id AS range_id, count(*) AS events_in_range
FROM events e JOIN (SELECT event_id, ts AS range_start, ts + INTERVAL 1 HOUR AS range_end
                    FROM events WHERE event_type = 'signup') r
  ON e.ts >= r.range_start AND e.ts < r.range_end
GROUP BY 1""")
def jon10b(spark, sf):
    """Same as above with narrower buckets: each range covers several."""
    ev = D.table(spark, sf, "events")
    ranges = ev.filter(F.col("event_type") == "signup").select(
        F.col("event_id").alias("range_id"), F.col("ts").alias("range_start"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("range_end"))
    j = J.range_join(ev.select("event_id", "ts"), ranges, "ts", "range_start", "range_end",
                     bucket_seconds=600)
    return j.groupBy("range_id").agg(F.count(F.lit(1)).alias("events_in_range"))


@query("jon10_range_join_scales", ids=("JON-10",),
       oracle="""
WITH r AS (SELECT day, min(ts) AS range_start,
             min(ts) + to_seconds(CAST(pow(4, epoch(day) // 86400 % 14) AS BIGINT)) AS range_end
           FROM (SELECT CAST(ts AS DATE) AS day, ts FROM events WHERE event_type = 'signup') GROUP BY day)
SELECT day AS range_day, count(*) AS events_in_range, sum(e.event_id)::BIGINT AS event_ids
FROM events e JOIN r ON e.ts >= r.range_start AND e.ts < r.range_end GROUP BY 1""")
def jon10c(spark, sf):
    """Each day's first signup opens a range of one second up to two years."""
    ev = D.table(spark, sf, "events")
    day = F.col("ts").cast("date")
    ranges = (ev.filter(F.col("event_type") == "signup").groupBy(day.alias("range_day"))
              .agg(F.min("ts").alias("range_start"))
              .withColumn("range_end", F.col("range_start") + F.make_dt_interval(
                  secs=F.pow(F.lit(4), F.unix_date("range_day") % 14).cast("decimal(18,6)"))))
    j = J.multiscale_range_join(ev.select("event_id", "ts"), ranges, "ts", "range_start", "range_end")
    return j.groupBy("range_day").agg(F.count(F.lit(1)).alias("events_in_range"),
                                      F.sum("event_id").cast("bigint").alias("event_ids"))


_BOROUGH_SQL = sql("""
SELECT z.borough, count(*) AS trips, round(sum(t.total_amount), 2) AS total
FROM notebook_trips t JOIN zones z ON t.PULocationID = z.locationid GROUP BY 1""")


def _borough_totals(j):
    return j.groupBy("borough").agg(F.count(F.lit(1)).alias("trips"),
                                    F.round(F.sum("total_amount"), 2).alias("total"))


@query("jon12_salted_join", ids=("JON-12", "SCL-15", "SRC-17"), oracle=_BOROUGH_SQL)
def jon12(spark, sf):
    t = I.notebook_trips(spark, sf)
    z = D.zones(spark, sf).select(F.col("locationid").alias("PULocationID"), "borough")
    j = J.salted_join(t, z, "PULocationID", 8, ["pickup_datetime", "dropoff_datetime", "fare_amount"])
    return _borough_totals(j)


@query("jon13_hot_key_split", ids=("JON-13",), oracle=_BOROUGH_SQL)
def jon13(spark, sf):
    t = I.notebook_trips(spark, sf)
    z = D.zones(spark, sf).select(F.col("locationid").alias("PULocationID"), "borough")
    hot = J.hot_keys(t, "PULocationID", 0.04)
    return _borough_totals(J.split_hot_join(
        t, z, "PULocationID", hot, salt_from=["pickup_datetime", "dropoff_datetime", "fare_amount"]))


@query("jon16_filter_then_join", ids=("JON-16",),
       oracle=sql("""
SELECT z.zone, count(*) AS trips FROM notebook_trips t JOIN zones z ON t.PULocationID = z.locationid
WHERE t.service_type = 'green' AND t.payment_type = 1 GROUP BY 1"""))
def jon16(spark, sf):
    t = I.notebook_trips(spark, sf)
    z = D.zones(spark, sf).select(F.col("locationid").alias("PULocationID"), "zone")
    j = J.filter_then_join(t, z,
                           (F.col("service_type") == "green") & (F.col("payment_type") == 1),
                           "PULocationID")
    return A.count_by(j, "zone", name="trips")


@query("jon17_aggregate_then_join", ids=("JON-17",),
       oracle=sql("""
SELECT c.PULocationID, c.trip_count, z.zone FROM
  (SELECT PULocationID, count(*) AS trip_count FROM notebook_trips GROUP BY 1) c
  LEFT JOIN zones z ON c.PULocationID = z.locationid"""))
def jon17(spark, sf):
    t = I.notebook_trips(spark, sf)
    z = D.zones(spark, sf).select(F.col("locationid").alias("PULocationID"), "zone")
    return J.aggregate_then_join(t, z, "PULocationID")


@query("jon18_customers_without_orders", ids=("JON-18",),
       oracle="""
SELECT c_mktsegment, count(*) AS customers FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderdate >= TIMESTAMP '1998-01-01' AND o.o_orderdate < TIMESTAMP '1999-01-01')
GROUP BY 1""")
def jon18(spark, sf):
    c = D.table(spark, sf, "customer")
    o = (D.table(spark, sf, "orders")
         .filter(P.ts_range("o_orderdate", "1998-01-01 00:00:00", "1999-01-01 00:00:00"))
         .select(F.col("o_custkey").alias("c_custkey")))
    return A.count_by(c.join(o, "c_custkey", "left_anti"), "c_mktsegment", name="customers")


_SNAP_OLD = """SELECT c_custkey, c_acctbal, c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate < TIMESTAMP '1997-01-01')"""
_SNAP_NEW = """SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment FROM customer WHERE c_acctbal >= 0"""


def snapshots(spark, sf):
    """Two versions of the customer table, by content (not by id):

    * day 1 — customers known then: those with an order before 1997;
    * day 2 — every customer in good standing (negative-balance accounts
      are closed, i.e. removed), with a balance credit for the AUTOMOBILE
      segment (changed rows); customers whose first order came later are
      new.
    """
    c = D.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    early = (D.table(spark, sf, "orders")
             .filter(F.col("o_orderdate") < F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))
             .select(F.col("o_custkey").alias("c_custkey")))
    old = c.join(early, "c_custkey", "left_semi")
    new = c.filter(F.col("c_acctbal") >= 0).withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.col("c_acctbal") + 100)
                      .otherwise(F.col("c_acctbal")))
    return old, new


@query("jon20_snapshot_diff", ids=("JON-20",),
       oracle=f"""
SELECT change, count(*) AS n FROM (
  SELECT CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed'
              WHEN o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
              THEN 'changed' ELSE 'same' END AS change
  FROM ({_SNAP_OLD}) o FULL OUTER JOIN ({_SNAP_NEW}) n ON o.c_custkey = n.c_custkey)
GROUP BY 1""")
def jon20(spark, sf):
    old, new = snapshots(spark, sf)
    d = J.full_compare(old, new, ["c_custkey"], ["c_acctbal", "c_mktsegment"])
    return A.count_by(d, "change", name="n")


# ---------------------------------------------------------------- aggregates
@query("agg02_counts", ids=("AGG-02",),
       oracle=sql("""
SELECT count(*) AS n_all, count(*) FILTER (WHERE fare_amount = 0) AS n_zero_fare,
       count(*) FILTER (WHERE payment_type = 3) AS n_no_charge FROM raw_yellow"""))
def agg02(spark, sf):
    y = D.raw_yellow(spark, sf)
    return y.agg(F.count(F.lit(1)).alias("n_all"),
                 F.count_if(F.col("fare_amount") == 0).alias("n_zero_fare"),
                 F.count_if(F.col("payment_type") == 3).alias("n_no_charge"))


@query("agg06_department_stats", ids=("AGG-06", "SRT-01", "SCL-10"),
       oracle=f"""
SELECT c_mktsegment AS department, count(*) AS count,
       {avg_sql("(c_custkey % 40 + 20)", 1)} AS avg_age, max(c_custkey % 40 + 20) AS max_age
FROM customer GROUP BY 1 ORDER BY 1""")
def agg06(spark, sf):
    return A.group_stats(D.customers_as_employees(spark, sf), "department", "age")


@query("agg07_count_by_name", ids=("AGG-07",),
       oracle="SELECT p_type AS name, count(*) AS player_count FROM part GROUP BY 1")
def agg07(spark, sf):
    players = D.table(spark, sf, "part").select(F.col("p_type").alias("name"))
    return A.count_by(players, "name", name="player_count")


@query("job11_brand_avg_price", ids=("JOB-11", "AGG-08", "PRJ-11", "SRT-02"),
       oracle=f"""
SELECT brand, {avg_sql("price", 2)} AS avg_price FROM (
  SELECT COALESCE(CASE WHEN p_size > 45 THEN NULL ELSE p_brand END, 'N/A') AS brand,
         p_retailprice AS price FROM part)
GROUP BY brand ORDER BY avg_price DESC""")
def job11(spark, sf):
    products = D.table(spark, sf, "part").select(
        F.coalesce(F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")),
                   F.lit("N/A")).alias("brand"),
        F.col("p_retailprice").alias("price"))
    return A.avg_rounded_desc(products, "brand", "price")


GOLD_SQL = sql(f"""
SELECT CAST(t.pickup_datetime AS DATE) AS trip_date, z.zone AS pickup_zone, count(*) AS total_trips,
       {avg_sql("date_sub('minute', t.pickup_datetime, t.dropoff_datetime)")} AS avg_duration_min,
       count(DISTINCT t.dispatching_base_num) AS unique_bases
FROM (SELECT 'B' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS dispatching_base_num,
             (l_shipdate + to_hours(CAST(l_linenumber AS BIGINT))) AS pickup_datetime,
             (l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) + to_minutes(CAST(CAST(l_quantity AS INTEGER) AS BIGINT))) AS dropoff_datetime,
             CAST(s_nationkey AS INTEGER) AS pickup_location_id
      FROM trip_lines) t
JOIN dim_zones z ON t.pickup_location_id = z.location_id
GROUP BY 1, 2""")


@query("agg13_gold_daily_summary", ids=("AGG-13", "AGG-22", "JOB-12", "LOAD-15", "SCL-05"),
       oracle=GOLD_SQL)
def agg13(spark, sf):
    from fareflow.plans.medallion import gold_daily_summary, silver_trips
    return gold_daily_summary(silver_trips(D.fhvhv_raw(spark, sf)), D.zones(spark, sf))


@query("agg14_distinct_tuple_count", ids=("AGG-14", "DQ-07"),
       oracle=sql("""
SELECT COUNT(*) - COUNT(DISTINCT (pickup_datetime, dropoff_datetime, pickup_location_id,
                                  dropoff_location_id, fare_amount)) AS duplicates
FROM ingestion_trips"""))
def agg14(spark, sf):
    t = I.ingestion_trips(spark, sf)
    return t.agg((F.count(F.lit(1)) - A.distinct_tuple_count(t, [
        "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
        "fare_amount"])).alias("duplicates"))


def label_centroids(emb):
    """Mean embedding per label (one value per label and dimension is gathered)."""
    dims = F.posexplode("embedding").alias("i", "v")
    return (emb.select("label", dims)
               .groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
               .groupBy("label")
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))),
                                lambda s: s["m"]).alias("qv")))


TOPK_SQL = """
WITH q AS (
  SELECT label AS query_id, list(avg_v ORDER BY i) AS qv FROM (
    SELECT label, i, avg(CAST(v AS DOUBLE)) AS avg_v FROM (
      SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label),
s AS (
  SELECT q.query_id, e.vec_id AS doc_id,
         round(list_dot_product(q.qv, CAST(e.embedding AS DOUBLE[]))
               / (sqrt(list_dot_product(q.qv, q.qv))
                  * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))), 12) AS score
  FROM embeddings e, q)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS rank FROM s)
WHERE rank <= 5"""


@query("agg16_topk_cosine", ids=("AGG-16", "JOB-13"),
       oracle=TOPK_SQL)
def agg16(spark, sf):
    """Top-5 vectors nearest to each label's centroid (the query set is the
    per-label mean embedding, derived by aggregation over the whole table)."""
    emb = D.table(spark, sf, "embeddings")
    return A.top_k_similar(emb, label_centroids(emb), 5, "vec_id", "embedding", "label", "qv")


@query("agg17_salted_two_phase_sum", ids=("AGG-17", "SCL-15"),
       oracle="SELECT c_mktsegment, round(sum(c_acctbal), 2) AS sum_c_acctbal FROM customer GROUP BY 1")
def agg17(spark, sf):
    c = D.table(spark, sf, "customer")
    s = A.salted_sum(c, "c_mktsegment", "c_acctbal", 16, ["c_custkey"])
    return s.select("c_mktsegment", F.round("sum_c_acctbal", 2).alias("sum_c_acctbal"))


@query("agg18_rebalanced_sum", ids=("AGG-18", "LAY-01"),
       oracle="SELECT c_mktsegment, round(sum(c_acctbal), 2) AS sum_c_acctbal FROM customer GROUP BY 1")
def agg18(spark, sf):
    c = D.table(spark, sf, "customer")
    s = A.rebalanced_sum(c, "c_mktsegment", "c_acctbal")
    return s.select("c_mktsegment", F.round("sum_c_acctbal", 2).alias("sum_c_acctbal"))


@query("agg19_by_hour", ids=("AGG-19", "SCL-06"),
       oracle=sql(f"""
SELECT hour(pickup_datetime) AS hour, count(*) AS trip_count,
       {avg_sql("trip_distance")} AS avg_trip_distance
FROM notebook_trips GROUP BY 1 ORDER BY 1"""))
def agg19(spark, sf):
    t = I.notebook_trips(spark, sf)
    return (t.groupBy(C.hour_of("pickup_datetime").cast("bigint").alias("hour"))
             .agg(F.count(F.lit(1)).alias("trip_count"),
                  C.exact_avg("trip_distance").alias("avg_trip_distance"))
             .orderBy("hour"))


@query("agg20_sql_form", ids=("AGG-20", "LOAD-17"),
       oracle=sql(f"""
SELECT PULocationID, {avg_sql("tip_amount")} AS avg_tip
FROM notebook_trips WHERE fare_amount > 50000 GROUP BY 1 ORDER BY avg_tip DESC"""))
def agg20(spark, sf):
    """Same computation via a temp view and SQL text (DataFrame form in tests)."""
    I.notebook_trips(spark, sf).createOrReplaceTempView("trips_data")
    return spark.sql("""
        SELECT PULocationID,
               CAST(round(try_divide(sum(CAST(tip_amount AS DECIMAL(38,2))), count(tip_amount)), 4) AS DOUBLE) AS avg_tip
        FROM trips_data WHERE fare_amount > 50000 GROUP BY PULocationID ORDER BY avg_tip DESC""")


@query("agg21_count_sum_by_key", ids=("AGG-21",),
       oracle="SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1")
def agg21(spark, sf):
    li = D.table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                          F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("agg22_daily_summary", ids=("AGG-22", "SCL-02"),
       oracle=sql(f"""
SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS total_trips,
       {avg_sql("date_sub('minute', pickup_datetime, dropoff_datetime)")} AS avg_duration_min
FROM notebook_trips GROUP BY 1"""))
def agg22(spark, sf):
    t = I.notebook_trips(spark, sf)
    return (t.groupBy(C.day_of("pickup_datetime").alias("trip_date"))
             .agg(F.count(F.lit(1)).alias("total_trips"),
                  C.exact_avg(C.minutes_between("pickup_datetime", "dropoff_datetime"))
                   .alias("avg_duration_min")))


@query("agg23_p99_error_rate", ids=("AGG-23", "AGG-24"),
       oracle=f"""
SELECT event_type, round(quantile_cont(value, 0.99), 6) AS p99_value, count(*) AS n
FROM events GROUP BY 1""")
def agg23(spark, sf):
    ev = D.table(spark, sf, "events")
    p99 = A.exact_percentile(ev, "event_type", "value", 0.99, "p99_value")
    n = A.count_by(ev, "event_type", name="n")
    return n.join(p99, "event_type").select("event_type", F.round("p99_value", 6).alias("p99_value"), "n")


@query("agg24_error_rate_by_day", ids=("AGG-24",),
       oracle=f"""
SELECT CAST(ts AS DATE) AS day,
       {ratio_sql("count(*) FILTER (WHERE event_type = 'error')", "count(*)")} AS error_rate
FROM events GROUP BY 1""")
def agg24(spark, sf):
    ev = D.table(spark, sf, "events")
    g = ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count(F.lit(1)).alias("n"))
    return g.select("day", C.exact_ratio("errors", "n").alias("error_rate"))


@query("agg25_replay_state", ids=("AGG-25",),
       oracle="""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS current_event_type,
       count(*) AS event_count, max(event_id) AS last_event_id
FROM events GROUP BY 1""")
def agg25(spark, sf):
    ev = D.table(spark, sf, "events")
    return ev.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("current_event_type"),
        F.count(F.lit(1)).alias("event_count"),
        F.max("event_id").alias("last_event_id"))


@query("agg28_weekly_retention", ids=("AGG-28",),
       oracle="""
WITH w AS (SELECT user_id, date_trunc('week', ts) AS wk FROM events),
f AS (SELECT user_id, min(wk) AS cohort FROM w GROUP BY 1)
SELECT CAST(f.cohort AS DATE) AS cohort_week,
       CAST(date_diff('day', f.cohort, w.wk) / 7 AS INTEGER) AS week_offset,
       count(DISTINCT w.user_id) AS users
FROM w JOIN f USING (user_id) GROUP BY 1, 2""")
def agg28(spark, sf):
    from fareflow.plans.metrics import weekly_retention
    return weekly_retention(D.table(spark, sf, "events"), "user_id", "ts")


# ---------------------------------------------------------------- windows
@query("win04_latest_per_user", ids=("WIN-04",),
       oracle="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
        event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS rn FROM events)
WHERE rn = 1""")
def win04(spark, sf):
    ev = D.table(spark, sf, "events")
    return W.keep_first(ev, ["user_id"], ["ts"], descending=True)


@query("win05_duplicate_audit", ids=("WIN-05",),
       oracle=sql("""
SELECT vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
       trip_distance, count(*) AS dup_count
FROM int_trips_unioned GROUP BY ALL HAVING count(*) > 1"""))
def win05(spark, sf):
    from fareflow.plans.models import FCT_KEY
    return W.duplicate_groups(I.unioned(spark, sf), FCT_KEY)


@query("win06_moving_average", ids=("WIN-06",),
       oracle="""
SELECT event_id, user_id, ts, round(avg(value) OVER (
    PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM events""")
def win06(spark, sf):
    ev = D.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = W.moving_average(ev, "user_id", "ts", "value", 300)
    return out.select("event_id", "user_id", "ts", F.round("moving_avg", 6).alias("moving_avg"))


# ---------------------------------------------------------------- sort / limit
@query("srt04_first_rows", ids=("SRT-04", "SNK-12"),
       oracle="SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def srt04(spark, sf):
    return A.top_n(D.table(spark, sf, "orders"), 5, F.col("o_orderkey").asc())


@query("srt05_empty_frame", ids=("SRT-05", "LOAD-07"),
       oracle="SELECT * FROM orders")
def srt05(spark, sf):
    """LOAD-07 end to end: an empty table of the first chunk's schema, every
    chunk appended, the table read back."""
    path = scratch_path(spark, "srt05")
    o = D.table(spark, sf, "orders")
    L.write_swap(A.empty_like(o), path)
    done = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    L.replace_then_append(spark, [o.filter(done), o.filter(~done)], path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- sets
@query("set04_union_segments", ids=("SET-04",),
       oracle="""
SELECT c_mktsegment, count(*) AS n FROM (
  SELECT * FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT * FROM customer WHERE c_acctbal >= 0 OR c_acctbal IS NULL)
GROUP BY 1""")
def set04(spark, sf):
    c = D.table(spark, sf, "customer")
    debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    u = A.union_all(c.filter(debt), c.filter(~debt))
    return A.count_by(u, "c_mktsegment", name="n")


@query("set05_reconciliation", ids=("SET-05",),
       oracle=sql("""
SELECT side, count(*) AS n FROM (SELECT 'left_only' AS side FROM rec_l UNION ALL SELECT 'right_only' FROM rec_r)
GROUP BY 1""", extra_ctes="""
rec_a AS (SELECT vendor_id, pickup_datetime, pickup_location_id, service_type FROM fct_trips),
rec_b AS (SELECT vendor_id, pickup_datetime, pickup_location_id, service_type FROM int_trips_unioned),
rec_l AS (SELECT * FROM rec_a EXCEPT ALL SELECT * FROM rec_b),
rec_r AS (SELECT * FROM rec_b EXCEPT ALL SELECT * FROM rec_a)"""))
def set05(spark, sf):
    cols = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]
    u = staged(I.unioned(spark, sf), "set05")
    a = M.fct_trips(u, D.zones(spark, sf)).select(*cols)
    b = u.select(*cols)
    return A.count_by(A.only_in_each(a, b), "side", name="n")


# ---------------------------------------------------------------- scalar functions
@query("scl11_row_id_text", ids=("SCL-11", "SCL-01"),
       oracle=sql("""
SELECT md5(COALESCE(CAST(VendorID AS VARCHAR), '') || COALESCE(CAST(tpep_pickup_datetime AS VARCHAR), '')
        || COALESCE(CAST(tpep_dropoff_datetime AS VARCHAR), '') || COALESCE(CAST(PULocationID AS VARCHAR), '')
        || COALESCE(CAST(DOLocationID AS VARCHAR), '') || COALESCE(CAST(CAST(fare_amount AS DECIMAL(18,3)) AS VARCHAR), '')
        || COALESCE(CAST(CAST(trip_distance AS DECIMAL(18,3)) AS VARCHAR), '')) AS unique_row_id,
       tpep_pickup_datetime, fare_amount
FROM raw_yellow"""))
def scl11(spark, sf):
    y = D.raw_yellow(spark, sf)
    rid = C.row_id_text(y, ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                            "PULocationID", "DOLocationID", "fare_amount", "trip_distance"])
    return y.select(rid.alias("unique_row_id"), "tpep_pickup_datetime", "fare_amount")


@query("scl12_row_id_binary", ids=("SCL-12",),
       oracle=sql("""
SELECT lower(hex(unhex(md5(COALESCE(CAST(VendorID AS VARCHAR), '') || COALESCE(CAST(tpep_pickup_datetime AS VARCHAR), '')
        || COALESCE(CAST(tpep_dropoff_datetime AS VARCHAR), '') || COALESCE(CAST(PULocationID AS VARCHAR), '')
        || COALESCE(CAST(DOLocationID AS VARCHAR), ''))))) AS unique_row_id_hex,
       octet_length(unhex(md5(''))) AS id_bytes,
       'yellow_tripdata' AS filename, *
FROM raw_yellow"""))
def scl12(spark, sf):
    """The 16-byte binary id, rendered as hex for comparison (the binary
    column itself is what a table of the BigQuery form stores)."""
    y = D.raw_yellow(spark, sf)
    rid = C.row_id_binary(y, ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                              "PULocationID", "DOLocationID"])
    out = P.star_plus(y, {"unique_row_id": rid, "filename": F.lit("yellow_tripdata")}, front=True)
    return out.select(F.lower(F.hex("unique_row_id")).alias("unique_row_id_hex"),
                      F.octet_length("unique_row_id").cast("bigint").alias("id_bytes"),
                      *[c for c in out.columns if c != "unique_row_id"])


@query("scl14_concat_split", ids=("SCL-14", "SCL-17"),
       oracle="""
SELECT split_part(p_name, ' ', 1) AS first_word, concat_ws('_', p_brand, CAST(p_size AS VARCHAR)) AS brand_size,
       count(*) AS n FROM part GROUP BY 1, 2""")
def scl14(spark, sf):
    p = D.table(spark, sf, "part")
    return A.count_by(p, C.split_part("p_name", " ", 0).alias("first_word"),
                      C.concat_with("_", "p_brand", F.col("p_size").cast("string")).alias("brand_size"),
                      name="n")


@query("scl18_fillna_map", ids=("SCL-18",),
       oracle=sql("""
SELECT taxi_type, round(sum(COALESCE(airport_fee, 0.0)), 2) AS airport_fee,
       count(*) FILTER (WHERE COALESCE(vendor_id, -1) = -1) AS unknown_vendor
FROM ingestion_trips GROUP BY 1"""))
def scl18(spark, sf):
    t = I.ingestion_trips(spark, sf).fillna({"airport_fee": 0.0, "vendor_id": -1})
    return t.groupBy("taxi_type").agg(F.round(F.sum("airport_fee"), 2).alias("airport_fee"),
                                      F.count_if(F.col("vendor_id") == -1).alias("unknown_vendor"))


@query("scl20_json_field", ids=("SCL-20", "SRC-15"),
       oracle="""
SELECT COALESCE(json_extract_string(props, '$.k'), 'N/A') AS k, count(*) AS n FROM events GROUP BY 1""")
def scl20(spark, sf):
    ev = D.table(spark, sf, "events")
    return A.count_by(ev, C.json_field("props", "k").alias("k"), name="n")


@query("scl21_file_names", ids=("SCL-21",),
       oracle=sql("""
SELECT DISTINCT printf('%s_tripdata_%04d-%02d.csv', service_type, year(pickup_datetime), month(pickup_datetime)) AS file_name
FROM notebook_trips"""))
def scl21(spark, sf):
    t = I.notebook_trips(spark, sf)
    return t.select(C.trip_file_name_col("service_type", "pickup_datetime").alias("file_name")).distinct()


@query("scl02_round_to_int", ids=("SCL-01", "SCL-02"),
       oracle="""
SELECT CAST(l_extendedprice / 1000 AS INTEGER) AS k_price, count(*) AS n FROM lineitem GROUP BY 1""")
def scl02(spark, sf):
    li = D.table(spark, sf, "lineitem")
    return A.count_by(li, C.round_to_int(F.col("l_extendedprice") / 1000).alias("k_price"), name="n")


@query("agg26_run_metrics", ids=("AGG-26", "AGG-23", "AGG-24"),
       oracle=f"""
WITH d AS (
  SELECT CAST(ts AS DATE) AS day, {avg_sql("value", 6)} AS avg_duration,
         round(quantile_cont(value, 0.99), 6) AS p99_duration, count(*) AS rows,
         {ratio_sql("count(*) FILTER (WHERE event_type = 'error')", "count(*)")} AS error_rate
  FROM events GROUP BY 1),
l AS (SELECT *, lag(rows) OVER (ORDER BY day) AS prev FROM d)
SELECT day, avg_duration, p99_duration, rows, error_rate,
       {ratio_sql("rows - prev", "prev")} AS row_drift,
       abs(rows - prev) * 100 > 5 * prev AS drift_alert
FROM l""")
def agg26(spark, sf):
    """Daily run metrics over the event log read as a run log (value =
    duration, error events = failed runs): one row per day, so the
    day-over-day drift window runs on a table whose size is the number of
    days, not the number of events."""
    from fareflow.plans.metrics import run_metrics
    ev = D.table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), F.col("value").alias("duration"), F.lit(1).alias("rows"),
        (F.col("event_type") == "error").alias("failed"))
    m = run_metrics(ev, "day", "duration", "rows", "failed")
    return m.select("day", "avg_duration", F.round("p99_duration", 6).alias("p99_duration"), "rows",
                    "error_rate", "row_drift", "drift_alert")


@query("src14_external_table", ids=("SRC-14", "SRC-05", "AGG-02"),
       oracle="""
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount = 0) AS n_no_discount
FROM lineitem GROUP BY 1""")
def src14(spark, sf):
    """Files queried by name through SQL (an external table over a URI)."""
    from fareflow.sources.files import external_table
    external_table(spark, "ext_lineitem", [f"{sf.rstrip('/')}/lineitem.parquet"])
    return spark.sql("""SELECT l_returnflag, count(*) AS n,
                               count_if(l_discount = 0) AS n_no_discount
                        FROM ext_lineitem GROUP BY l_returnflag""")


@query("lay10_partition_balance", ids=("LAY-10", "LAY-01", "LAY-09"),
       oracle="SELECT count(*) AS total_rows, TRUE AS balanced FROM lineitem")
def lay10(spark, sf):
    """Balance of the line items after a size-based repartition: no partition
    holds more than twice the mean."""
    from fareflow.operators import layout as LY
    li = D.table(spark, sf, "lineitem")
    n = LY.target_partitions(LY.input_bytes(spark, f"{sf.rstrip('/')}/lineitem.parquet"),
                             spark.sparkContext.defaultParallelism)
    return LY.skew_report(li.repartition(n)).select(
        "total_rows", (F.col("skew_ratio") <= 2).alias("balanced"))
