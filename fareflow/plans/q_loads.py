"""Load patterns (LOAD-*) and data-quality suites (DQ-*) as queries.

Load patterns are registered through their pure rewrite (``target, source →
new target``); the write-then-swap writers are exercised in tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import columns as C
from fareflow.operators import loads as L
from fareflow.operators import quality as Q
from fareflow.plans import inputs as I
from fareflow.plans import models as M
from fareflow.plans.catalog import query
from fareflow.plans.oracle import REPORT_SQL, sql
from fareflow.plans.q_relational import _SNAP_NEW, _SNAP_OLD, snapshots
from fareflow.session import staged
from fareflow.sources import driver as D

RANGE_START, RANGE_END = "1998-01-01 00:00:00", "1998-02-01 00:00:00"
CUTOFF = "1998-01-01 00:00:00"


@query("load03_upsert", ids=("LOAD-03", "LOAD-05"),
       oracle=f"""
WITH o AS ({_SNAP_OLD}), n AS ({_SNAP_NEW})
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.c_custkey = o.c_custkey)
UNION ALL SELECT * FROM n""")
def load03(spark, sf):
    old, new = snapshots(spark, sf)
    return L.upsert(old, new, ["c_custkey"])


@query("load04_time_interval_replace", ids=("LOAD-04", "LOAD-12", "FLT-04"),
       oracle=sql(f"""
SELECT * FROM rep_all WHERE NOT (trip_date >= DATE '{RANGE_START[:10]}' AND trip_date < DATE '{RANGE_END[:10]}')
UNION ALL
SELECT * FROM rep_yellow WHERE trip_date >= DATE '{RANGE_START[:10]}' AND trip_date < DATE '{RANGE_END[:10]}'""",
       extra_ctes=f"""
rep_all AS ({REPORT_SQL.format(where='')}),
rep_yellow AS ({REPORT_SQL.format(where=f"WHERE taxi_type = 'yellow' AND pickup_datetime >= TIMESTAMP '{RANGE_START}' AND pickup_datetime < TIMESTAMP '{RANGE_END}'")})"""))
def load04(spark, sf):
    """Re-run of one month of the daily report with only yellow trips: the
    month's rows are replaced, so green rows of that month disappear."""
    staging = staged(I.staging_trips(spark, sf), "load04")
    target = M.trips_report(staging, I.ALL_START, I.ALL_END)
    rerun = M.trips_report(staging.filter(F.col("taxi_type") == "yellow"), RANGE_START, RANGE_END)
    return L.replace_interval(target, rerun, "trip_date", RANGE_START, RANGE_END, date_grain=True)


_ROW_ID_SQL = """md5(COALESCE(CAST(VendorID AS VARCHAR), '') || COALESCE(CAST(tpep_pickup_datetime AS VARCHAR), '')
        || COALESCE(CAST(tpep_dropoff_datetime AS VARCHAR), '') || COALESCE(CAST(PULocationID AS VARCHAR), '')
        || COALESCE(CAST(DOLocationID AS VARCHAR), '') || COALESCE(CAST(CAST(fare_amount AS DECIMAL(18,3)) AS VARCHAR), '')
        || COALESCE(CAST(CAST(trip_distance AS DECIMAL(18,3)) AS VARCHAR), ''))"""


def _landed_yellow(spark, sf, filename):
    y = D.raw_yellow(spark, sf)
    rid = C.row_id_text(y, ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                            "PULocationID", "DOLocationID", "fare_amount", "trip_distance"])
    return y.select(rid.alias("unique_row_id"), F.lit(filename).alias("filename"), "*")


@query("load06_insert_only_merge", ids=("LOAD-06", "LOAD-08", "LOAD-13", "JON-18", "SCL-11", "JOB-08"),
       oracle=sql(f"""
SELECT * FROM tgt
UNION ALL
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.unique_row_id = s.unique_row_id)""",
       extra_ctes=f"""
tgt AS (SELECT {_ROW_ID_SQL} AS unique_row_id, 'yellow_tripdata_1997.csv' AS filename, *
        FROM raw_yellow WHERE tpep_pickup_datetime < TIMESTAMP '{CUTOFF}'),
src AS (SELECT {_ROW_ID_SQL} AS unique_row_id, 'yellow_tripdata_all.csv' AS filename, * FROM raw_yellow)"""))
def load06(spark, sf):
    """Staged copy with row id + file name, merged insert-only into a target
    that already holds the earlier trips."""
    source = staged(_landed_yellow(spark, sf, "yellow_tripdata_all.csv"), "load06")
    target = (source.filter(F.col("tpep_pickup_datetime") < F.lit(CUTOFF).cast("timestamp_ntz"))
              .withColumn("filename", F.lit("yellow_tripdata_1997.csv")))
    return L.merged_target(target, source, "unique_row_id")


@query("load09_high_water_mark", ids=("LOAD-09", "AGG-15", "STR-11"),
       oracle=f"""
SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}')""")
def load09(spark, sf):
    o = D.table(spark, sf, "orders")
    loaded = o.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return L.high_water_mark(loaded, o, "o_orderdate")


@query("load11_scd2_snapshot", ids=("LOAD-11", "JON-20"),
       oracle=f"""
WITH h AS (SELECT *, TIMESTAMP '2024-01-01' AS updated_at FROM ({_SNAP_OLD})),
s AS (SELECT *, TIMESTAMP '2024-01-02' AS updated_at FROM ({_SNAP_NEW})),
j AS (SELECT h.c_custkey AS h_key, h.c_acctbal AS h_bal, h.c_mktsegment AS h_seg, h.updated_at AS h_upd,
             s.c_custkey AS s_key, s.c_acctbal AS s_bal, s.c_mktsegment AS s_seg, s.updated_at AS s_upd,
             s.c_custkey IS NOT NULL AND (h.c_custkey IS NULL OR h.c_acctbal IS DISTINCT FROM s.c_acctbal
                                          OR h.c_mktsegment IS DISTINCT FROM s.c_mktsegment) AS changed
      FROM h FULL OUTER JOIN s ON h.c_custkey = s.c_custkey)
SELECT h_key AS c_custkey, h_bal AS c_acctbal, h_seg AS c_mktsegment, h_upd AS updated_at,
       h_upd AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM j WHERE h_key IS NOT NULL AND NOT changed
UNION ALL
SELECT h_key, h_bal, h_seg, h_upd, h_upd, s_upd FROM j WHERE h_key IS NOT NULL AND changed
UNION ALL
SELECT s_key, s_bal, s_seg, s_upd, s_upd, CAST(NULL AS TIMESTAMP) FROM j WHERE changed""")
def load11(spark, sf):
    old, new = snapshots(spark, sf)
    day1 = old.withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    day2 = new.withColumn("updated_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    hist = L.scd2(None, day1, ["c_custkey"], "updated_at", ["c_acctbal", "c_mktsegment"])
    return L.scd2(hist, day2, ["c_custkey"], "updated_at", ["c_acctbal", "c_mktsegment"])


# ---------------------------------------------------------------- data quality
STAGING_CHECKS = [Q.Check("not_null", c) for c in
                  ("pickup_datetime", "dropoff_datetime", "pickup_location_id",
                   "dropoff_location_id", "fare_amount")] + [Q.Check("non_negative", "total_amount")]


def _checks_sql(table: str, checks: list[tuple[str, str, str]]) -> str:
    parts = [f"SELECT '{k}' AS check_name, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures FROM {table}"
             for k, c, cond in checks]
    return ("SELECT check_name, column_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + " UNION ALL ".join(parts) + ")")


@query("dq11_staging_suite", ids=("DQ-11", "DQ-01", "DQ-04", "DQ-07", "JOB-05"),
       oracle=sql(_checks_sql("staging_trips", [
           ("not_null", c, f"{c} IS NULL") for c in
           ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount")]
           + [("non_negative", "total_amount", "total_amount < 0")]) + """
UNION ALL
SELECT 'no_duplicate_trips', NULL, CAST(COUNT(*) - COUNT(DISTINCT (pickup_datetime, dropoff_datetime,
       pickup_location_id, dropoff_location_id, fare_amount)) AS BIGINT) AS failures,
       CASE WHEN COUNT(*) - COUNT(DISTINCT (pickup_datetime, dropoff_datetime, pickup_location_id,
            dropoff_location_id, fare_amount)) = 0 THEN 'PASS' ELSE 'FAIL' END
FROM staging_trips WHERE pickup_datetime >= TIMESTAMP '1990-01-01' AND pickup_datetime < TIMESTAMP '2030-01-01'"""))
def dq11_staging(spark, sf):
    staging = staged(I.staging_trips(spark, sf), "dq11")
    in_window = L.in_range("pickup_datetime", I.ALL_START, I.ALL_END)
    dup = Q.duplicate_count(staging, M.STAGING_KEY, "no_duplicate_trips", in_window)
    return Q.run_checks(staging, STAGING_CHECKS).unionByName(dup)


REPORT_CHECKS = ([Q.Check("not_null", "trip_date"), Q.Check("not_null", "taxi_type")]
                 + [Q.Check("non_negative", c) for c in ("trip_count", "total_passengers", "total_distance",
                                                          "total_fare", "total_tips", "total_revenue")])


@query("dq11_report_suite", ids=("DQ-11", "DQ-01", "DQ-04", "JOB-06"),
       oracle=sql(_checks_sql("rep", [("not_null", "trip_date", "trip_date IS NULL"),
                                      ("not_null", "taxi_type", "taxi_type IS NULL")]
                              + [("non_negative", c, f"{c} < 0") for c in
                                 ("trip_count", "total_passengers", "total_distance", "total_fare",
                                  "total_tips", "total_revenue")]),
                  extra_ctes=f"rep AS ({REPORT_SQL.format(where='')})"))
def dq11_report(spark, sf):
    rep = M.trips_report(I.staging_trips(spark, sf), I.ALL_START, I.ALL_END)
    return Q.run_checks(rep, REPORT_CHECKS)


@query("dq06_player_stats_checks", ids=("DQ-01", "DQ-02", "DQ-03", "DQ-06", "AGG-07"),
       oracle="""
WITH ps AS (SELECT p_type AS name, count(*) AS player_count FROM part GROUP BY 1)
SELECT check_name, column_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 'not_null' AS check_name, 'name' AS column_name, CAST(count(*) FILTER (WHERE name IS NULL) AS BIGINT) AS failures FROM ps
  UNION ALL SELECT 'not_null', 'player_count', CAST(count(*) FILTER (WHERE player_count IS NULL) AS BIGINT) FROM ps
  UNION ALL SELECT 'positive', 'player_count', CAST(count(*) FILTER (WHERE player_count <= 0) AS BIGINT) FROM ps
  UNION ALL SELECT 'unique', 'name', CAST(COALESCE(sum(n), 0) AS BIGINT) FROM
      (SELECT name, count(*) AS n FROM ps WHERE name IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'row_count_gt_one', NULL, CAST(CASE WHEN CAST(count(*) > 1 AS INTEGER) = 1 THEN 0 ELSE 1 END AS BIGINT) FROM ps
)""")
def dq06(spark, sf):
    players = D.table(spark, sf, "part").select(F.col("p_type").alias("name"))
    stats = players.groupBy("name").agg(F.count(F.lit(1)).alias("player_count"))
    stats.createOrReplaceTempView("player_stats")
    res = Q.run_checks(stats, [Q.Check("not_null", "name"), Q.Check("not_null", "player_count"),
                               Q.Check("positive", "player_count"), Q.Check("unique", "name")])
    custom = Q.custom_check(spark, "row_count_gt_one", "SELECT count(*) > 1 FROM player_stats", 1)
    return res.unionByName(custom)


@query("dq05_fact_value_checks", ids=("DQ-05", "DQ-08", "DQ-09"),
       oracle=sql("""
SELECT check_name, column_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 'accepted_values' AS check_name, 'payment_type' AS column_name,
         CAST(count(*) FILTER (WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)) AS BIGINT) AS failures FROM fct_trips
  UNION ALL SELECT 'between', 'passenger_count',
         CAST(count(*) FILTER (WHERE passenger_count < 0 OR passenger_count > 6) AS BIGINT) FROM fct_trips
  UNION ALL SELECT 'row_count_between', NULL,
         CAST(CASE WHEN count(*) BETWEEN 1 AND 1000000000 THEN 0 ELSE 1 END AS BIGINT) FROM fct_trips)"""))
def dq05(spark, sf):
    fct = I.fct_trips(spark, sf)
    return Q.run_checks(fct, [Q.Check("accepted_values", "payment_type", values=(1, 2, 3, 4, 5, 6)),
                              Q.Check("between", "passenger_count", low=0, high=6)],
                        extra=[Q.row_count_check(1, 1_000_000_000)])


@query("dq10_dead_letter", ids=("DQ-10",),
       oracle=sql("""
SELECT reject_reason, count(*) AS n FROM (
  SELECT CASE WHEN NOT COALESCE(vendor_id IS NOT NULL, FALSE) THEN 'vendor_missing'
              WHEN NOT COALESCE(airport_fee IS NOT NULL, FALSE) THEN 'airport_fee_missing'
              WHEN NOT COALESCE(tip_amount <= fare_amount * 0.1, FALSE) THEN 'tip_over_10pct' END AS reject_reason
  FROM ingestion_trips) WHERE reject_reason IS NOT NULL GROUP BY 1"""))
def dq10(spark, sf):
    t = I.ingestion_trips(spark, sf)
    _, bad = Q.dead_letter_split(t, [
        ("vendor_missing", F.col("vendor_id").isNotNull()),
        ("airport_fee_missing", F.col("airport_fee").isNotNull()),
        ("tip_over_10pct", F.col("tip_amount") <= F.col("fare_amount") * 0.1)])
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
