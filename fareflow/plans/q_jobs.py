"""End-to-end jobs of the reference (JOB-*), registered with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import columns as C
from fareflow.plans import inputs as I
from fareflow.plans import models as M
from fareflow.plans.catalog import query
from fareflow.plans.oracle import REPORT_SQL, avg_sql, sql
from fareflow.sources import driver as D

_REV_SUMS = M.REVENUE_SUMS


def _sums_sql(pairs, cast_double=False):
    if cast_double:
        return ",\n".join(f"CAST(round(sum({s}), 2) AS DOUBLE) AS {a}" for s, a in pairs)
    return ",\n".join(f"round(sum({s}), 2) AS {a}" for s, a in pairs)


@query("job01_monthly_revenue_zone_id", ids=("JOB-01", "AGG-03", "SRC-05", "PRJ-02", "PRJ-04",
                                             "PRJ-06", "SET-01", "SCL-03"),
       oracle=sql(f"""
SELECT PULocationID AS revenue_zone,
       CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month,
       service_type,
       {_sums_sql(_REV_SUMS + [("congestion_surcharge", "revenue_monthly_congestion_surcharge")])},
       {avg_sql("passenger_count")} AS avg_monthly_passenger_count,
       {avg_sql("trip_distance")} AS avg_monthly_trip_distance
FROM notebook_trips GROUP BY 1, 2, 3"""))
def job01(spark, sf):
    return M.monthly_revenue_by_zone_id(I.notebook_trips(spark, sf))


@query("job01_trips_by_service", ids=("AGG-01", "JOB-01"),
       oracle=sql("SELECT service_type, count(*) AS count FROM notebook_trips GROUP BY 1"))
def job01_count(spark, sf):
    return I.notebook_trips(spark, sf).groupBy("service_type").count()


@query("job02_fct_trips", ids=("JOB-02", "WIN-01", "SCL-13", "SCL-08", "JON-02", "PRJ-08",
                               "PRJ-09", "FLT-02", "SET-01"),
       oracle=sql("SELECT * FROM fct_trips"))
def job02(spark, sf):
    return I.fct_trips(spark, sf)


@query("job03_monthly_zone_revenue", ids=("JOB-03", "AGG-04"),
       oracle=sql(f"""
SELECT pickup_zone AS revenue_zone,
       CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month,
       service_type,
       {_sums_sql(_REV_SUMS, cast_double=True)},
       count(trip_id) AS total_monthly_trips,
       {avg_sql("passenger_count")} AS avg_monthly_passenger_count,
       {avg_sql("trip_distance")} AS avg_monthly_trip_distance
FROM fct_trips GROUP BY 1, 2, 3"""))
def job03(spark, sf):
    return M.monthly_zone_revenue(I.fct_trips(spark, sf))


@query("job04_dim_vendors", ids=("JOB-04", "AGG-12", "SCL-09", "UDF-02"),
       oracle=sql("""
SELECT vendor_id, CASE WHEN vendor_id = 1 THEN 'Creative Mobile Technologies, LLC'
                       WHEN vendor_id = 2 THEN 'VeriFone Inc.'
                       WHEN vendor_id = 4 THEN 'Unknown Vendor'
                       ELSE 'Unknown' END AS vendor_name
FROM (SELECT DISTINCT vendor_id FROM int_trips_unioned)"""))
def job04(spark, sf):
    return M.dim_vendors(I.unioned(spark, sf))


@query("prj10_dim_zones", ids=("PRJ-10", "SRC-10"),
       oracle=sql("SELECT * FROM dim_zones"))
def prj10(spark, sf):
    return M.dim_zones(D.zones(spark, sf))


@query("job05_staging_trips", ids=("JOB-05", "WIN-02", "FLT-03", "FLT-04", "JON-01", "SET-02",
                                   "PRJ-03", "PRJ-05", "SCL-16", "JOB-07"),
       oracle=sql("SELECT * FROM staging_trips"))
def job05(spark, sf):
    return I.staging_trips(spark, sf)


@query("job06_trips_report", ids=("JOB-06", "AGG-05", "SCL-07"),
       oracle=sql(REPORT_SQL.format(where="")))
def job06(spark, sf):
    return M.trips_report(I.staging_trips(spark, sf), I.ALL_START, I.ALL_END)


@query("job07_ingestion_trips", ids=("JOB-07", "PRJ-03", "PRJ-05", "SET-02", "SCL-16", "LOAD-02"),
       oracle=sql("SELECT * FROM ingestion_trips"))
def job07(spark, sf):
    return I.ingestion_trips_by_file(spark, sf)


@query("job09_int_trips", ids=("JOB-09", "JON-05", "WIN-03", "SCL-13"),
       oracle=sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY vendor_id, pickup_datetime, pickup_location_id, service_type
      ORDER BY dropoff_datetime ASC NULLS FIRST, trip_id ASC NULLS FIRST, ratecode_id ASC NULLS FIRST,
               dropoff_location_id ASC NULLS FIRST, store_and_fwd_flag ASC NULLS FIRST,
               passenger_count ASC NULLS FIRST, trip_distance ASC NULLS FIRST, trip_type ASC NULLS FIRST,
               fare_amount ASC NULLS FIRST, extra ASC NULLS FIRST, mta_tax ASC NULLS FIRST,
               tip_amount ASC NULLS FIRST, tolls_amount ASC NULLS FIRST, ehail_fee ASC NULLS FIRST,
               improvement_surcharge ASC NULLS FIRST, total_amount ASC NULLS FIRST,
               payment_type ASC NULLS FIRST, payment_type_description ASC NULLS FIRST) AS rn
  FROM (
    SELECT md5(concat_ws('-',
             COALESCE(CAST(u.vendor_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
             COALESCE(CAST(u.pickup_datetime AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
             COALESCE(CAST(u.pickup_location_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
             COALESCE(CAST(u.service_type AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS trip_id,
           u.vendor_id, u.service_type, u.ratecode_id, u.pickup_location_id, u.dropoff_location_id,
           u.pickup_datetime, u.dropoff_datetime, u.store_and_fwd_flag, u.passenger_count,
           u.trip_distance, u.trip_type, u.fare_amount, u.extra, u.mta_tax, u.tip_amount,
           u.tolls_amount, u.ehail_fee, u.improvement_surcharge, u.total_amount,
           COALESCE(u.payment_type, 0) AS payment_type,
           COALESCE(pt.payment_type_name, 'Unknown') AS payment_type_description
    FROM int_trips_unioned u
    LEFT JOIN payment_lookup pt ON COALESCE(u.payment_type, 0) = pt.payment_type_id
  )
) WHERE rn = 1"""))
def job09(spark, sf):
    return M.int_trips(I.unioned(spark, sf), D.payment_lookup(spark))


@query("job10_fhvhv_base_ids", ids=("JOB-10", "UDF-01", "SCL-19", "SCL-02", "PRJ-01", "FLT-01"),
       oracle=sql("""
SELECT CASE WHEN n % 7 = 0 THEN 's/' WHEN n % 3 = 0 THEN 'a/' ELSE 'e/' END
         || lpad(lower(hex(n)), CAST(greatest(3, length(hex(n))) AS INTEGER), '0') AS base_id,
       pickup_date, dropoff_date, PULocationID, DOLocationID
FROM (
  SELECT CAST(substr(dispatching_base_num, 2) AS INTEGER) AS n,
         CAST(pickup_datetime AS DATE) AS pickup_date, CAST(dropoff_datetime AS DATE) AS dropoff_date,
         PULocationID, DOLocationID
  FROM (SELECT 'HV000' || CAST(l_suppkey % 5 + 2 AS VARCHAR) AS hvfhs_license_num,
               'B' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS dispatching_base_num,
               (l_shipdate + to_hours(CAST(l_linenumber AS BIGINT))) AS pickup_datetime,
               (l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) + to_minutes(CAST(CAST(l_quantity AS INTEGER) AS BIGINT))) AS dropoff_datetime,
               CAST(s_nationkey AS INTEGER) AS PULocationID, CAST(c_nationkey AS INTEGER) AS DOLocationID
        FROM trip_lines)
  WHERE hvfhs_license_num = 'HV0003')"""))
def job10(spark, sf):
    df = D.fhvhv_raw(spark, sf).filter(F.col("hvfhs_license_num") == "HV0003")
    return df.select(C.base_id("dispatching_base_num").alias("base_id"),
                     F.to_date("pickup_datetime").alias("pickup_date"),
                     F.to_date("dropoff_datetime").alias("dropoff_date"),
                     "PULocationID", "DOLocationID")
