"""Model inputs assembled from the driver tables (Spark side).

``plans/oracle.py`` mirrors each function here in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions import columns as C
from fareflow.operators import projection as P
from fareflow.plans import models as M
from fareflow.sources import driver as D

# Whole-data interval for the Bruin track: every driver timestamp lies inside.
ALL_START = "1990-01-01 00:00:00"
ALL_END = "2030-01-01 00:00:00"


def notebook_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Both services over their common columns, from one scan of the trip lines."""
    t = D.raw_trips(spark, sf)
    return t.select(*M.NOTEBOOK_COLUMNS, "service_type")


def unioned(spark: SparkSession, sf: str) -> DataFrame:
    """Staging of both services from one scan (equal to the union of the two
    staging models, see tests)."""
    return M.stg_trips(D.raw_trips(spark, sf))


def unioned_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """The same as the union of the green and the yellow staging model."""
    return M.trips_unioned(D.raw_green(spark, sf), D.raw_yellow(spark, sf))


def fct_trips(spark: SparkSession, sf: str) -> DataFrame:
    return M.fct_trips(unioned(spark, sf), D.zones(spark, sf))


def yellow_with_airport_fee(spark: SparkSession, sf: str) -> DataFrame:
    """Yellow files of the later schema carry ``Airport_fee``; green ones do not."""
    base = D.trip_lines(spark, sf).filter(F.col("l_returnflag") != "A")
    cols = D._raw_columns(green=False)
    cols["tpep_pickup_datetime"] = cols.pop("pickup")
    cols["tpep_dropoff_datetime"] = cols.pop("dropoff")
    fee = F.when(F.col("s_nationkey") % 7 == 0, F.lit(1.25)).otherwise(F.lit(0.0))
    return base.select(*[cols[c].alias(c) for c in D.YELLOW_COLUMNS], fee.alias("Airport_fee"))


def _with_refetch(batch: DataFrame) -> DataFrame:
    """First fetch of every row plus a later re-fetch of the first line of
    each order (same values, later ``extracted_at``), in one pass."""
    stamps = F.when(
        F.col("passenger_count") == 1,
        F.array(C.load_stamp(D.FIRST_EXTRACT), C.load_stamp(D.REFETCH_EXTRACT)),
    ).otherwise(F.array(C.load_stamp(D.FIRST_EXTRACT)))
    return batch.withColumn("extracted_at", F.explode(stamps))


def ingestion_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Both services' ingestion from one scan; green files carry no airport fee."""
    t = D.raw_trips(spark, sf)
    fee = F.when(F.col("service_type") == "yellow", F.col("zone_fee"))
    t = P.rename(t.withColumn("airport_fee", fee).withColumnRenamed("service_type", "taxi_type"),
                 M.INGEST_RENAME)
    return M.conform_ingestion(_with_refetch(t))


def ingestion_trips_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """The same as the union by name of one fetched batch per service."""
    g = M.ingest_batch(D.raw_green(spark, sf), "green", D.FIRST_EXTRACT)
    y = M.ingest_batch(yellow_with_airport_fee(spark, sf), "yellow", D.FIRST_EXTRACT)
    return M.ingest([_with_refetch(g), _with_refetch(y)])


def staging_trips(spark: SparkSession, sf: str, start: str = ALL_START,
                  end: str = ALL_END) -> DataFrame:
    return M.staging_trips(ingestion_trips(spark, sf), D.payment_lookup(spark), start, end)
