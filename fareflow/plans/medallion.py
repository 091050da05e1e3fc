"""Bronze → silver → gold composition (LOAD-15, JOB-12).

Bronze keeps the landed record as JSON text with load metadata; silver casts,
derives the trip duration and drops incomplete rows; gold aggregates by day
and zone.  Each layer is a plain function so the layers compose lazily and
Catalyst optimises across them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions import columns as C


def bronze(raw: DataFrame, loaded_at: str, source_file: str | None = None) -> DataFrame:
    """Landed rows as JSON text plus ``_loaded_at`` and ``_source_file``."""
    src = F.lit(source_file) if source_file is not None else C.source_file_path()
    return raw.select(C.load_stamp(loaded_at).alias("_loaded_at"),
                      src.alias("_source_file"),
                      F.to_json(F.struct(*raw.columns)).alias("raw_data"))


RAW_TRIP = ("hvfhs_license_num string, dispatching_base_num string, "
            "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
            "PULocationID int, DOLocationID int, SR_Flag string")


def from_bronze(landed: DataFrame) -> DataFrame:
    """The raw trips a bronze table holds as JSON text."""
    return landed.select(F.from_json("raw_data", RAW_TRIP).alias("r")).select("r.*")


def silver_trips(raw: DataFrame) -> DataFrame:
    """Typed, complete trips with a whole-minute duration."""
    t = raw.select(
        "hvfhs_license_num", "dispatching_base_num",
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"))
    t = t.withColumn("trip_duration_min", C.minutes_between("pickup_datetime", "dropoff_datetime"))
    return t.filter(F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull()
                    & F.col("pickup_location_id").isNotNull())


def gold_daily_summary(silver: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips, average duration and distinct bases per day and pickup zone."""
    z = zones.select(F.col("locationid").alias("pickup_location_id"),
                     F.col("zone").alias("pickup_zone"))
    j = silver.join(z, "pickup_location_id")
    return (j.groupBy(F.to_date("pickup_datetime").alias("trip_date"), "pickup_zone")
             .agg(F.count(F.lit(1)).alias("total_trips"),
                  C.exact_avg("trip_duration_min").alias("avg_duration_min"),
                  F.count_distinct("dispatching_base_num").alias("unique_bases")))
