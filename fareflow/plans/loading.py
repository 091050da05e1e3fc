"""End-to-end load jobs composed from the operators (JOB-07, JOB-08, JOB-10).

Each job is one lazy plan from the landed files to a single write; only
file names and the scalar count of inserted rows pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions import columns as C
from fareflow.operators import loads as L
from fareflow.plans import models as M
from fareflow.sources import files as SRC
from fareflow.sources import sinks as SNK

# Row-id fields of the two landing forms (S8): Postgres hashes seven fields
# as text, BigQuery five fields as bytes.
TEXT_ID_FIELDS = {
    "yellow": ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
               "DOLocationID", "fare_amount", "trip_distance"],
    "green": ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID",
              "DOLocationID", "fare_amount", "trip_distance"],
}
BINARY_ID_FIELDS = {
    "yellow": ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
               "DOLocationID"],
    "green": ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID",
              "DOLocationID"],
}


def ingest_months(spark: SparkSession, base: str, types: Sequence[str], start: str, end: str,
                  extracted_at: str, ext: str = "parquet") -> DataFrame:
    """JOB-07: monthly files of each type in ``[start, end)`` (missing ones
    skipped), renamed to the ingestion schema, stamped and unioned.  Without
    any file the result is the empty ingestion table."""
    batches = []
    for t in types:
        try:
            raw = SRC.read_months(spark, base, [t], start, end, ext)
        except FileNotFoundError:
            continue
        batches.append(M.ingest_batch(raw.drop("taxi_type"), t, extracted_at))
    if not batches:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in M.INGEST_TYPES.items()))
    return M.ingest(batches)


def landed(raw: DataFrame, taxi: str, filename: str, binary_id: bool = False) -> DataFrame:
    """Staged copy: row id and file name in front of the raw columns (LOAD-13)."""
    if binary_id:
        rid = C.row_id_binary(raw, BINARY_ID_FIELDS[taxi])
    else:
        rid = C.row_id_text(raw, TEXT_ID_FIELDS[taxi])
    return raw.select(rid.alias("unique_row_id"), F.lit(filename).alias("filename"), "*")


def row_id_merge_load(spark: SparkSession, raw: DataFrame, target: str, taxi: str,
                      filename: str, binary_id: bool = False,
                      comments: dict[str, str] | None = None) -> int:
    """JOB-08 / LOAD-08: create the target if missing (typed, with column
    comments), stamp row id + file name, insert only unseen ids.  Returns
    the number of rows inserted; re-running the same file inserts none."""
    staged = landed(raw, taxi, filename, binary_id)
    SNK.create_if_missing(spark, target, staged.schema, comments or {})
    return L.insert_only_table(spark, target, staged, "unique_row_id")


def convert_csv_to_parquet(spark: SparkSession, src: str | Sequence[str], schema: T.StructType,
                           ts: str, dst: str, partitions: int | None = None) -> None:
    """JOB-10: typed CSV (gzip allowed) → Parquet laid out by year/month.

    Gzip CSV is one task per file; with ``partitions`` the rows are spread
    before the write so the conversion itself runs in parallel."""
    df = SRC.read_csv(spark, src, schema=schema)
    if partitions:
        df = df.repartition(partitions)
    SNK.convert_months(df, ts, dst)
