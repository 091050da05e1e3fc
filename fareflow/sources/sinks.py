"""Sinks and write modes (SNK-*).

Output file count is a layout decision made right before the write:
``repartition(n)`` for a fixed count (full shuffle), ``coalesce(1)`` only
for small reports (it funnels the whole result through one task), and
``partitionBy`` + ``maxRecordsPerFile`` for large tables so files stay
bounded regardless of data size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.session import path_exists


# SNK-01 / SNK-02 / SNK-06 / SNK-11 ----------------------------------------------------
def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
          partition_by: Sequence[str] | None = None, **options) -> None:
    """``mode``: ``overwrite`` (SNK-01), ``errorifexists`` (default, SNK-02),
    ``append`` (SNK-06); ``fmt`` ``json`` for SNK-11."""
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# SNK-03 / SNK-04 / SNK-05 / SNK-09 -----------------------------------------------------
def write_n_files(df: DataFrame, path: str, n: int, mode: str = "overwrite") -> None:
    """Exactly ``n`` output files via a full redistribution."""
    df.repartition(n).write.mode(mode).parquet(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                      header: bool = True) -> None:
    """One output file.  For small results (reports) only."""
    w = df.coalesce(1).write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


def write_capped_files(df: DataFrame, path: str, max_records: int, mode: str = "overwrite",
                       partition_by: Sequence[str] | None = None) -> None:
    """Bound file size by row count (SNK-09)."""
    w = df.write.mode(mode).option("maxRecordsPerFile", max_records)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# SNK-07 ---------------------------------------------------------------------------------
def convert_months(df: DataFrame, ts: str, path: str, mode: str = "overwrite") -> None:
    """CSV → Parquet for all months in one job, output laid out as
    ``year=YYYY/month=M`` (the reference's per-month loop, as one write).
    Rows are grouped by month with a ``REBALANCE`` hint so each task writes
    few files, and AQE splits an oversized month across tasks."""
    out = df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
    (out.hint("rebalance", "year", "month").write.mode(mode)
        .partitionBy("year", "month").parquet(path))


# SNK-08 ---------------------------------------------------------------------------------
def create_or_replace(df: DataFrame, path: str) -> None:
    """CTAS create-or-replace as write-then-swap (safe when ``df`` reads ``path``)."""
    from fareflow.operators.loads import write_swap
    write_swap(df, path)


# SNK-12 ---------------------------------------------------------------------------------
def peek(df: DataFrame, n: int = 5) -> list:
    """Bounded look at a result (``take``), never ``collect`` of a full table."""
    return df.take(n)


# SNK-13 ---------------------------------------------------------------------------------
def schema_ddl(df: DataFrame) -> str:
    """DDL text of a frame's schema (``col type, …``)."""
    return df._jdf.schema().toDDL()


# SNK-14 ---------------------------------------------------------------------------------
def with_comments(schema: T.StructType, comments: Mapping[str, str]) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, f.dataType, f.nullable,
                      {**(f.metadata or {}), **({"comment": comments[f.name]} if f.name in comments else {})})
        for f in schema.fields])


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType,
                      comments: Mapping[str, str] | None = None,
                      partition_by: Sequence[str] | None = None) -> bool:
    """Create an empty typed table (with column comments) only if absent."""
    if path_exists(spark, path):
        return False
    s = with_comments(schema, comments or {})
    empty = spark.createDataFrame([], s)
    w = empty.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True
