"""File sources (SRC-*).

Readers return lazy DataFrames; nothing is read until an action.  Explicit
schemas are preferred everywhere: inference costs an extra pass over the
input (and over all of it for JSON), which at 100 TB is a full scan.
Compressed CSV (gzip) is not splittable, so such inputs are read one task
per file and should be repartitioned right after the read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.columns import load_stamp, source_file_path, trip_file_name
from fareflow.session import path_exists, staged


# SRC-01 … SRC-04 ---------------------------------------------------------------
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False, permissive: bool = False,
             strict: bool = False) -> DataFrame:
    """CSV with a header.

    * no schema, ``infer=False``: every column is a string (SRC-01);
    * ``schema``: typed read, no inference pass (SRC-02);
    * ``infer=True``: types sampled from the data (SRC-03, costs a pass);
    * ``permissive=True`` (with a schema): a line whose fields do not fit, or
      with too few or too many of them, keeps what parses and carries the
      whole line in ``_corrupt_record`` (SRC-04; see ``split_rejects``);
    * ``strict=True`` (with a schema): such a line fails the job.
    """
    r = spark.read.option("header", header)
    if schema is not None:
        if permissive:
            fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            schema = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
            r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        elif strict:
            r = r.option("mode", "FAILFAST")
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the raw lines that did not (dead letters).

    The parsed rows are staged once: both outputs read them, and Spark does
    not answer queries on the corrupt-record column alone from the files.
    """
    df = staged(df, "parsed")
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


# SRC-05 / SRC-07 / SRC-14 --------------------------------------------------------
def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files, directories or globs (``…/*/*``)."""
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union across files whose columns differ (missing → NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def external_table(spark: SparkSession, name: str, paths: Sequence[str], fmt: str = "parquet",
                   **options) -> DataFrame:
    """Files queried by name: a temporary view over one or more URI patterns."""
    df = spark.read.format(fmt).options(**options).load(list(paths))
    df.createOrReplaceTempView(name)
    return df


# SRC-06 ------------------------------------------------------------------------------
def month_starts(start: str, end: str) -> list[dt.date]:
    """First days of the months in ``[start, end)``."""
    d = dt.date.fromisoformat(start[:10]).replace(day=1)
    stop = dt.date.fromisoformat(end[:10])
    out = []
    while d < stop:
        out.append(d)
        d = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return out


def month_paths(base: str, types: Iterable[str], start: str, end: str, ext: str = "parquet") -> list[tuple[str, str]]:
    """``(taxi_type, path)`` for every type × month in ``[start, end)``."""
    return [(t, f"{base.rstrip('/')}/{trip_file_name(t, m.year, m.month, ext)}")
            for m in month_starts(start, end) for t in types]


def read_months(spark: SparkSession, base: str, types: Iterable[str], start: str, end: str,
                ext: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """Read the monthly files that exist (missing ones are skipped, S21),
    tagged with their type.

    Columns may differ between months: files are read in one scan per type and
    schema, then joined by name, absent columns as NULL.  Where one column has
    different types, the first file's type is used for all.  If no file exists
    the result is empty with ``schema``; without one that is an error.

    Only file names and footers are handled on the driver.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    shapes: dict[str, T.StructType] = {}
    for t, p in month_paths(base, types, start, end, ext):
        if path_exists(spark, p):
            shape = spark.read.format(ext).load(p).schema
            shapes[shape.json()] = shape
            groups.setdefault((t, shape.json()), []).append(p)
    if not groups:
        if schema is None:
            raise FileNotFoundError(f"no monthly file of {list(types)} in [{start}, {end}) under {base}")
        return spark.createDataFrame([], schema).withColumn("taxi_type", F.lit(None).cast("string"))
    kinds: dict[str, T.DataType] = {}
    for shape in shapes.values():
        for f in shape.fields:
            kinds.setdefault(f.name, f.dataType)
    frames = []
    for (t, shape), paths in groups.items():
        df = spark.read.format(ext).schema(shapes[shape]).load(paths)
        frames.append(df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])
                      .withColumn("taxi_type", F.lit(t)))
    return union_by_name(frames)


# SRC-08 / SRC-09 ---------------------------------------------------------------------
def read_json_array(spark: SparkSession, path: str, field: str,
                    schema: T.StructType | str | None = None,
                    multi_line: bool = True) -> DataFrame:
    """A JSON document ``{field: [ {...}, … ]}`` → one row per element.

    Multi-line JSON documents are not splittable; this is a landing-format
    reader for API extracts.  With ``multi_line=False`` every line is a
    document of its own and files are split as usual.
    """
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    doc = r.json(path)
    return doc.select(F.explode(F.col(field)).alias("__e")).select("__e.*")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; schema inferred when not given (a full pass)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


# SRC-10 / SRC-11 / SRC-12 ----------------------------------------------------------------
def seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Lookup seed from CSV with declared types (broadcast on join)."""
    return read_csv(spark, path, schema=schema)


def from_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    return spark.createDataFrame(list(rows), columns if isinstance(columns, str) else list(columns))


def schema_from_sample(spark: SparkSession, pdf: pd.DataFrame, rows: int = 1000) -> T.StructType:
    """Spark schema inferred from the first ``rows`` rows of a pandas frame."""
    return spark.createDataFrame(pdf.head(rows)).schema


# SRC-13 -------------------------------------------------------------------------------------
def read_jdbc(spark: SparkSession, url: str, table: str, user: str, password: str,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int = 8) -> DataFrame:
    """JDBC table (driver jar and credentials supplied by the caller).

    With ``partition_column`` the read is split into ``partitions`` range
    queries instead of a single connection.  Not exercised offline.
    """
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("user", user).option("password", password))
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", partitions))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, user: str, password: str,
               mode: str = "append") -> None:
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
       .option("user", user).option("password", password).mode(mode).save())


# SRC-15 -------------------------------------------------------------------------------------
def with_source_columns(df: DataFrame, loaded_at: str) -> DataFrame:
    """Bronze columns: load time literal, source file path, raw record JSON."""
    cols = [c for c in df.columns]
    return df.select(load_stamp(loaded_at).alias("_loaded_at"),
                     source_file_path().alias("_source_file"),
                     F.to_json(F.struct(*cols)).alias("raw_data"))


# SRC-17 / SRC-18 ----------------------------------------------------------------------------
def salt_values(spark: SparkSession, n: int) -> DataFrame:
    """``0 … n-1`` as column ``salt``."""
    return spark.range(n).select(F.col("id").cast("int").alias("salt"))


def read_any(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
             **options) -> DataFrame:
    """One entry point for csv, json, parquet, orc (avro needs an external jar)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)
