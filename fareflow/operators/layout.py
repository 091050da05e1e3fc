"""Physical layout: partitioning, clustering, caching, compaction (LAY-*)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.loads import recover_swap, write_swap
from fareflow.session import delete_path, path_exists, touch

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


# LAY-04 / LAY-05 / LAY-06 / LAY-07 --------------------------------------------------------
def with_date_partition(df: DataFrame, ts: str, name: str = "pickup_date") -> DataFrame:
    return df.withColumn(name, F.to_date(ts))


def write_by_date(df: DataFrame, path: str, ts: str, name: str = "pickup_date",
                  cluster_by: Sequence[str] = (), mode: str = "overwrite",
                  max_records: int | None = None, only_own_dates: bool = False) -> None:
    """Partition by ``DATE(ts)`` (and cluster by sorting within each file).

    An overwrite replaces the whole table, or with ``only_own_dates`` just the
    dates that ``df`` holds.

    Rows are grouped by date with a ``REBALANCE`` hint: dates arrive at
    few writers (few files per date), while AQE splits a date that is
    larger than the advisory partition size across several tasks, so a
    date holding a third of the data is not written by one task.  Sorting by
    the date and then the cluster columns tightens Parquet min/max statistics,
    so filters on them skip row groups (LAY-06); the writer needs the date
    first, or it would sort again by the date alone and lose the order.
    ``clustering.write_clustered`` clusters by several columns at once.
    """
    out = with_date_partition(df, ts, name).hint("rebalance", name)
    if cluster_by:
        out = out.sortWithinPartitions(name, *cluster_by)
    kept = "dynamic" if only_own_dates else "static"
    w = out.write.mode(mode).option("partitionOverwriteMode", kept).partitionBy(name)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)


def write_by_year_month(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> None:
    out = df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
    out.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month").parquet(path)


# LAY-09 ---------------------------------------------------------------------------------------
def target_partitions(total_bytes: int, cores: int, target_bytes: int = TARGET_PARTITION_BYTES,
                      waves: int = 2) -> int:
    """Partitions for ``total_bytes``: enough to keep each near ``target_bytes``
    and at least ``waves`` × ``cores`` so every core stays busy."""
    by_size = math.ceil(total_bytes / target_bytes) if total_bytes > 0 else 1
    return max(by_size, cores * waves, 1)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under ``path`` from the file system (no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


# LAY-10 ---------------------------------------------------------------------------------------
def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition (``partition_id, rows``)."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def skew_report(df: DataFrame) -> DataFrame:
    """One row: partitions, total, min, max, mean rows and max/mean ratio."""
    s = partition_sizes(df)
    return s.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("total_rows"),
                 F.min("rows").alias("min_rows"), F.max("rows").alias("max_rows"),
                 F.avg("rows").alias("mean_rows"),
                 (F.max("rows") / F.avg("rows")).alias("skew_ratio"))


# LAY-12 / LAY-13 ---------------------------------------------------------------------------------
def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a stored table, from its ``name=value`` folders."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: list[str] = []
    while True:
        below = [s.getPath() for s in fs.listStatus(p)
                 if s.isDirectory() and "=" in s.getPath().getName()]
        if not below:
            return found
        p = below[0]
        found.append(p.getName().split("=", 1)[0])


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Rewrite many small files as ~``target_bytes`` files (write-then-swap).

    A partitioned table keeps its partition folders; rows are grouped by them
    with a ``REBALANCE`` hint, so a large partition is still written by
    several tasks."""
    recover_swap(spark, path)
    n = max(1, math.ceil(input_bytes(spark, path) / target_bytes))
    cols = partition_columns(spark, path)
    df = spark.read.parquet(path)
    if cols:
        write_swap(df.hint("rebalance", *cols), path, partition_by=cols)
    else:
        write_swap(df.repartition(n), path)
    return n


ARCHIVE_RUN = "archive_run"


def archive_split(df: DataFrame, ts: str, cutoff: str, hot_path: str, cold_path: str) -> int:
    """Rows before ``cutoff`` to the cold path, the rest to the hot path; returns the run.

    ``df`` may read the hot path itself.  Every run writes its own partition
    ``archive_run=<n>`` of the cold path and nothing of earlier runs, so equal
    rows that arrive later are archived again, and no run reads or rewrites
    the archive.  A run is open from its ``_open_<n>`` file in the cold path
    until the file goes.  If a run is found open, it stopped on the way: while
    the hot table does not carry the run's ``_archived_<n>`` file (swapped in
    together with the table), the run is repeated over its own partition;
    otherwise both halves are done and a new run begins."""
    spark = df.sparkSession
    cold, hot = cold_path.rstrip("/"), hot_path.rstrip("/")
    recover_swap(spark, hot)
    runs, opened = _archive_runs(spark, cold)
    if opened and not path_exists(spark, f"{hot}/_archived_{opened}"):
        run = opened
    else:
        if opened:
            delete_path(spark, f"{cold}/_open_{opened}")
        run = max([*runs, 0]) + 1
    touch(spark, f"{cold}/_open_{run}")
    c = F.lit(cutoff).cast("timestamp_ntz")
    df.filter(F.col(ts) < c).write.mode("overwrite").parquet(f"{cold}/{ARCHIVE_RUN}={run}")
    write_swap(df.filter((F.col(ts) >= c) | F.col(ts).isNull()), hot, marker=f"_archived_{run}")
    delete_path(spark, f"{cold}/_open_{run}")
    return run


def _archive_runs(spark: SparkSession, cold: str) -> tuple[list[int], int | None]:
    """Numbers of the archive's runs, and the one found open."""
    if not path_exists(spark, cold):
        return [], None
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cold)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    opened = [int(n.rsplit("_", 1)[1]) for n in names if n.startswith("_open_")]
    return ([int(n.split("=", 1)[1]) for n in names if n.startswith(f"{ARCHIVE_RUN}=")],
            max(opened) if opened else None)


# LAY-14 ---------------------------------------------------------------------------------------------
def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (what ``explain`` prints)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


JOIN_OPERATORS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                  "BroadcastNestedLoopJoin", "CartesianProduct")


def join_strategies(df: DataFrame) -> list[str]:
    """Join operators chosen in the executed plan (after AQE re-planning if
    the plan has run, else the initial plan)."""
    txt = plan_text(df, "simple")
    return [op for op in JOIN_OPERATORS if op in txt]
