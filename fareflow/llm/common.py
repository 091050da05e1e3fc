"""Helpers shared by the training-data operators.

Rules every operator follows:

* Only the columns an operator names are read, by name, so extra columns
  (also ones that clash with working names) never reach its plan.
* Rows that a later step needs twice are written as Parquet under the shared
  ``spark.checkpoint.dir``; nothing lives in a local folder or on the driver.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from inspect import signature

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(docs: DataFrame) -> F.Column:
    """All columns in one struct, so working columns beside it can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(docs: DataFrame, row: str, changed: dict[str, F.Column]) -> list[F.Column]:
    """The columns of ``docs`` again, those in ``changed`` by their new value."""
    return [changed.get(c, F.col(row)[c]).alias(c) for c in docs.columns]


def spread(df: DataFrame, *keys: str, buckets: int) -> F.Column:
    """A stable bucket number from the hash of ``keys``."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def give_back() -> None:
    """Return freed memory to the system; reused workers would keep it beside the next step's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def giving_back(task: Callable) -> Callable:
    """``task``, a function of grouped or co-grouped rows, followed by ``give_back``."""
    def grouped(rows):
        try:
            return task(rows)
        finally:
            give_back()

    def cogrouped(left, right):
        try:
            return task(left, right)
        finally:
            give_back()

    return cogrouped if len(signature(task).parameters) == 2 else grouped


def few_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, so that a task's working copies stay small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    give_back()
