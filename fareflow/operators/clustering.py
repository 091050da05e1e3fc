"""Multi-column clustering (LAY-06): a space-filling-curve layout.

Each clustering column is cut at quantiles of its own values, so a row gets a
small bucket number per column.  Interleaving the numbers' bits (Morton order)
gives one number under which rows that are close in *every* column are close.
The table is range-partitioned and sorted by that number, so a file covers a
small box in all columns, and a filter on any of them skips most files by
their minimum and maximum.

The bucket numbers are nested comparisons against literals (one per bit), so
they stay in generated code.  Cuts only shape the layout: they may come from a
sample, and rows outside its range fall into the outer buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6
ACCURACY = 10_000
CURVE = "__curve"


def as_number(df: DataFrame, name: str) -> Column:
    """A column as a number that keeps its order (strings: their first six bytes).

    NaN counts above everything, as in Spark's order; NULL stays NULL.
    """
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(c.cast("date")).cast("double")
        clock = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        return day * 86_400 + clock
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"column {name!r} of type {kind.simpleString()} cannot be clustered")


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS,
                  sample: float | None = None, accuracy: int = ACCURACY) -> dict[str, list[float]]:
    """Up to ``2 ** bits - 1`` increasing cuts per column, in one aggregation.

    ``sample`` takes that share of the rows; the result is a few numbers per
    column whatever the table's size.
    """
    rows = df if sample is None else df.sample(fraction=sample, seed=11)
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(as_number(df, c), steps, accuracy).alias(f"q{i}")
                       for i, c in enumerate(columns)]).first()
    # Repeated cuts (a frequent value) would leave buckets empty: keep one of each.
    return {c: sorted({x for x in (found[i] or []) if x is not None and x == x})
            for i, c in enumerate(columns)}


def bucket(value: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts below ``value``, by halving; NULL is in bucket 0."""
    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(cuts[mid]), pick(mid + 1, hi)).otherwise(pick(lo, mid))
    return pick(0, len(cuts))


def interleave(numbers: Sequence[Column], bits: int) -> Column:
    """Morton number: bit i of column c becomes bit ``i * columns + c``."""
    k = len(numbers)
    if k * bits > 62:
        raise ValueError(f"{k} columns of {bits} bits do not fit a long")
    out = F.lit(0).cast("long")
    for c, n in enumerate(numbers):
        for i in range(bits):
            bit = F.shiftright(n, i).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, i * k + (k - 1 - c)))
    return out


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS,
          cuts: Mapping[str, Sequence[float]] | None = None) -> Column:
    """The clustering number of each row of ``df``."""
    cuts = cuts if cuts is not None else quantile_cuts(df, columns, bits)
    # A column with few distinct cuts is spread over all bits, or its low bits
    # alone would be compared after every bit of the others.
    spread = [F.floor(bucket(as_number(df, c), cuts[c]) * F.lit((1 << bits) - 1)
                      / F.lit(max(len(cuts[c]), 1))).cast("int") for c in columns]
    return interleave(spread, bits)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int,
                    bits: int = BITS, sample: float | None = None, mode: str = "overwrite",
                    max_records: int | None = None) -> None:
    """Write ``df`` as about ``files`` files along the curve over ``columns``.

    Rows of one number (a frequent value in every column) are told apart by a
    hash of the row and of the input split it was read from, so they spread
    over as many files as they need, equal rows too; both are the same when a
    task runs again.  The sort inside the partition is the last step before the
    write, so rows lie in curve order in every file.
    """
    number = curve(df, columns, bits, quantile_cuts(df, columns, bits, sample))
    split = [F.input_file_name(), F.input_file_block_start()]
    tie = F.xxhash64(*split, *[F.col(c) for c in df.columns if not _has_map(df.schema[c].dataType)])
    w = (df.withColumn(CURVE, number).withColumn("__tie", tie)
         .repartitionByRange(files, CURVE, "__tie").sortWithinPartitions(CURVE, "__tie")
         .drop(CURVE, "__tie").write.mode(mode))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def file_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``file, rows`` and ``min_c, max_c`` per column: what pruning by statistics sees."""
    return (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]))


def files_for_box(bounds: DataFrame, box: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """One row: ``files`` in all and ``opened``, those whose bounds meet the box
    (``column -> (low, high)``, both ends included).  Files of NULLs alone stay shut."""
    meets = F.lit(True)
    for c, (low, high) in box.items():
        meets = meets & (F.col(f"min_{c}") <= F.lit(high)) & (F.col(f"max_{c}") >= F.lit(low))
    return bounds.agg(F.count(F.lit(1)).alias("files"), F.count_if(meets).alias("opened"))
