"""Window-style operators (WIN-*).

De-duplication ("keep the first row per key") orders by the given columns
and then by every other column, so the survivor is always the same row (S6).

``keep_first`` is ``row_number() = 1`` over that total order.  Spark plans
it with a *partial* ``WindowGroupLimit`` before the shuffle, so each input
partition forwards at most one row per key; a key holding a third of all
rows reaches the final window as at most one row per map partition, not as
one giant sorted group.  ``keep_first_aggregate`` is the same result as a
grouped ``min``/``max`` over a struct (also combined map-side, but through
a sort-based aggregate, which measured slower).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions.columns import floor_div


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 descending: bool) -> list[Column]:
    rest = [c for c in df.columns if c not in keys and c not in order]
    cols = list(order) + rest
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in cols]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               descending: bool = False) -> DataFrame:
    """One row per ``keys``: the first by ``order`` then by all other columns.

    Ascending sorts NULLs first, descending NULLs last (the orderings of
    ``keep_first_aggregate``'s ``min``/``max`` on structs).
    """
    return keep_first_window(df, keys, _total_order(df, keys, order, descending))


def keep_first_aggregate(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                         descending: bool = False) -> DataFrame:
    """Same result as ``keep_first`` via ``min``/``max`` over a struct."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("__first"))
    return out.select(*[F.col(k) if k in keys else F.col(f"__first.{k}").alias(k)
                        for k in df.columns])


def keep_first_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``row_number() = 1`` over an explicit ordering (QUALIFY rewritten as
    a filter, S4); Spark adds the partial group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-05: keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
              .filter(F.col("dup_count") > 1))


def moving_average(df: DataFrame, part: str, ts: str, value: str,
                   seconds: int = 300, out: str = "moving_avg",
                   chunk_seconds: int | None = None) -> DataFrame:
    """WIN-06: average of ``value`` over the trailing ``seconds`` (inclusive)
    per ``part``, for every row.

    Exact and skew-safe: each key's timeline is cut into chunks (twelve times
    the window, unless given; never shorter than the window) and the window
    runs per (key, chunk).  Rows in the last ``seconds`` of a chunk are copied
    into the next chunk as context (so its first rows see their full history)
    and dropped after the window.  A key holding a third of all rows is
    therefore spread over as many tasks as it has chunks; at most
    ``seconds / chunk_seconds`` of the rows are copied.  All times are integer
    microseconds, so rows exactly on a bound stay on their side.
    """
    width, span = max(chunk_seconds or 12 * seconds, seconds) * 1_000_000, seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    chunk = floor_div(micros, width)
    here = F.struct(chunk.alias("c"), F.lit(False).alias("ctx"))
    there = F.struct((chunk + 1).alias("c"), F.lit(True).alias("ctx"))
    near_end = F.pmod(micros, F.lit(width).cast("long")) >= width - span
    x = (df.withColumn("__micros", micros)
           .withColumn("__copy", F.explode(F.when(near_end, F.array(here, there))
                                           .otherwise(F.array(here))))
           .withColumn("__chunk", F.col("__copy.c")))
    w = Window.partitionBy(part, "__chunk").orderBy("__micros").rangeBetween(-span, 0)
    res = x.withColumn(out, F.avg(value).over(w))
    return res.filter(~F.col("__copy.ctx")).drop("__micros", "__copy", "__chunk")
