"""Projections and filters (PRJ-*, FLT-*).

All of these are plain ``select``/``filter`` calls so that Catalyst can prune
columns and push predicates into the Parquet scan.  Column-list logic runs
on the driver over schema names only, never over data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# PRJ-01 / PRJ-12 --------------------------------------------------------------
def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


# PRJ-02 / PRJ-03 ----------------------------------------------------------------
def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names absent from ``df`` are ignored (PRJ-03)."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


# PRJ-04 / PRJ-05 ---------------------------------------------------------------
def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns present in both frames, in the left frame's order."""
    right_cols = set(right.columns)
    return [c for c in left.columns if c in right_cols]


def keep_existing(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Select the expected columns that exist, in expected order."""
    have = set(df.columns)
    return df.select(*[c for c in expected if c in have])


# PRJ-06 / PRJ-07 / PRJ-13 --------------------------------------------------------
def with_literal(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    lit = F.lit(value)
    return df.withColumn(name, lit.cast(dtype) if dtype else lit)


def star_plus(df: DataFrame, extra: Mapping[str, Column], front: bool = False) -> DataFrame:
    """``SELECT *, extra…`` (or extras first, as in the row-id CTAS)."""
    extras = [c.alias(n) for n, c in extra.items()]
    return df.select(*extras, "*") if front else df.select("*", *extras)


def cast_rename(df: DataFrame, spec: Sequence[tuple[str | Column, str, str | None]]) -> DataFrame:
    """Staging projection: ``(source, target name, target type or None)``."""
    out = []
    for src, name, dtype in spec:
        c = F.col(src) if isinstance(src, str) else src
        out.append((c.cast(dtype) if dtype else c).alias(name))
    return df.select(*out)


# PRJ-11 -------------------------------------------------------------------------
def project_with_default(df: DataFrame, cols: Sequence[str], default: str = "N/A") -> DataFrame:
    """Keep a runtime list of fields; absent or NULL fields become ``default``.

    Values are rendered as text so that present and defaulted values share a
    column type, as in the JSON record projection of the reference.
    """
    out = []
    for c in cols:
        if c in df.columns:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit(default)).alias(c))
        else:
            out.append(F.lit(default).alias(c))
    return df.select(*out)


# FLT-* ---------------------------------------------------------------------------
def not_null(*cols: str) -> Column:
    cond = None
    for c in cols:
        p = F.col(c).isNotNull()
        cond = p if cond is None else cond & p
    return cond


def non_negative(*cols: str) -> Column:
    """``c >= 0`` for each column; NULL compares unknown and is dropped (S14)."""
    cond = None
    for c in cols:
        p = F.col(c) >= 0
        cond = p if cond is None else cond & p
    return cond


def half_open(c: str, start, end) -> Column:
    """``start <= c < end`` (FLT-04 / FLT-06); literals are cast to ``c``'s kind."""
    return (F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(end))


def ts_range(c: str, start: str, end: str) -> Column:
    """Half-open range on a zone-free timestamp column (pushes into the scan)."""
    return ((F.col(c) >= F.lit(start).cast("timestamp_ntz"))
            & (F.col(c) < F.lit(end).cast("timestamp_ntz")))


def date_between(c: str, first: str, last: str) -> Column:
    """FLT-05: closed ``DATE(c) BETWEEN first AND last``, rewritten as a
    half-open timestamp range so the scan can prune on ``c`` directly."""
    end = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return (F.col(c) >= F.lit(first).cast("date").cast("timestamp_ntz")) & (F.col(c) < end)


def on_day(c: str, day: str) -> Column:
    """FLT-07: the timestamp falls on ``day`` (as a half-open range)."""
    return date_between(c, day, day)


def clean_trips(df: DataFrame) -> DataFrame:
    """FLT-03: the staging cleaning predicate (keys present, amounts ≥ 0)."""
    return df.filter(not_null("pickup_datetime", "dropoff_datetime", "pickup_location_id",
                              "dropoff_location_id", "fare_amount")
                     & non_negative("fare_amount", "total_amount"))


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """FLT-09."""
    return df.dropna("any", subset=list(subset) if subset else None)
