"""Mergeable sketches per period (AGG-23, AGG-26, AGG-13, AGG-28).

A period's rows are read once and become one small binary per group: a KLL
sketch for quantiles, a theta sketch for distinct counts.  Longer periods and
cohorts come from the stored sketches alone, so nothing is rescanned, and a
late or repeated period replaces its own partition.  All of it is built-in
aggregation (partial before the shuffle), so a hot group is combined where its
rows are.

Bounds: a KLL sketch of size ``k`` answers a rank within
``quantile_rank_error(k)`` of the asked one with 99 % confidence, and exactly
while it holds at most ``k`` values.  A theta sketch of ``2 ** lg`` entries is
exact below that many distinct values and has a relative standard error of
``distinct_error(lg)`` beyond; an intersection's error relates to the union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.session import path_exists

QUANTILE_SIZE = 800
DISTINCT_LG = 14


def quantile_rank_error(k: int) -> float:
    """Rank error of a KLL sketch of size ``k`` at 99 % confidence."""
    return 2.296 / k ** 0.9723


def distinct_error(lg: int) -> float:
    """Relative standard error of a theta sketch with ``2 ** lg`` entries."""
    return 1 / ((1 << lg) - 1) ** 0.5


# ---- per period ----------------------------------------------------------------
def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], value: str,
                      k: int = QUANTILE_SIZE) -> DataFrame:
    """One KLL sketch per key: ``sketch`` and ``n``.  NULL and NaN values are left out."""
    v = F.col(value).cast("double")
    kept = F.when(~F.isnan(v), v)
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(kept, k).alias("sketch"),
                                 F.count(kept).alias("n"))


def distinct_sketches(df: DataFrame, keys: Sequence[str | Column], item: str,
                      lg: int = DISTINCT_LG) -> DataFrame:
    """One theta sketch of the distinct ``item`` values per key."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(item, lg).alias("sketch"))


def store_periods(sketches: DataFrame, path: str, period: str) -> None:
    """Write sketches by period; periods present in ``sketches`` are replaced."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(period).parquet(path))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


# ---- quantiles over periods -------------------------------------------------------
def merge_quantiles(sketches: DataFrame, keys: Sequence[str | Column],
                    k: int = QUANTILE_SIZE) -> DataFrame:
    """Sketches of longer periods, from stored ones (empty ones pass through)."""
    held = F.when(F.col("n") > 0, F.col("sketch"))
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(held, k).alias("sketch"),
                                       F.sum("n").alias("n"))


def quantile(p: float, sketch: str = "sketch") -> Column:
    """The value at rank ``p`` (NULL for groups without values: needs ``n``)."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))))


def rank_miss(rows: DataFrame, answers: DataFrame, key: str, value: str, answer: str,
              p: float) -> DataFrame:
    """How far each answer's rank is from ``p``, counted over all rows:
    ``key, miss``.  The answer's rank is an interval when values repeat."""
    j = rows.select(F.col(key).alias("__k"), F.col(value).cast("double").alias("__v")).join(
        answers.select(F.col(key).alias("__a"), F.col(answer).alias("__q")),
        F.col("__k").eqNullSafe(F.col("__a")))
    v = F.when(~F.isnan("__v"), F.col("__v"))
    n = F.nullif(F.count(v), F.lit(0))  # a group without values has no ranks: NULL
    low, high = F.count_if(v < F.col("__q")) / n, F.count_if(v <= F.col("__q")) / n
    miss = F.when(n.isNotNull(), F.greatest(low - F.lit(p), F.lit(p) - high, F.lit(0.0)))
    return j.groupBy(F.col("__k").alias(key)).agg(miss.alias("miss"))


# ---- distinct counts over periods ---------------------------------------------------
def merge_distinct(sketches: DataFrame, keys: Sequence[str | Column],
                   lg: int = DISTINCT_LG) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def distinct_count(sketch: str | Column = "sketch") -> Column:
    return F.theta_sketch_estimate(sketch)


def cohorts(sketches: DataFrame, period: str, lg: int = DISTINCT_LG) -> DataFrame:
    """``period, sketch, cohort``: ``cohort`` holds the items first seen in the
    period, its sketch less the union of all earlier ones.  One row per period,
    so the running union touches as many rows as there are periods."""
    earlier = F.theta_union_agg("sketch", lg).over(
        Window.orderBy(period).rowsBetween(Window.unboundedPreceding, -1))
    s = sketches.withColumn("__earlier", earlier)
    return s.select(period, "sketch", F.when(
        F.col("__earlier").isNull(), F.col("sketch")).otherwise(
        F.theta_difference("sketch", "__earlier")).alias("cohort"))


def retention(sketches: DataFrame, period: str, step_days: int = 7,
              lg: int = DISTINCT_LG) -> DataFrame:
    """``cohort, offset, users``: items of each first-seen period that are back
    ``offset`` periods later, by intersecting stored sketches.  Pairs without a
    common item are left out."""
    c = cohorts(sketches, period, lg)
    span = F.floor(F.datediff(F.max(period).over(Window.partitionBy()), F.col(period))
                   / step_days).cast("int")
    pairs = (c.withColumn("__span", span)
             .select(F.col(period).alias("cohort"), F.col("cohort").alias("__c"),
                     F.explode(F.sequence(F.lit(0), F.col("__span"))).alias("offset"))
             .withColumn("__at", F.date_add("cohort", F.col("offset") * step_days)))
    later = c.select(F.col(period).alias("__p"), F.col("sketch").alias("__s"))
    users = F.theta_sketch_estimate(F.theta_intersection("__c", "__s"))
    return (pairs.join(later, F.col("__at") == F.col("__p"))
            .select("cohort", "offset", users.alias("users")).filter(F.col("users") > 0))
