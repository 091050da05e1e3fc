"""Period metrics over event logs (AGG-26, AGG-28)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions.columns import exact_avg, exact_ratio
from fareflow.operators.aggregates import exact_percentile


def week_start(ts: str) -> F.Column:
    """Monday of the timestamp's week, as a DATE (zone-free)."""
    d = F.to_date(ts)
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


def weekly_retention(events: DataFrame, user: str, ts: str) -> DataFrame:
    """Active users per (first-seen week, weeks since).

    ``(user, week)`` pairs are de-duplicated first (map-side), so the later
    join and count touch one row per active user-week, not per event.
    """
    uw = events.select(F.col(user).alias("u"), week_start(ts).alias("wk")).distinct()
    first = uw.groupBy("u").agg(F.min("wk").alias("cohort_week"))
    j = uw.join(first, "u")
    return (j.groupBy("cohort_week",
                      (F.datediff("wk", "cohort_week") / 7).cast("int").alias("week_offset"))
             .agg(F.count(F.lit(1)).alias("users")))


def _with_previous(daily: DataFrame, day: str, value: str) -> DataFrame:
    """``daily`` with ``__prev``: ``value`` of the latest earlier day."""
    month = F.trunc(day, "month")
    by_month = Window.partitionBy("__m").orderBy(day)
    d = daily.withColumn("__m", month).withColumn("__in", F.lag(value).over(by_month))
    last = d.groupBy("__m").agg(F.max_by(value, day).alias("__last"))
    by_year = Window.partitionBy(F.year("__m")).orderBy("__m")
    last = last.withColumn("__before", F.lag("__last").over(by_year))
    # The first month of a year takes the last month of the years before it.
    years = last.groupBy(F.year("__m").alias("__y")).agg(F.max_by("__last", "__m").alias("__ylast"))
    prev_year = years.withColumn("__before_year", F.lag("__ylast").over(Window.orderBy("__y")))
    last = (last.withColumn("__y", F.year("__m"))
            .join(prev_year.select("__y", "__before_year"), "__y")
            .select("__m", F.coalesce("__before", "__before_year").alias("__month_before")))
    return (d.join(last, "__m").withColumn("__prev", F.coalesce("__in", "__month_before"))
            .drop("__m", "__in", "__month_before"))


def run_metrics(runs: DataFrame, day: str, duration: str, rows: str, failed: str) -> DataFrame:
    """AGG-26: per-day average and p99 duration, error rate, and row-count
    drift against the previous day (flagged outside ±5 %).

    Averages and ratios are rounded exactly (integer arithmetic) to six
    places; the drift flag compares integers.  The previous day is the latest
    earlier day with runs: each month's days are ranked among themselves and
    the first day of a month looks at the last of the month before it, so no
    window holds all days."""
    daily = runs.groupBy(day).agg(
        exact_avg(duration, 6).alias("avg_duration"),
        F.sum(rows).alias("rows"),
        F.count_if(F.col(failed)).alias("__failed"),
        F.count(F.lit(1)).alias("__runs"))
    daily = daily.join(exact_percentile(runs, day, duration, 0.99, "p99_duration"), day)
    return (_with_previous(daily, day, "rows")
                 .withColumn("error_rate", exact_ratio("__failed", "__runs"))
                 .withColumn("row_drift", exact_ratio(F.col("rows") - F.col("__prev"), F.col("__prev")))
                 .withColumn("drift_alert", F.abs(F.col("rows") - F.col("__prev")) * 100 > F.col("__prev") * 5)
                 .drop("__failed", "__runs", "__prev"))
