"""Data-quality checks (DQ-*).

All column checks of one table are evaluated in a single ``agg`` pass (one
conditional count per check) and unpivoted into a result table
``(check_name, column_name, failures, status)``.  ``unique`` needs a grouped count and
custom checks are scalar queries; each adds one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared check.

    ``kind``: ``not_null``, ``positive``, ``non_negative``, ``accepted_values``
    (``values``), ``between`` (``low``/``high``), ``unique``.
    """
    kind: str
    column: str
    values: tuple = field(default_factory=tuple)
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return self.kind


def _failing(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "positive":
        return c <= 0
    if check.kind == "non_negative":
        return c < 0
    if check.kind == "accepted_values":
        return ~c.isin(list(check.values))
    if check.kind == "between":
        return (c < check.low) | (c > check.high)
    raise ValueError(check.kind)


def run_checks(df: DataFrame, checks: Sequence[Check],
               extra: Sequence[tuple[str, str | None, Column]] = ()) -> DataFrame:
    """Evaluate checks → ``check_name, column_name, failures (bigint), status``.

    NULLs are not failures for value checks (only ``not_null`` sees them);
    ``unique`` ignores NULL keys and counts rows in duplicated groups.
    ``extra`` holds ``(check_name, column_name, aggregate)`` custom checks
    whose aggregate yields the failure count; they are computed in the same
    single pass as the column checks.
    """
    simple = [c for c in checks if c.kind != "unique"]
    parts: list[DataFrame] = []
    specs = [(c.name, c.column, F.count_if(F.coalesce(_failing(c), F.lit(False)))) for c in simple]
    specs += list(extra)
    if specs:
        one = df.agg(*[a.cast("bigint").alias(f"c{i}") for i, (_, _, a) in enumerate(specs)])
        stack = ", ".join(f"'{n}', {'NULL' if col is None else repr(col)}, c{i}"
                          for i, (n, col, _) in enumerate(specs))
        parts.append(one.selectExpr(f"stack({len(specs)}, {stack}) AS (check_name, column_name, failures)"))
    for c in checks:
        if c.kind == "unique":
            dup = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column)
                     .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
            parts.append(dup.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
                            .select(F.lit("unique").alias("check_name"), F.lit(c.column).alias("column_name"),
                                    "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_status(out)


def with_status(results: DataFrame) -> DataFrame:
    return results.select("check_name", "column_name", F.col("failures").cast("bigint").alias("failures"),
                          F.when(F.col("failures") == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
                           .alias("status"))


def custom_check(spark, name: str, sql_text: str, expected) -> DataFrame:
    """DQ-06: a scalar SQL query compared with an expected value.

    Booleans are compared as integers, as the reference's engine does."""
    v = spark.sql(sql_text)
    col = F.col(v.columns[0])
    if str(v.schema[0].dataType) == "BooleanType()":
        col = col.cast("int")
    return v.select(F.lit(name).alias("check_name"), F.lit(None).cast("string").alias("column_name"),
                    F.when(col == F.lit(expected), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
                     .alias("failures")).transform(with_status)


def duplicate_count(df: DataFrame, cols: Sequence[str], name: str,
                    where: Column | None = None) -> DataFrame:
    """DQ-07: rows beyond the first of each ``cols`` group, as a check result.

    Grouping on the key reuses a partitioning the table already has (after a
    de-duplication on it) and never holds the distinct tuples in one task.
    NULL members count as values.
    """
    rows = df if where is None else df.filter(where)
    per_key = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return with_status(per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failures"))
                       .select(F.lit(name).alias("check_name"),
                               F.lit(None).cast("string").alias("column_name"), "failures"))


def row_count_check(low: int, high: int) -> tuple[str, None, Column]:
    """DQ-09 as an ``extra`` aggregate for ``run_checks`` (same pass)."""
    n = F.count(F.lit(1))
    return ("row_count_between", None, F.when((n >= low) & (n <= high), F.lit(0)).otherwise(F.lit(1)))


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    """DQ-09 on its own."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit("row_count_between").alias("check_name"), F.lit(None).cast("string").alias("column_name"),
                    F.when((F.col("n") >= low) & (F.col("n") <= high), F.lit(0)).otherwise(F.lit(1))
                     .cast("bigint").alias("failures")).transform(with_status)


def dead_letter_split(df: DataFrame, rules: Sequence[tuple[str, Column]]
                      ) -> tuple[DataFrame, DataFrame]:
    """DQ-10: rows passing every rule, and rejected rows with the first
    failing rule's name in ``reject_reason``.  One pass computes the reason;
    both outputs read it."""
    reason = None
    for name, ok in rules:
        cond = ~F.coalesce(ok, F.lit(False))
        reason = (F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name)))
    tagged = df.withColumn("reject_reason", reason)
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = tagged.filter(F.col("reject_reason").isNotNull())
    return good, bad
