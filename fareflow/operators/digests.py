"""Comparison of two tables by digests (SET-05, JON-20, LOAD-11).

A table's rows are dealt into ``FANOUT`` buckets by their hash, and each bucket
into ``FANOUT`` smaller ones.  A bucket's digest does not depend on the order of
its rows: their number, the xor of one hash and the sum of another.  Only rows
of buckets whose digests differ on both levels are compared with one another, so
two tables that agree shuffle digests alone (partial aggregates, at most
``FANOUT`` rows a task), and digests kept from an earlier run spare reading that
table for the first level.

Defined results: rows count as often as they occur; NULL equals NULL, NaN equals
NaN and -0.0 equals 0.0; the columns of the right table are taken in the left
one's order; empty tables have no digests.  Maps and variants cannot be compared
and are refused.  Equal digests of unequal buckets need both 64-bit hashes to
agree in sum, about 2 ** -128 for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.session import staged

FANOUT_BITS = 12
FANOUT = 1 << FANOUT_BITS
PARTS = ("n", "mixed", "low", "high")


def _checked(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if "map<" in kind or "variant" in kind:
            raise ValueError(f"column {f.name} of type {kind} cannot be compared")
    return df


def _hashable(df: DataFrame) -> list[Column]:
    """Columns to hash: Spark's hashes pass over NULLs, so each gets a flag beside
    it, and nested values are written out."""
    out = []
    for f in df.schema.fields:
        c = df[f"`{f.name}`"]
        nested = isinstance(f.dataType, T.ArrayType | T.StructType)
        out += [F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}) if nested else c,
                c.isNull()]
    return out


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a whole row."""
    cols = _hashable(_checked(df))
    return F.xxhash64(F.lit(1), *cols), F.xxhash64(F.lit(2), *cols)


def _bucket(h: Column, level: int) -> Column:
    return F.shiftrightunsigned(h, FANOUT_BITS * level).bitwiseAND(F.lit(FANOUT - 1)).cast("int")


def digests(df: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """``bucket`` and its digest; with ``within`` (first-level buckets, at most
    ``FANOUT``) the second-level buckets inside those: ``bucket, part``."""
    a, b = row_hashes(df)
    rows = df.select(a.alias("a"), b.alias("b")).withColumn("bucket", _bucket(F.col("a"), 0))
    keys = ["bucket"]
    if within is not None:
        rows = rows.join(F.broadcast(within), "bucket", "left_semi").withColumn("part", _bucket(F.col("a"), 1))
        keys.append("part")
    low = F.col("b").bitwiseAND(F.lit((1 << 32) - 1))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("mixed"), F.sum(low).alias("low"),
        F.sum(F.shiftright("b", 32)).alias("high"))


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """The buckets whose digests differ or that one side lacks."""
    keys = [c for c in left.columns if c not in PARTS]
    both = left.unionByName(right)
    same = [F.min(p) == F.max(p) for p in PARTS]
    agree = F.count(F.lit(1)) == 2
    for s in same:
        agree = agree & s
    return both.groupBy(*keys).agg(agree.alias("__agree")).filter("NOT __agree").drop("__agree")


def _of_buckets(df: DataFrame, buckets: DataFrame, parts: DataFrame) -> DataFrame:
    a, _ = row_hashes(df)
    rows = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), a.alias("a"))
    rows = rows.withColumn("bucket", _bucket(F.col("a"), 0)).withColumn("part", _bucket(F.col("a"), 1))
    return (rows.join(F.broadcast(buckets), "bucket", "left_semi")
            .join(parts, ["bucket", "part"], "left_semi").select("row"))


def compare_tables(left: DataFrame, right: DataFrame, left_digests: DataFrame | None = None,
                   right_digests: DataFrame | None = None) -> DataFrame:
    """The rows that one table has more often than the other, with ``left_rows``
    and ``right_rows``.  Digests of an earlier run may be passed for either side;
    they must be of the table as it is now."""
    spark = left.sparkSession
    right = right.select(*[right[f"`{c}`"] for c in left.columns])
    if [f.dataType for f in left.schema] != [f.dataType for f in right.schema]:
        raise ValueError("the tables' column types differ")
    out = T.StructType([*left.schema.fields, T.StructField("left_rows", T.LongType()),
                        T.StructField("right_rows", T.LongType())])
    buckets = staged(differing(left_digests if left_digests is not None else digests(left),
                               right_digests if right_digests is not None else digests(right)), "differing")
    if buckets.isEmpty():
        return spark.createDataFrame([], out)
    parts = staged(differing(digests(left, buckets), digests(right, buckets)), "differing-parts")
    sides = [_of_buckets(df, buckets, parts).withColumn("side", F.lit(s)) for s, df in enumerate((left, right))]
    counts = sides[0].unionByName(sides[1]).groupBy("row").agg(
        F.count_if(F.col("side") == 0).alias("left_rows"), F.count_if(F.col("side") == 1).alias("right_rows"))
    return (counts.filter("left_rows <> right_rows")
            .select(*[F.col("row")[c].alias(c) for c in left.columns], "left_rows", "right_rows"))
