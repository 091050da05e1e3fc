"""Aggregations (AGG-*), sorting and top-k (SRT-*), set operations (SET-*).

Every grouped aggregate here is a built-in ``groupBy().agg()`` so Spark plans
a partial (map-side) aggregate before the shuffle.  Hot keys are handled by
that partial step for decomposable aggregates; ``salted_sum`` adds an
explicit second level where even the partial output is too concentrated.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions.columns import exact_avg, hash_bucket
from fareflow.session import staged


# AGG-01 / AGG-07 / AGG-02 ------------------------------------------------------
def count_by(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, predicate: Column | None = None, name: str = "n") -> DataFrame:
    """Global row count, optionally of rows satisfying ``predicate``."""
    if predicate is None:
        return df.agg(F.count(F.lit(1)).alias(name))
    return df.agg(F.count_if(predicate).alias(name))


# AGG-06 ------------------------------------------------------------------------
def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, average rounded half-up to one place, and max per group,
    sorted by key.  The average is exact, so a mean of x.x5 always rounds up."""
    return (df.groupBy(key)
              .agg(F.count(F.lit(1)).alias("count"),
                   exact_avg(value, 1).alias("avg_" + value),
                   F.max(value).alias("max_" + value))
              .orderBy(key))


# AGG-08 ------------------------------------------------------------------------
def avg_rounded_desc(df: DataFrame, key: str, value: str, digits: int = 2,
                     name: str = "avg_price") -> DataFrame:
    """Average per key rounded half-up to ``digits`` (exact), highest first."""
    return (df.groupBy(key).agg(exact_avg(value, digits).alias(name))
              .orderBy(F.col(name).desc_nulls_last()))


# AGG-09 ------------------------------------------------------------------------
def non_null_counts(df: DataFrame) -> DataFrame:
    """One row: non-NULL count of every column (the polars ``count()``, S16)."""
    return df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


# AGG-10 / AGG-11 / AGG-19 / AGG-22 ----------------------------------------------
def max_per_day(df: DataFrame, ts: str, value: str) -> DataFrame:
    return (df.groupBy(F.to_date(ts).alias("day"))
              .agg(F.max(value).alias(value))
              .orderBy(value))


def sum_by(df: DataFrame, key: str | Column, value: str, name: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name or value))


def by_hour(df: DataFrame, ts: str, value: str) -> DataFrame:
    return (df.groupBy(F.hour(ts).alias("hour"))
              .agg(F.count(F.lit(1)).alias("trip_count"), F.avg(value).alias("avg_" + value))
              .orderBy("hour"))


# AGG-12 / AGG-13 / AGG-14 / AGG-15 -------------------------------------------------
def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def distinct_count_by(df: DataFrame, key: str | Column, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(value).alias(name))


def distinct_tuple_count(df: DataFrame, cols: Sequence[str]) -> Column:
    """``COUNT(DISTINCT (a, b, …))``: tuples with NULL members still count (S15)."""
    return F.count_distinct(F.struct(*cols))


def global_max(df: DataFrame, value: str):
    """Scalar ``MAX`` (the only driver round trip: one value)."""
    return df.agg(F.max(value)).first()[0]


# AGG-17 / AGG-18 --------------------------------------------------------------------
def salted_sum(df: DataFrame, key: str, value: str, salts: int,
               salt_from: Sequence[str]) -> DataFrame:
    """Two-phase sum: by ``(key, salt)`` first, then by ``key``.

    The salt is a hash of ``salt_from`` (an integer column, not a string
    suffix), so retries are deterministic and no split/parse is needed.
    """
    salt = hash_bucket(salts, *salt_from).alias("__salt")
    phase1 = df.groupBy(key, salt).agg(F.sum(value).alias("__part"))
    return phase1.groupBy(key).agg(F.sum("__part").alias("sum_" + value))


def rebalanced_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """AGG-18: spread rows evenly first, then aggregate.  The ``REBALANCE``
    hint lets AQE size the partitions from the data instead of the cores."""
    return df.hint("rebalance").groupBy(key).agg(F.sum(value).alias("sum_" + value))


# AGG-23 / AGG-24 -------------------------------------------------------------------
def exact_percentile(df: DataFrame, group: str, value: str, p: float,
                     name: str = "p") -> DataFrame:
    """Exact ``p``-quantile per group with linear interpolation (``quantile_cont``).

    Distinct values are counted (a partial aggregate), range-partitioned by
    (group, value) and written once, each row with the number of its
    partition.  A group's rank before a partition is the sum of the earlier
    partitions' counts, so ranks inside a partition need its rows alone, and a
    group of any size spreads over as many partitions as it has values for.
    NULL values are ignored; a group without values gives NULL.
    """
    spark = df.sparkSession
    g, v, part = "__g", "__v", "__part"
    rows = df.select(F.col(group).alias(g), F.col(value).cast("double").alias(v))
    counts = (rows.groupBy(g, v).agg(F.count(F.lit(1)).alias("c"))
              .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), g, v)
              .withColumn(part, F.spark_partition_id()))
    counts = staged(counts, "percentile-counts")
    known = F.when(F.col(v).isNotNull(), F.col("c")).otherwise(F.lit(0))
    # One row per group and partition.
    blocks = counts.groupBy(g, part).agg(F.sum(known).alias("n"))
    before = Window.partitionBy(g).orderBy(part)
    blocks = (blocks.withColumn("before", F.sum("n").over(before) - F.col("n"))
              .withColumn("total", F.sum("n").over(Window.partitionBy(g))))
    pos = F.lit(p) * (F.col("total") - 1)
    blocks = blocks.select(F.col(g).alias("__bg"), F.col(part).alias("__bp"), "before", "n",
                           F.floor(pos).alias("k"), (pos - F.floor(pos)).alias("frac"))
    # Rows of the partitions that hold rank k or k + 1, and one of each group.
    near = blocks.filter((F.col("before") <= F.col("k") + 1) & (F.col("before") + F.col("n") >= F.col("k")))
    held = counts.join(near, (F.col(part) == F.col("__bp")) & F.col(g).eqNullSafe(F.col("__bg")))
    upto = F.sum(known).over(Window.partitionBy(g, part).orderBy(v)) + F.col("before")
    ranked = held.withColumn("upto", upto).filter(F.col(v).isNotNull() | (F.col("n") == 0))
    at_k = F.min(F.when(F.col("upto") > F.col("k"), F.col(v)))
    at_next = F.min(F.when(F.col("upto") > F.col("k") + 1, F.col(v)))
    out = ranked.groupBy(g).agg(at_k.alias("a"), F.coalesce(at_next, at_k).alias("b"),
                                F.first("frac").alias("frac"))
    return out.select(F.col(g).alias(group),
                      (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias(name))


def rate(predicate: Column) -> Column:
    return F.avg(F.when(predicate, F.lit(1.0)).otherwise(F.lit(0.0)))


# AGG-25 ------------------------------------------------------------------------------
def replay_state(events: DataFrame, key: str, seq: str, state: str) -> DataFrame:
    """Current state per key from an event log: the state of the latest
    event (``max_by`` on the sequence), the number of events and the last
    sequence value.  All three are partial aggregates, so a key with many
    events is combined map-side instead of being collected.
    """
    return (events.groupBy(key)
                  .agg(F.max_by(state, seq).alias("current_" + state),
                       F.count(F.lit(1)).alias("event_count"),
                       F.max(seq).alias("last_" + seq)))


# AGG-16 ------------------------------------------------------------------------------
QUERY_BLOCK, STORE_BLOCK = 1024, 16_384


def top_k_similar(store: DataFrame, queries: DataFrame, k: int, store_id: str, store_vec: str,
                  query_id: str, query_vec: str, query_block: int = QUERY_BLOCK,
                  store_block: int = STORE_BLOCK) -> DataFrame:
    """Top-``k`` store vectors by cosine similarity for every query vector.

    Vectors are scaled to length one first.  Queries and store are dealt into
    blocks of bounded size, each pair of blocks is one matrix product, and a
    pair returns at most ``k`` rows per query; the final top-k merges those.
    Any number of queries is taken.  NULL, empty and zero vectors are not
    scored.  Candidates rank by the score to twelve decimals (scores nearer
    than that are ties of rounding and go by the smaller id); the returned
    score has six.
    """
    def unit(df: DataFrame, id_: str, vec: str) -> DataFrame:
        v = F.transform(F.col(vec), lambda x: x.cast("double"))
        norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: a + x * x))
        return (df.select(F.col(id_).alias("id"), v.alias("v")).filter(F.size("v") > 0)
                .withColumn("n", norm).filter(F.col("n") > 0)
                .select("id", F.transform("v", lambda x: x / F.col("n")).alias("v")))

    q, s = unit(queries, query_id, query_vec), unit(store, store_id, store_vec)
    # Two counts size the grid of blocks; nothing else depends on them.
    rows = max(1, -(-q.count() // query_block))
    cols = max(1, -(-s.count() // store_block))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    q = q.withColumn("r", deal(rows)).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    s = s.withColumn("c", deal(cols)).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    qt, st = q.schema["id"].dataType.simpleString(), s.schema["id"].dataType.simpleString()

    def block(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": a["id"][:0], "doc_id": b["id"][:0],
                                 "score": np.zeros(0)})
        b = b.sort_values("id", kind="stable")
        score = np.round(np.stack(a["v"]) @ np.stack(b["v"]).T, 12)
        # Stable on the id order, so equal scores keep the smaller id.
        top = np.argsort(-score, axis=1, kind="stable")[:, :k]
        return pd.DataFrame({
            "query_id": a["id"].repeat(top.shape[1]).to_numpy(),
            "doc_id": b["id"].to_numpy()[top.ravel()],
            "score": np.take_along_axis(score, top, axis=1).ravel()})

    scored = q.groupBy("r", "c").cogroup(s.groupBy("r", "c")).applyInPandas(
        block, f"query_id {qt}, doc_id {st}, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint"))
                  .filter(F.col("rank") <= k).withColumn("score", F.round("score", 6)))


# SRT-* ---------------------------------------------------------------------------------
def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Top-``n`` by an explicit total order (S17: NULLs last when descending)."""
    return df.orderBy(*order).limit(n)


def empty_like(df: DataFrame) -> DataFrame:
    """SRT-05: same schema, no rows."""
    return df.limit(0)


# SET-* ---------------------------------------------------------------------------------
def union_all(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def only_in_each(left: DataFrame, right: DataFrame) -> DataFrame:
    """SET-05: rows in one side only, with multiplicity, tagged by side.

    Both sides are read once: rows count +1 or -1, one grouped sum leaves the
    surplus of either side, and each surplus row is repeated that often.
    """
    cols = left.columns
    n = F.sum("__n")
    signed = (left.withColumn("__n", F.lit(1))
              .unionByName(right.select(*cols).withColumn("__n", F.lit(-1))))
    over = signed.groupBy(*cols).agg(n.alias("__n")).filter(F.col("__n") != 0)
    side = F.when(F.col("__n") > 0, F.lit("left_only")).otherwise(F.lit("right_only"))
    return (over.withColumn("side", side)
            .withColumn("__n", F.explode(F.array_repeat(F.lit(1), F.abs("__n").cast("int"))))
            .drop("__n"))
