"""Join operators (JON-*).

* Which side is broadcast is left to the planner: Spark's byte threshold and
  AQE decide from real sizes.  Building a join starts no job.  Only
  ``hinted_join`` forces a strategy, and its broadcast form is for tables that
  are small by definition (zones, the payment seed).
* Skew is handled without randomness: salts are hashes of stable row
  content, so a recomputed task after executor loss yields the same rows.
* No cross joins.  Range joins are equi-joins on time buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.columns import floor_div, hash_bucket


# JON-01 / JON-03 / JON-05 / JON-06 / JON-18 ------------------------------------
def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str | Column, dim_key: str,
                how: str = "left") -> DataFrame:
    """Equi-join a fact to a lookup on possibly differently named keys.

    ``fact_key`` may be an expression (JON-05: ``coalesce(payment_type, 0)``).
    """
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    return fact.join(dim, fk == dim[dim_key], how)


def role_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              columns: dict[str, str], how: str = "left") -> DataFrame:
    """Join one role of a dimension (JON-02/04): project and rename its columns.

    ``columns`` maps dimension column → output name, e.g.
    ``{"borough": "pickup_borough", "zone": "pickup_zone"}``.
    """
    key_alias = f"__{fact_key}__{dim_key}"
    d = dim.select(F.col(dim_key).alias(key_alias),
                   *[F.col(k).alias(v) for k, v in columns.items()])
    return fact.join(d, fact[fact_key] == d[key_alias], how).drop(key_alias)


# JON-07 / JON-08 / JON-09 -------------------------------------------------------
def hinted_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                strategy: str = "broadcast") -> DataFrame:
    """Join with an explicit strategy hint on the right side.

    ``strategy`` is one of ``broadcast`` (for a right side that is small by
    definition), ``merge``, ``shuffle_hash``, ``shuffle_replicate_nl``.
    """
    return left.join(right.hint(strategy), on, how)


# JON-10 -------------------------------------------------------------------------
def range_join(events: DataFrame, ranges: DataFrame, ts: str, start: str, end: str,
               bucket_seconds: int = 86_400) -> DataFrame:
    """Attach each event to every half-open range ``[start, end)`` containing it.

    Each range is expanded to the time buckets it overlaps and both sides are
    equi-joined on the bucket, then the exact predicate is applied; cost grows
    with range length / bucket size, not with the product of the two tables.
    Bucket numbers are integer microseconds, so a row exactly on a bucket or
    range bound cannot move.

    The pairs are the work, not the bytes of the tables: a table of few small
    files, broadcast or not, would leave all pairs to as many tasks as it has
    splits.  Both sides are therefore dealt by bucket (a merge join, which
    spills) into ``PAIR_TASKS`` times as many tasks as a shuffle has partitions;
    AQE, which goes by bytes, would melt them into one a core, and a task with
    many ranges groups their pairs slowly.  For the same reason it would not
    notice a bucket of many pairs; narrower buckets part them.  Ranges are the
    streamed side, so that the pairs of a range and bucket follow each other, and
    events meet them in blocks (``event_blocks``): the join tests one row a
    block, and the pairs come from walking the blocks that a range touches.
    """
    bucket, width = "__range_bucket", bucket_seconds * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    r = ranges.filter(F.col(end) > F.col(start)).withColumn(bucket, F.explode(F.sequence(
        floor_div(micros(start), width), floor_div(micros(end) - 1, width))))
    e = event_blocks(events.filter(F.col(ts).isNotNull())
                     .withColumn(bucket, floor_div(micros(ts), width)), bucket, ts)
    tasks = PAIR_TASKS * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (r.repartition(tasks, bucket).alias("__ranges").hint("merge")
           .join(e.repartition(tasks, bucket).alias("__events"), bucket))
    if not isinstance(events.select(ts).schema[0].dataType, T.StringType):  # text may sort otherwise
        met = met.filter((F.col("__first") < F.col(end)) & (F.col("__last") >= F.col(start)))
    at = F.col("__at")
    met = (met.select("__ranges.*", "__events.*", F.posexplode("__ats").alias("__pos", "__at"))
           .filter((at >= F.col(start)) & (at < F.col(end))))
    found = [(at if c == ts else F.col(f"__event{i}")[F.col("__pos")][c]).alias(c)
             for i, c in enumerate(events.columns)]
    return met.select(*found, *[F.col(f"__ranges.`{c}`") for c in ranges.columns])


PAIR_TASKS = 4  # tasks of pairs for each shuffle partition
BLOCK_BITS = 10  # up to 1024 events a block


def event_blocks(events: DataFrame, bucket: str, ts: str) -> DataFrame:
    """The events of each bucket in blocks of at most ``2 ** BLOCK_BITS`` rows along ``ts``.

    A block has its ``__first`` and ``__last`` time, all times in order
    (``__ats``) and for each other column a list ``__event<i>`` in the same
    order; lists that nobody reads are not built.  The split an event comes from
    is part of the key, so several tasks sort the events of a busy bucket.
    Equal times may change blocks when a task runs again, but each task keeps
    its events, so no pair is lost or doubled.
    """
    lists = [F.collect_list(F.struct(f"`{c}`")).alias(f"__event{i}")
             for i, c in enumerate(events.columns) if c not in (bucket, ts)]
    key = [bucket, "__dealt"]
    return (events.withColumn("__dealt", F.spark_partition_id() % 16).repartition(*key)
            .sortWithinPartitions(*key, ts)
            .withColumn("__block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS))
            .groupBy(*key, "__block")
            .agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"),
                 F.collect_list(ts).alias("__ats"), *lists).drop("__dealt", "__block"))


def _blocks_between(first: Column, after: Column) -> Column:
    return F.when(after > first, F.sequence(first, after - 1)).otherwise(
        F.array().cast("array<bigint>"))


def _on_level(blocks: Column, level: int) -> Column:
    return F.transform(blocks, lambda b: F.struct(F.lit(level).alias("__level"), b.alias("__block")))


def range_pieces(ranges: DataFrame, start: str, end: str, unit_seconds: int = 1,
                 levels: int = 16) -> DataFrame:
    """``ranges`` with one row per aligned piece: ``__level`` and ``__block``.

    A block of level k is ``4 ** k`` units wide and starts at a multiple of
    its width.  A range is the disjoint union of at most six blocks a level, so
    its rows grow with the logarithm of its length; only ranges longer than a
    block of the last level take more.  Its two outer units are whole.
    Ranges that are empty or have a NULL bound have no pieces.
    """
    width = unit_seconds * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    first, after = floor_div(micros(start), width), floor_div(micros(end) - 1, width) + 1
    found = []
    for k in range(levels):
        # Whole blocks inside the range on this level, and on the next one.
        lo, hi = -F.shiftright(-F.col("__first"), 2 * k), F.shiftright("__after", 2 * k)
        up_lo, up_hi = -F.shiftright(-F.col("__first"), 2 * k + 2), F.shiftright("__after", 2 * k + 2)
        if k == levels - 1:
            blocks = _blocks_between(lo, hi)
        else:
            blocks = F.when(up_lo >= up_hi, _blocks_between(lo, hi)).otherwise(
                F.concat(_blocks_between(lo, up_lo * 4), _blocks_between(up_hi * 4, hi)))
        found.append(_on_level(blocks, k))
    cut = (ranges.filter(F.col(end) > F.col(start))
           .withColumns({"__first": first, "__after": after}))
    return cut.select(*[F.col(f"`{c}`") for c in ranges.columns], F.inline(F.concat(*found)))


def levels_in_use(ranges: DataFrame, start: str, end: str, unit_seconds: int = 1,
                  levels: int = 16) -> list[int]:
    """The levels on which any range has a piece: at most ``levels`` numbers."""
    found = range_pieces(ranges.select(start, end), start, end, unit_seconds, levels)
    return sorted(r[0] for r in found.select("__level").distinct().collect())


def multiscale_range_join(events: DataFrame, ranges: DataFrame, ts: str, start: str, end: str,
                          unit_seconds: int = 1, levels: int = 16,
                          used: Sequence[int] | None = None, salts: int = 8) -> DataFrame:
    """``range_join`` for ranges of very different lengths (seconds to decades).

    Ranges are cut into aligned pieces, an event has one block per level, and
    both are equi-joined on (level, block); pieces of a range are disjoint, so
    a pair meets once, and the exact predicate decides at the bounds.  An event
    becomes one row per level: all ``levels``, or those of ``used`` (see
    ``levels_in_use``).  Wide blocks hold many events, so above level 0 events
    are dealt over ``salts`` by a hash of their row and pieces are repeated.
    The planner's estimate leaves out that a side is multiplied and would send a
    table of small files whole to every executor; both sides are laid out on the
    key first, so AQE broadcasts one only if its real size is small.
    """
    width = unit_seconds * 1_000_000
    at = floor_div(F.unix_micros(F.col(ts).cast("timestamp")), width)
    salt = hash_bucket(salts, *events.columns)
    keys = [F.struct(F.lit(k).alias("__level"), F.shiftright(at, 2 * k).alias("__block"),
                     (salt if k else F.lit(0)).cast("int").alias("__salt"))
            for k in (range(levels) if used is None else used)]
    if not keys:
        keys = [F.struct(F.lit(-1).alias("__level"), at.alias("__block"), F.lit(0).alias("__salt"))]
    e = events.filter(F.col(ts).isNotNull()).select(
        *[F.col(f"`{c}`") for c in events.columns], F.inline(F.array(*keys)))
    r = range_pieces(ranges, start, end, unit_seconds, levels).withColumn("__salt", F.explode(
        F.sequence(F.lit(0), F.when(F.col("__level") > 0, F.lit(salts - 1)).otherwise(F.lit(0)))))
    on = ["__level", "__block", "__salt"]
    return (e.repartition(*on).join(r.repartition(*on), on)
            .filter((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end))).drop(*on))


# JON-12 -------------------------------------------------------------------------
def salted_join(fact: DataFrame, dim: DataFrame, key: str, salts: int,
                salt_from: Sequence[str], how: str = "inner") -> DataFrame:
    """Spread a hot join key over ``salts`` partitions.

    The fact side gets ``salt = hash(salt_from) mod salts`` (deterministic);
    the dimension is replicated once per salt value with ``explode`` (its
    size grows by exactly ``salts``).  Equal to a plain join on ``key`` for
    every ``how`` that keeps no unmatched dimension row; ``right`` and
    ``full`` would repeat those per salt and are rejected.
    """
    if how.lower().replace("_", "") not in ("inner", "left", "leftouter", "leftsemi", "semi",
                                            "leftanti", "anti"):
        raise ValueError(f"salted_join cannot keep unmatched dimension rows (how={how!r})")
    salt = "__salt"
    f = fact.withColumn(salt, hash_bucket(salts, *salt_from))
    d = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return f.join(d, [key, salt], how).drop(salt)


# JON-13 -------------------------------------------------------------------------
def hot_keys(df: DataFrame, key: str, min_share: float) -> list:
    """Non-null keys holding at least ``min_share`` of all rows.

    A frequent-item summary of bounded size names the candidates: it may name
    too many keys, never too few.  Only the candidates are counted, so no pass
    shuffles all keys.  Shares below 0.02 % are beyond the summary and counted
    plainly.  At most ``1 / min_share`` keys can qualify, so the collected list
    has a proven bound.  NULL never matches in an equi-join, so it is never hot.
    """
    rows = df.select(F.col(key).alias("key"))
    known = rows.filter(F.col("key").isNotNull())
    support = min_share / 2
    if support >= 1e-4:
        named = known.freqItems(["key"], support).first()[0] or []
        known = known.filter(F.col("key").isin(list(named)))
    total = rows.select(F.count(F.lit(1))).scalar()
    counts = known.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return [r["key"] for r in counts.filter(F.col("n") >= total * F.lit(min_share))
            .select("key").collect()]


def split_hot_join(fact: DataFrame, dim: DataFrame, key: str, hot: Sequence,
                   how: str = "inner", salts: int = 16,
                   salt_from: Sequence[str] | None = None) -> DataFrame:
    """Join the rows of hot keys salted, all others (NULL keys too) plainly.

    Equal to ``fact.join(dim, key, how)`` for the kinds ``salted_join`` takes.
    ``salt_from`` defaults to all fact columns.
    """
    keys = [k for k in hot if k is not None]
    if not keys:
        return fact.join(dim, key, how)
    is_hot = F.coalesce(F.col(key).isin(keys), F.lit(False))
    hot_part = salted_join(fact.filter(is_hot), dim.filter(is_hot), key, salts,
                           list(salt_from or fact.columns), how)
    return hot_part.unionByName(fact.filter(~is_hot).join(dim.filter(~is_hot), key, how))


# JON-15 -------------------------------------------------------------------------
def copartitioned_join(left: DataFrame, right: DataFrame, key: str | Sequence[str],
                       partitions: int | None = None, how: str = "inner") -> DataFrame:
    """Hash-partition both sides on the key once; the join adds no exchange.

    Without ``partitions`` the shuffle's own count is used and AQE may still
    coalesce or split partitions; a fixed number switches that off.
    """
    keys = [key] if isinstance(key, str) else list(key)
    n = [] if partitions is None else [partitions]
    return left.repartition(*n, *keys).join(right.repartition(*n, *keys), keys, how)


# JON-14 -------------------------------------------------------------------------
def write_bucketed(df: DataFrame, table_name: str, key: str, buckets: int,
                   path: str | None = None) -> None:
    """Persist ``df`` as a bucketed, sorted table so later joins skip the shuffle."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table_name)


def bucketed_join(spark, left_table: str, right_table: str, key: str,
                  how: str = "inner") -> DataFrame:
    return spark.table(left_table).join(spark.table(right_table), key, how)


# JON-16 / JON-17 ------------------------------------------------------------------
def filter_then_join(fact: DataFrame, dim: DataFrame, predicate: Column, on,
                     how: str = "inner") -> DataFrame:
    return fact.filter(predicate).join(dim, on, how)


def aggregate_then_join(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Count per key, then join the dimension."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.join(dim, key, "left")


# JON-20 ---------------------------------------------------------------------------
def full_compare(old: DataFrame, new: DataFrame, key: Sequence[str],
                 compare: Sequence[str]) -> DataFrame:
    """Full outer join of two snapshots with a change label per key.

    ``change`` is ``added``, ``removed``, ``changed`` or ``same``.
    """
    o = old.select(*key, *[F.col(c).alias(f"old_{c}") for c in compare])
    n = new.select(*key, *[F.col(c).alias(f"new_{c}") for c in compare])
    j = o.withColumn("__o", F.lit(True)).join(n.withColumn("__n", F.lit(True)), list(key), "full")
    differs = None
    for c in compare:
        d = ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        differs = d if differs is None else (differs | d)
    change = (F.when(F.col("__o").isNull(), F.lit("added"))
               .when(F.col("__n").isNull(), F.lit("removed"))
               .when(differs, F.lit("changed"))
               .otherwise(F.lit("same")))
    return j.withColumn("change", change).drop("__o", "__n")
