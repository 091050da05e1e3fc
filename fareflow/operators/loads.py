"""Incremental load patterns (LOAD-*) without a transactional table format.

Each pattern has two halves:

* a pure rewrite ``(target, source) → new target`` that is plain DataFrame
  algebra (anti-join + union, filters, full outer join), so it can be
  checked against SQL and composed lazily;
* a writer that materialises the result into a *new* directory under the
  same parent and then swaps it in.  The directory being read is never
  overwritten while it is an input of the plan (Spark would read a
  half-deleted table).  A failed rename puts the old table back; a crash
  between the two renames leaves it under a fixed sibling name, from which
  the next read or write through this module restores it.

Date-partitioned targets are rewritten partition by partition: only the
partitions inside the replaced range are touched (dynamic overwrite), and
range partitions that receive no new rows are deleted explicitly (S12).
A rerun after a crash brings the range to the same state.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.windows import keep_first
from fareflow.session import delete_path, path_exists, rename_path, touch


# ---------------------------------------------------------------- rewrites
def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LOAD-03 / LOAD-05: matched keys take the source rows, new keys are
    inserted, untouched target rows stay.  Duplicate source rows per key are
    all kept (delete+insert semantics); de-duplicate the source first with
    ``keep_first`` when a strict merge is wanted."""
    keys = list(keys)
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def merge_latest(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order: str) -> DataFrame:
    """Upsert after keeping only the latest source row per key."""
    return upsert(target, keep_first(source, keys, [order], descending=True), keys)


def in_range(ts: str, start: str, end: str) -> Column:
    return ((F.col(ts) >= F.lit(start).cast(_ts_type_of(start)))
            & (F.col(ts) < F.lit(end).cast(_ts_type_of(end))))


def _ts_type_of(v: str) -> str:
    return "date" if len(v) == 10 else "timestamp_ntz"


def check_day_aligned(start: str, end: str) -> None:
    """S12: a date-grained target only accepts whole-day bounds."""
    for v in (start, end):
        t = dt.datetime.fromisoformat(v)
        if (t.hour, t.minute, t.second, t.microsecond) != (0, 0, 0, 0):
            raise ValueError(f"bound {v!r} is not day-aligned for a date-grained key")


def replace_interval(target: DataFrame, new: DataFrame, ts: str, start: str, end: str,
                     date_grain: bool = False) -> DataFrame:
    """LOAD-04 ``time_interval``: delete ``[start, end)`` then insert the new
    rows of that range.  Days of the range without new rows end up empty."""
    if date_grain:
        check_day_aligned(start, end)
        start, end = start[:10], end[:10]
    keep = target.filter(~in_range(ts, start, end) | F.col(ts).isNull())
    return keep.unionByName(new.filter(in_range(ts, start, end)).select(*target.columns))


def insert_only_merge(target: DataFrame, source: DataFrame, id_col: str) -> DataFrame:
    """LOAD-06: rows of ``source`` whose id is not in ``target`` (all of them,
    duplicates inside the batch included — S7)."""
    return source.join(target.select(id_col), id_col, "left_anti")


def merged_target(target: DataFrame, source: DataFrame, id_col: str) -> DataFrame:
    return target.unionByName(insert_only_merge(target, source, id_col).select(*target.columns))


def high_water_mark(target: DataFrame | None, source: DataFrame, col: str) -> DataFrame:
    """LOAD-09: source rows newer than the newest row already loaded.

    The maximum is a scalar subquery evaluated inside the same plan; an
    empty or absent target admits every row (first run)."""
    if target is None:
        return source
    mark = target.select(F.max(col)).scalar()
    return source.filter(mark.isNull() | (F.col(col) > mark))


def scd2(history: DataFrame | None, snapshot: DataFrame, key: Sequence[str], updated_at: str,
         tracked: Sequence[str], valid_from: str = "valid_from",
         valid_to: str = "valid_to") -> DataFrame:
    """LOAD-11 snapshot (SCD type 2).

    A key changes when any ``tracked`` column differs from its open row
    (the "check" strategy; pass the ``updated_at`` column in ``tracked`` for
    the timestamp strategy).  Open rows (``valid_to`` NULL) that changed are
    closed at the snapshot's ``updated_at``; changed and new
    keys open a row.  Keys missing from the snapshot stay open (hard
    deletes are not invalidated).  Closed history passes through untouched.
    """
    key = list(key)
    cols = snapshot.columns
    opened_new = (snapshot.withColumn(valid_from, F.col(updated_at))
                          .withColumn(valid_to, F.lit(None).cast(snapshot.schema[updated_at].dataType)))
    if history is None:
        return opened_new
    closed_hist = history.filter(F.col(valid_to).isNotNull())
    current = history.filter(F.col(valid_to).isNull())
    cur = current.select(*key, *[F.col(c).alias(f"__cur_{c}") for c in cols if c not in key],
                         F.col(valid_from).alias("__cur_vf"))
    snap = snapshot.select(*key, *[F.col(c).alias(f"__new_{c}") for c in cols if c not in key],
                           F.lit(True).alias("__in_snap"))
    j = cur.join(snap, key, "full")
    changed = None
    for c in tracked:
        d = ~F.col(f"__cur_{c}").eqNullSafe(F.col(f"__new_{c}"))
        changed = d if changed is None else (changed | d)
    has_cur = F.col("__cur_vf").isNotNull()
    in_snap = F.col("__in_snap").isNotNull()
    j = j.withColumn("__changed", in_snap & (~has_cur | changed))
    other = [c for c in cols if c not in key]
    still_open = j.filter(has_cur & ~F.col("__changed")).select(
        *key, *[F.col(f"__cur_{c}").alias(c) for c in other],
        F.col("__cur_vf").alias(valid_from), F.lit(None).cast(snapshot.schema[updated_at].dataType).alias(valid_to))
    closing = j.filter(has_cur & F.col("__changed")).select(
        *key, *[F.col(f"__cur_{c}").alias(c) for c in other],
        F.col("__cur_vf").alias(valid_from), F.col(f"__new_{updated_at}").alias(valid_to))
    opening = j.filter(F.col("__changed")).select(
        *key, *[F.col(f"__new_{c}").alias(c) for c in other],
        F.col(f"__new_{updated_at}").alias(valid_from),
        F.lit(None).cast(snapshot.schema[updated_at].dataType).alias(valid_to))
    out_cols = cols + [valid_from, valid_to]
    return (closed_hist.select(*out_cols)
            .unionByName(still_open.select(*out_cols))
            .unionByName(closing.select(*out_cols))
            .unionByName(opening.select(*out_cols)))


# ---------------------------------------------------------------- writers
def _sibling(path: str, tag: str) -> str:
    return f"{path.rstrip('/')}.{tag}"


def recover_swap(spark: SparkSession, path: str) -> None:
    """Finish an interrupted swap: restore the old table, or drop it if replaced."""
    old = _sibling(path, "old")
    if path_exists(spark, old):
        if path_exists(spark, path):
            delete_path(spark, old)
        elif not rename_path(spark, old, path):
            raise OSError(f"cannot restore {path} from {old}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Existence of a table written here, after finishing an interrupted swap."""
    recover_swap(spark, path)
    return path_exists(spark, path)


def write_swap(df: DataFrame, path: str, fmt: str = "parquet",
               partition_by: Sequence[str] | None = None, marker: str | None = None) -> str:
    """LOAD-01 full refresh: write beside ``path``, then swap directories.

    ``marker`` names an empty file that becomes part of the new table's folder
    (start it with an underscore, so readers pass over it)."""
    spark = df.sparkSession
    staged = _sibling(path, f"staged-{uuid.uuid4().hex[:10]}")
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staged)
    if marker:
        touch(spark, f"{staged}/{marker}")
    old = _sibling(path, "old")
    had_old = table_exists(spark, path)
    if had_old and not rename_path(spark, path, old):
        raise OSError(f"cannot move {path} aside; the new table is in {staged}")
    if not rename_path(spark, staged, path):
        if had_old and not rename_path(spark, old, path):
            raise OSError(f"cannot restore {path}; the old table is in {old}")
        raise OSError(f"cannot move {staged} to {path}; the old table is in place")
    if had_old:
        delete_path(spark, old)
    return path


def append(df: DataFrame, path: str, fmt: str = "parquet",
           partition_by: Sequence[str] | None = None) -> None:
    """LOAD-02 / SNK-06."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def replace_then_append(spark: SparkSession, chunks: Sequence[DataFrame], path: str) -> None:
    """LOAD-07: create the (empty) table from the first chunk's schema, then
    append every chunk."""
    write_swap(chunks[0].limit(0), path)
    for c in chunks:
        append(c, path)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 partition_col: str | None = None) -> None:
    """Merge ``source`` into the Parquet table at ``path``.

    Unpartitioned target: rewrite and swap.  With ``partition_col`` (a
    column determined by the key, e.g. a hash bucket of it, so a key never
    moves between partitions) only the partitions present in ``source`` are
    read, merged and replaced by a dynamic partition overwrite; the cost of
    a merge then follows the batch, not the table.
    """
    if not table_exists(spark, path):
        w = source.write
        if partition_col:
            w = w.partitionBy(partition_col)
        w.parquet(path)
        return
    if partition_col is None:
        target = spark.read.parquet(path)
        write_swap(upsert(target, source.select(*target.columns), keys), path)
        return
    # Partition values stay in the plan: the join prunes the target's scan.
    touched = source.select(F.col(partition_col).alias("__touched")).distinct()
    table = spark.read.parquet(path)
    target = table.join(touched, table[partition_col].eqNullSafe(touched["__touched"]), "left_semi")
    merged = upsert(target, source.select(*target.columns), keys).checkpoint(eager=True)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(path))


def insert_only_table(spark: SparkSession, path: str, source: DataFrame, id_col: str) -> int:
    """LOAD-06 / LOAD-13 against a stored table: append only unseen ids.

    The new rows are checkpointed before appending because the anti-join
    reads the very table the append writes into."""
    if not table_exists(spark, path):
        write_swap(source, path)
        return spark.read.parquet(path).count()
    target = spark.read.parquet(path)
    fresh = insert_only_merge(target, source.select(*target.columns), id_col).checkpoint(eager=True)
    n = fresh.count()
    append(fresh, path)
    return n


def replace_interval_table(spark: SparkSession, path: str, new: DataFrame, ts: str,
                           start: str, end: str, partition_col: str | None = None) -> None:
    """LOAD-04 / LOAD-12 against a stored table.

    Unpartitioned target: rewrite and swap.  Target partitioned by
    ``partition_col`` (a date derived from ``ts``): dynamic-overwrite only
    the partitions that receive rows, then delete range partitions that did
    not (otherwise days without new rows would survive, S12).
    """
    if partition_col is None:
        if table_exists(spark, path):
            target = spark.read.parquet(path)
            write_swap(replace_interval(target, new, ts, start, end), path)
        else:
            write_swap(new.filter(in_range(ts, start, end)), path)
        return
    check_day_aligned(start, end)
    # Evaluated once: both the write and the list of its days (at most the
    # days of the range) read the checkpoint.
    rows = new.filter(in_range(ts, start, end)).checkpoint(eager=True)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(path))
    written = {r[0] for r in rows.select(F.col(partition_col).cast("string")).distinct().collect()}
    d = dt.date.fromisoformat(start[:10])
    last = dt.date.fromisoformat(end[:10])
    while d < last:
        if d.isoformat() not in written:
            delete_path(spark, f"{path.rstrip('/')}/{partition_col}={d.isoformat()}")
        d += dt.timedelta(days=1)


def skip_if_exists(spark: SparkSession, path: str, produce: Callable[[], DataFrame],
                   fmt: str = "parquet") -> bool:
    """LOAD-14: run ``produce`` and write only when ``path`` is absent."""
    if table_exists(spark, path):
        return False
    produce().write.format(fmt).save(path)
    return True


def daily_job(source: DataFrame, ts: str, day: str, path: str,
              transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """LOAD-16 / SNK-10: one day's rows (optionally transformed) overwrite
    that day's partition only.  A day without rows loses its partition: a
    dynamic overwrite alone would leave the earlier rows standing."""
    nxt = (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
    part = source.filter(in_range(ts, day, nxt))
    out = (transform(part) if transform else part).withColumn("dt", F.lit(day).cast("date"))
    out = out.checkpoint(eager=True)  # the transform may read the table itself
    spark, folder = source.sparkSession, f"{path.rstrip('/')}/dt={day}"
    if not out.isEmpty():
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt").parquet(path))
    elif path_exists(spark, folder):
        delete_path(spark, folder)
