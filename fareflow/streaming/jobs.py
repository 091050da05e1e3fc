"""Structured Streaming jobs (STR-*, SRC-16, JON-21).

Transformations are shared with batch code: every function below takes a
DataFrame and works on both a static and a streaming frame.  Event time
comes in as ``TIMESTAMP_NTZ`` from Parquet; ``withWatermark`` needs
``TIMESTAMP``, so ``event_time`` converts it (S19) and ``to_ntz`` converts
window bounds back for output.

Exactly-once: file sinks and ``foreachBatch`` writers are keyed by the
checkpointed batch id, so a replayed batch overwrites its own output
instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators.sketches import quantile_sketches
from fareflow.functions.columns import exact_ratio
from fareflow.operators.loads import table_exists, write_swap
from fareflow.session import delete_path, path_exists, scratch_path


# ---------------------------------------------------------------- sources
def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-16: stream of files under ``path`` (a directory or a glob).

    A single file is addressed as a glob (``name.parque[t]``): the file
    source requires its base path to be a directory otherwise.
    """
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(as_glob(path))


def as_glob(path: str) -> str:
    if any(ch in path for ch in "*?[") or not path.endswith((".parquet", ".json", ".csv")):
        return path
    return path[:-1] + f"[{path[-1]}]"


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Kafka form of the same source (needs the Kafka connector jar)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).load())


# ---------------------------------------------------------------- time helpers
def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def to_ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def flat_window(df: DataFrame, window_col: str = "window") -> DataFrame:
    """Replace the ``window`` struct by zone-free ``window_start``/``window_end``."""
    rest = [c for c in df.columns if c != window_col]
    return df.select(to_ntz(F.col(f"{window_col}.start")).alias("window_start"),
                     to_ntz(F.col(f"{window_col}.end")).alias("window_end"), *rest)


# ---------------------------------------------------------------- transforms
def tumbling_counts(df: DataFrame, ts: str, key: str, size: str = "5 minutes",
                    watermark: str | None = "10 minutes") -> DataFrame:
    """STR-01 / STR-02: count per tumbling window and key; rows later than
    the watermark are dropped and each window is emitted once, when closed."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    return flat_window(df.groupBy(F.window(ts, size), key).agg(F.count(F.lit(1)).alias("n")))


def count_by_key(df: DataFrame, key: str) -> DataFrame:
    """STR-05: the same unbounded group-by for batch and stream."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def stateless_clean(df: DataFrame) -> DataFrame:
    """STR-06: filter + projection + format conversion, no state."""
    return (df.filter(F.col("value").isNotNull() & (F.col("value") >= 0))
              .select("event_id", "ts", "user_id", F.upper("event_type").alias("event_type"),
                      F.round("value", 2).alias("value")))


def with_ingest_lag(df: DataFrame, ts: str = "ts") -> DataFrame:
    """STR-07: processing time minus event time, in seconds."""
    now = F.current_timestamp()
    return df.withColumn("ingest_ts", now).withColumn(
        "lag_seconds", (F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp"))) / 1_000_000)


def dedup_events(df: DataFrame, key: Sequence[str], ts: str, watermark: str = "10 minutes") -> DataFrame:
    """STR-08: drop repeated events (same key) arriving within the watermark."""
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(key))


def burst_rule(df: DataFrame, ts: str, key: str, size: str, slide: str, threshold: int,
               predicate: Column | None = None, watermark: str = "10 minutes") -> DataFrame:
    """STR-12: keys with at least ``threshold`` events in a sliding window."""
    if predicate is not None:
        df = df.filter(predicate)
    g = (df.withWatermark(ts, watermark).groupBy(F.window(ts, size, slide), key)
           .agg(F.count(F.lit(1)).alias("attempts")))
    return flat_window(g.filter(F.col("attempts") >= threshold))


def moving_average_alert(df: DataFrame, ts: str, key: str, value: str, size: str, slide: str,
                         threshold: float, watermark: str = "10 minutes") -> DataFrame:
    """STR-13: sliding-window average per key, kept when above ``threshold``."""
    g = (df.withWatermark(ts, watermark).groupBy(F.window(ts, size, slide), key)
           .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n")))
    return flat_window(g.filter(F.col("avg_value") > threshold))


def recent_categories(df: DataFrame, ts: str, key: str, category: str, size: str, slide: str,
                      watermark: str = "10 minutes") -> DataFrame:
    """STR-14: distinct categories per key and sliding window (bounded by
    the number of categories, sorted for a stable output)."""
    g = (df.withWatermark(ts, watermark).groupBy(F.window(ts, size, slide), key)
           .agg(F.array_sort(F.collect_set(category)).alias("categories")))
    return flat_window(g)


def log_metrics(df: DataFrame, ts: str, status: Column, latency: str, size: str = "5 minutes",
                watermark: str = "10 minutes", spike: float = 0.2) -> DataFrame:
    """STR-15: per window error count and rate (exact, six places),
    approximate p99 latency and a spike flag."""
    g = (df.withWatermark(ts, watermark).groupBy(F.window(ts, size))
           .agg(F.count(F.lit(1)).alias("n"),
                F.count_if(status).alias("errors"),
                F.percentile_approx(latency, 0.99, 10_000).alias("p99_latency"),
                F.max(latency).alias("max_latency")))
    g = g.withColumn("error_rate", exact_ratio("errors", "n"))
    return flat_window(g.withColumn("spike", F.col("errors") > F.col("n") * F.lit(spike)))


def enrich(stream: DataFrame, static: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """JON-21: stream–static join; each micro-batch is planned anew, so the
    static side is broadcast only while it is under the byte threshold."""
    return stream.join(static, on, "left")


def usual_places(history: DataFrame, key: str, place: str) -> DataFrame:
    """STR-18 profile: the distinct (key, place) pairs of the history."""
    return history.select(key, place).filter(F.col(place).isNotNull()).distinct()


def new_place_alerts(stream: DataFrame, profile: DataFrame, key: str, place: str) -> DataFrame:
    """STR-18: events at a place not in the key's profile (or no profile): an
    anti-join on the pair, so no key's places are gathered into one value."""
    return stream.join(profile, [key, place], "left_anti")


# ---------------------------------------------------------------- sinks
def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> None:
    """STR-03: process everything available now into a file sink, then stop."""
    q = (df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start(path))
    q.awaitTermination()


def start_micro_batches(df: DataFrame, path: str, checkpoint: str, interval: str = "1 minute",
                        mode: str = "append", fmt: str = "parquet"):
    """STR-03: a long-running query with a processing-time trigger; returns
    the ``StreamingQuery`` handle (the caller stops it)."""
    return (df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint)
              .trigger(processingTime=interval).start(path))


def run_to_table(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream to completion into a fresh Parquet location under the
    shared checkpoint root and return the result as a batch frame."""
    spark = df.sparkSession
    out, ck = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ck")
    if mode == "append":
        run_available(df, out, ck, mode)
    else:
        run_foreach_batch(df, ck, lambda b, i: overwrite_batch(b, out), mode=mode)
    if not path_exists(spark, out):
        raise RuntimeError(f"stream {name} wrote nothing to {out}")
    # The stream's own schema: a sink without rows still has its columns.
    return spark.read.schema(df.schema).parquet(out)


def run_foreach_batch(df: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None],
                      mode: str = "append") -> None:
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
           .foreachBatch(fn).trigger(availableNow=True).start())
    q.awaitTermination()


def overwrite_batch(batch: DataFrame, path: str) -> None:
    batch.write.mode("overwrite").parquet(path)


def idempotent_append(path: str) -> Callable[[DataFrame, int], None]:
    """STR-04: ``foreachBatch`` writer: write the batch under ``batch_id=N``
    with overwrite, so a replay after failure replaces the batch's own files
    instead of duplicating them.  AQE sizes the output files from the batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.hint("rebalance").write.mode("overwrite")
              .parquet(f"{path.rstrip('/')}/batch_id={batch_id}"))
    return write


def sketch_batches(path: str, ts: str, keys: list[str], value: str) -> Callable[[DataFrame, int], None]:
    """STR-15: ``foreachBatch`` writer of daily quantile sketches.  A batch
    reads its own rows only and writes under ``batch_id=N`` with overwrite, so
    a replay replaces its sketches; readers merge the batches' sketches."""
    def write(batch: DataFrame, batch_id: int) -> None:
        daily = quantile_sketches(batch, [F.to_date(ts).alias("day"), *keys], value)
        daily.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def multi_sink(sinks: dict[str, Callable[[DataFrame], DataFrame]], root: str
               ) -> Callable[[DataFrame, int], None]:
    """STR-16: one change log, several read models.  Each model aggregates the
    micro-batch (persisted once) into its directory, keyed by batch id; a
    reader sums the batches' partial results (see ``read_model``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        for name, build in sinks.items():
            (build(b).write.mode("overwrite")
                 .parquet(f"{root.rstrip('/')}/{name}/batch_id={batch_id}"))
        b.unpersist()
    return write


def read_model(spark: SparkSession, root: str, name: str, keys: Sequence[str],
               sums: Sequence[str]) -> DataFrame:
    """Current state of a read model: its batches' partial sums added up."""
    return (spark.read.parquet(f"{root.rstrip('/')}/{name}").groupBy(*keys)
            .agg(*[F.sum(c).alias(c) for c in sums]))


# ---------------------------------------------------------------- CDC
CDC_SCHEMA = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("before", T.StructType([T.StructField("id", T.LongType()),
                                          T.StructField("name", T.StringType()),
                                          T.StructField("balance", T.DoubleType())])),
    T.StructField("after", T.StructType([T.StructField("id", T.LongType()),
                                         T.StructField("name", T.StringType()),
                                         T.StructField("balance", T.DoubleType())])),
    T.StructField("seq", T.LongType()),
])


def latest_changes(changes: DataFrame) -> DataFrame:
    """Last change per key (ordered by ``seq``), flattened to ``id, op, name,
    balance, seq``.  Map-side partial aggregation via ``max_by``."""
    keyed = changes.withColumn("id", F.coalesce(F.col("after.id"), F.col("before.id")))
    last = keyed.groupBy("id").agg(F.max_by(F.struct("op", "after"), "seq").alias("l"),
                                   F.max("seq").alias("seq"))
    return last.select("id", F.col("l.op").alias("op"), F.col("l.after.name").alias("name"),
                       F.col("l.after.balance").alias("balance"), "seq")


def apply_changes(target: DataFrame, changes: DataFrame) -> DataFrame:
    """STR-09: current table after applying one batch of c/u/d envelopes."""
    last = latest_changes(changes)
    kept = target.join(last.select("id"), "id", "left_anti")
    upserts = last.filter(F.col("op") != "d").select("id", "name", "balance")
    return kept.unionByName(upserts)


def init_cdc_table(df: DataFrame, path: str) -> None:
    """Base of a CDC target: every row is a state with sequence -1."""
    (df.select("id", F.lit("c").alias("op"), "name", "balance", F.lit(-1).cast("long").alias("seq"))
       .write.parquet(f"{path.rstrip('/')}/base"))


def cdc_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: one change file per batch, merged on read.

    A micro-batch writes its own latest state per key and touches nothing
    else, so its cost follows its size.  Files are keyed by batch id: a replay
    overwrites its own.  ``read_cdc`` resolves keys by sequence number, so a
    late older change never overwrites a newer row; ``compact_cdc`` folds the
    change files into the base from time to time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (latest_changes(batch).write.mode("overwrite")
            .parquet(f"{path.rstrip('/')}/changes/batch_id={batch_id}"))
    return write


def _cdc_states(spark: SparkSession, path: str) -> DataFrame:
    """Newest state per key over base and change files, deletions included."""
    root = path.rstrip("/")
    states = spark.read.parquet(f"{root}/base").select("id", "op", "name", "balance", "seq")
    if path_exists(spark, f"{root}/changes"):
        changes = spark.read.parquet(f"{root}/changes")
        states = states.unionByName(changes.select(*states.columns))
    last = states.groupBy("id").agg(F.max_by(F.struct("op", "name", "balance"), "seq").alias("l"),
                                    F.max("seq").alias("seq"))
    return last.select("id", "l.op", "l.name", "l.balance", "seq")


def read_cdc(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of a CDC target."""
    table_exists(spark, f"{path.rstrip('/')}/base")
    return _cdc_states(spark, path).filter("op <> 'd'").select("id", "name", "balance")


def compact_cdc(spark: SparkSession, path: str) -> None:
    """Fold the change files into the base; run while the stream is stopped.

    Deleted keys stay in the base as tombstones, so an older change that
    arrives later cannot bring them back.  A crash before the change files are
    dropped only leaves states the base holds already.
    """
    root = path.rstrip("/")
    table_exists(spark, f"{root}/base")
    write_swap(_cdc_states(spark, path), f"{root}/base")
    delete_path(spark, f"{root}/changes")


def audit_history(changes: DataFrame) -> DataFrame:
    """STR-10: every change kept, flattened, in arrival order columns."""
    return changes.select("seq", "op", F.coalesce(F.col("after.id"), F.col("before.id")).alias("id"),
                          F.col("before.name").alias("before_name"), F.col("after.name").alias("after_name"))


# ---------------------------------------------------------------- Lambda view
def lambda_view(batch_view: DataFrame, speed: DataFrame, key: str) -> DataFrame:
    """STR-17: the batch view's sums merged with the speed layer's, per key."""
    return (batch_view.unionByName(speed).groupBy(key)
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
