"""Per-event trailing rules on keyed state (STR-13, STR-14, WIN-06).

Every event gets the average, or the categories, of its key's events in the
span before it (both ends included), without sliding-window copies.  State is
kept by (bucket of the key's hash, time chunk), since every call for a group and
every access to its state costs a round trip between the JVM and Python: a
bucket's keys share it, and are told apart inside.  An event lives in its own
chunk, and one in the last span of a chunk is also context of the next, so a hot
key spreads over as many tasks as it has open chunks and at most
``span / chunk`` of the events are copied.  An event is emitted once the watermark has passed it, when nothing
earlier can arrive; a timer at the earliest waiting event wakes its chunk.
Events older than the span before the watermark leave the state, and a timer at
the chunk's end clears the rest.

A key is a group of its own if NULL; events without a time are left out; events
of the same time see each other.  State is on RocksDB (``rocksdb_state``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from fareflow.functions.columns import floor_div, hash_bucket

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SCALE = 10**9
KEY_BUCKETS = 128  # groups a time chunk
PLACE_BUCKETS = 4096


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _same_key(key) -> str:
    """One text for keys that a grouping takes as equal (NaN too, and both zeros)."""
    return repr(key + 0.0 if isinstance(key, float) else key)


class _Trailing(StatefulProcessor):
    """Rows ``(at, id, x, own, key)`` of a bucket's chunk, ``at`` in microseconds."""

    item: T.DataType = T.LongType()

    def __init__(self, span: int, chunk: int, key: T.DataType):
        self.span, self.chunk, self.key = span, chunk, key

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType([
            T.StructField("at", T.LongType()), T.StructField("id", T.LongType()),
            T.StructField("x", self.item), T.StructField("own", T.BooleanType()),
            T.StructField("key", self.key)]))
        # Own events up to here are emitted.
        self.done = handle.getValueState("done", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["at"], r["id"], r["x"], r["own"], r["key"]) for r in rows]
        self.rows.appendList(new)
        self._wake(key, [r[0] for r in new if r[3]])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.rows.get(), key=lambda r: r[0]) if self.rows.exists() else []
        done = self.done.get()[0] if self.done.exists() else None
        by_key: dict[str, list] = {}
        for r in rows:
            by_key.setdefault(_same_key(r[4]), []).append(r)
        out = [x for one in by_key.values() for x in self._emit(one, done, passed)]
        if passed >= (key[1] + 1) * self.chunk:
            self.rows.clear()
            self.done.clear()
        else:
            left = [tuple(r) for r in rows if r[0] > passed - self.span]
            if left:
                self.rows.put(left)
            else:
                self.rows.clear()
            self.done.update((passed,))
            self._wake(key, [r[0] for r in left if r[3] and r[0] > passed])
        return iter(out)

    def _wake(self, key, waiting: list[int]) -> None:
        end = (key[1] + 1) * self.chunk
        self.handle.registerTimer(-(-min([*waiting, end]) // 1000))

    def _emit(self, rows, done, passed) -> Iterator[Row]:
        window = self.empty()
        first = last = 0
        for r in rows:
            if r[0] > passed:
                break
            while last < len(rows) and rows[last][0] <= r[0]:
                self.add(window, rows[last][2], 1)
                last += 1
            while rows[first][0] < r[0] - self.span:
                self.add(window, rows[first][2], -1)
                first += 1
            if r[3] and (done is None or r[0] > done):
                yield Row(key=r[4], id=r[1], at=r[0], **self.result(window))

    def close(self) -> None:
        pass


class _Average(_Trailing):
    """Integers of nine decimals, so sums do not depend on the order."""

    def empty(self) -> list[int]:
        return [0, 0]

    def add(self, window: list[int], x: int | None, sign: int) -> None:
        if x is not None:
            window[0] += sign * x
            window[1] += sign

    def result(self, window: list[int]) -> dict:
        total, n = window
        return {"avg_value": total / (n * SCALE) if n else None, "n": n}


class _Categories(_Trailing):
    item = T.StringType()

    def empty(self) -> Counter:
        return Counter()

    def add(self, window: Counter, x: str | None, sign: int) -> None:
        if x is not None:
            window[x] += sign

    def result(self, window: Counter) -> dict:
        return {"categories": sorted(k for k, n in window.items() if n)}


def _keyed(df: DataFrame, ts: str, key: str, id_col: str, x: Column, span: int, chunk: int,
           watermark: str) -> DataFrame:
    if not 0 < span <= chunk:
        raise ValueError("the span must be positive and at most a chunk")
    at = F.unix_micros(F.col(ts))
    own = floor_div(at, chunk)
    near_end = at >= (own + 1) * chunk - span
    homes = F.array(F.struct(own.alias("chunk"), F.lit(True).alias("own")),
                    F.when(near_end, F.struct((own + 1).alias("chunk"), F.lit(False).alias("own"))))
    return (df.withWatermark(ts, watermark).filter(F.col(ts).isNotNull())
            .select(F.col(ts), F.col(key).alias("key"), F.col(id_col).cast("long").alias("id"),
                    at.alias("at"), x.alias("x"), hash_bucket(KEY_BUCKETS, key).alias("bucket"),
                    F.explode(F.filter(homes, lambda h: h.isNotNull())).alias("home"))
            .select(ts, "key", "id", "at", "x", "bucket", "home.chunk", "home.own")
            .groupBy("bucket", "chunk"))


def _run(groups, df: DataFrame, processor: StatefulProcessor, key: str, id_col: str, ts: str,
         results: str) -> DataFrame:
    kind = T._parse_datatype_string(results)
    schema = T.StructType([T.StructField("key", df.schema[key].dataType),
                           T.StructField("id", T.LongType()), T.StructField("at", T.LongType()),
                           *kind.fields])
    out = groups.transformWithState(processor, schema, "Append", "EventTime")
    return out.select(F.col("key").alias(key), F.col("id").alias(id_col),
                      F.timestamp_micros("at").alias(ts), *kind.names)


def trailing_average(df: DataFrame, ts: str, key: str, id_col: str, value: str,
                     span_seconds: int = 300, chunk_seconds: int = 3600,
                     watermark: str = "10 minutes") -> DataFrame:
    """STR-13 / WIN-06 per event: ``avg_value`` and ``n`` over the trailing span.

    Values are taken with nine decimals; NULL, NaN and values beyond nine
    integer digits' worth of a long are left out of the average.
    """
    v = F.col(value).cast("double")
    fits = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 9.2e9)
    x = F.when(fits, F.round(v * SCALE).cast("long"))
    span, chunk = span_seconds * 1_000_000, chunk_seconds * 1_000_000
    groups = _keyed(df, ts, key, id_col, x, span, chunk, watermark)
    return _run(groups, df, _Average(span, chunk, df.schema[key].dataType), key, id_col, ts, "avg_value double, n long")


def trailing_categories(df: DataFrame, ts: str, key: str, id_col: str, category: str,
                        span_seconds: int = 1800, chunk_seconds: int = 86_400,
                        watermark: str = "10 minutes") -> DataFrame:
    """STR-14 per event: the sorted distinct categories of the trailing span."""
    span, chunk = span_seconds * 1_000_000, chunk_seconds * 1_000_000
    groups = _keyed(df, ts, key, id_col, F.col(category).cast("string"), span, chunk, watermark)
    return _run(groups, df, _Categories(span, chunk, df.schema[key].dataType), key, id_col, ts,
                "categories array<string>")


# ---------------------------------------------------------------- STR-18 that learns
class _NewPlace(StatefulProcessor):
    """State per bucket of (key, place): its pairs and the time each was first seen."""

    def __init__(self, key: T.DataType, place: T.DataType):
        self.key, self.place = key, place

    def init(self, handle) -> None:
        self.seen = handle.getListState("seen", T.StructType([
            T.StructField("key", self.key), T.StructField("place", self.place),
            T.StructField("at", T.LongType())]))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.appendList([*zip(*(initialState[c] for c in ("keys", "places", "ats")), strict=True)])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = {(_same_key(r[0]), _same_key(r[1])) for r in self.seen.get()} if self.seen.exists() else set()
        first: dict[tuple, tuple] = {}
        for r in rows:
            pair = _same_key(r["key"]), _same_key(r["place"])
            if pair not in known:
                event = r["at"], r["id"], r["key"], r["place"]
                if pair not in first or event[:2] < first[pair][:2]:
                    first[pair] = event
        if first:
            self.seen.appendList([(k, p, at) for at, _, k, p in first.values()])
        return iter([Row(key=k, place=p, id=i, at=at) for at, i, k, p in first.values()])

    def close(self) -> None:
        pass


def learning_place_alerts(df: DataFrame, history: DataFrame, ts: str, key: str, place: str,
                          id_col: str) -> DataFrame:
    """STR-18: one alert per place that is new for its key, which then is usual.

    ``history`` (a batch table with the same columns) is loaded into the state
    once, when the query first starts; restarts go on from the state.  Of the
    new place's events in a micro-batch the earliest, by time and id, alerts.
    State is kept per bucket of the hash of (key, place), so a hot key spreads
    over its places; a micro-batch reads the buckets that its events fall into.
    Events without a key, place, time or id are left out.
    """
    def rows(d: DataFrame) -> DataFrame:
        named = d.select(F.col(key).alias("key"), F.col(place).alias("place"),
                         F.col(id_col).cast("long").alias("id"),
                         F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
        return named.dropna()

    bucket = hash_bucket(PLACE_BUCKETS, "key", "place").alias("bucket")
    known = (rows(history).groupBy("key", "place").agg(F.min("at").alias("at"))
             .groupBy(bucket).agg(F.collect_list(F.struct("key", "place", "at")).alias("known"))
             .select("bucket", F.col("known.key").alias("keys"), F.col("known.place").alias("places"),
                     F.col("known.at").alias("ats")))
    schema = T.StructType([T.StructField("key", df.schema[key].dataType),
                           T.StructField("place", df.schema[place].dataType),
                           T.StructField("id", T.LongType()), T.StructField("at", T.LongType())])
    out = rows(df).withColumn("bucket", bucket).groupBy("bucket").transformWithState(
        _NewPlace(df.schema[key].dataType, df.schema[place].dataType), schema, "Append", "None",
        known.groupBy("bucket"))
    return out.select(F.col("id").alias(id_col), F.col("key").alias(key),
                      F.col("place").alias(place), F.timestamp_micros("at").alias(ts))


def learned_places(spark: SparkSession, checkpoint: str, key: str, place: str) -> DataFrame:
    """The profile as a stopped or running query last committed it."""
    state = (spark.read.format("statestore").option("path", checkpoint)
             .option("stateVarName", "seen").load())
    return state.select(F.col("list_element.key").alias(key), F.col("list_element.place").alias(place),
                        F.timestamp_micros("list_element.at").alias("since"))
