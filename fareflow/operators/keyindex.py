"""Key index beside a table: insert-only merges that skip files (LOAD-06, LOAD-08, LOAD-13).

Every data file gets a Bloom filter of its ids, stored as Parquet rows under
``<table>/_key_index`` (readers pass over the underscore).  A merge tests the
batch's distinct ids against the filters, opens the files that may hold one of
them, and decides by an exact anti-join with those files.

A filter is cut into slices of 32,768 bits by the leading bits of the id's hash;
a file's ``level`` is the number of leading bits, chosen so that a slice holds
about ``SLICE_KEYS`` ids.  Ids and filters meet in an equi-join on (level,
slice), so neither a whole filter nor a whole batch is in one task, and distinct
hashes deal evenly.  Rows of one load are written along the hash, so a slice
lies in one or two files of each load.

At ``BITS_PER_KEY`` bits an absent id passes a full slice with probability
``FALSE_SHARE``; a file that holds none of the batch's ids is opened with about
that times the number of batch ids in its hash range.  False alarms cost
reading, never rows.

A filter counts only if its file has the length it was built for and all its
slices are there with a right checksum; any other file is opened.  An index
that cannot be read at all means that every file is opened.  Files without a
valid filter get one at the end of the next load, so a crash between the data
and the index heals itself.

Defined results: rows with a NULL id are always inserted (NULL equals nothing);
equal ids inside a batch are all kept; an empty batch adds nothing.  Only file
names of the table and level numbers come to the driver.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.clustering import _has_map
from fareflow.operators.loads import table_exists
from fareflow.session import delete_path, path_exists, staged

SLICE_BITS = 32768  # size of Spark's bitmap functions
BITS_PER_KEY = 32
PROBES = 22  # BITS_PER_KEY * ln 2
FALSE_SHARE = (1 - math.exp(-PROBES / BITS_PER_KEY)) ** PROBES
SLICE_KEYS = SLICE_BITS // BITS_PER_KEY
MIN_LEVEL, MAX_LEVEL = 6, 40
ROWS_PER_FILE = 1_000_000
INDEX = "_key_index"
INDEX_SCHEMA = ("file string, length long, level int, slice long, n_slices long, "
                "bits binary, checksum long")

log = logging.getLogger(__name__)


@dataclass
class Merge:
    inserted: int
    files: int
    opened: int


def spot(id_col: str | Column) -> Column:
    """Place of an id on the hash line ``[0, 2 ** 63)``; NULL has none."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.when(c.isNotNull(), F.shiftrightunsigned(F.xxhash64(c), 1))


def _hashes(id_col: str) -> list[Column]:
    return [F.xxhash64(F.col(id_col), F.lit(i)) for i in range(1, 1 + -(-PROBES // 4))]


def probes(id_col: str) -> list[Column]:
    """The bit positions of an id: four of 15 bits from each hash."""
    hashes = _hashes(id_col)
    return [F.shiftrightunsigned(hashes[i // 4], 15 * (i % 4)).bitwiseAND(F.lit(SLICE_BITS - 1))
            for i in range(PROBES)]


def _slice(place: Column, level: Column) -> Column:
    return F.call_function("shiftright", place, F.lit(63) - level)


def _has_bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("getbit", byte.cast("int"), position.bitwiseAND(F.lit(7)).cast("int")) == 1


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, length`` of the table's data files (names only, nothing is read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path)
            .select(F.col("path").alias("file"), "length"))


BITS_SCHEMA = "file string, length long, level int, slice long, bits binary"
OPEN_SLICES = 4096  # slices a task holds at once, 4 KB each


def _slice_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the ids of a task, a row per file and slice; one met again after
    ``OPEN_SLICES`` others may come in parts.  Last columns: the hashes of ``probes``."""
    def done() -> pa.RecordBatch:
        cols = [*zip(*spots, strict=True)]
        bits = pa.array([memoryview(x) for x in flat[:len(spots)]], pa.binary())
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([*map(pa.array, cols, kinds), bits],
                                          names=[c.split()[0] for c in BITS_SCHEMA.split(", ")])

    spots: dict[tuple, int] = {}
    flat = np.zeros((0, SLICE_BITS // 8), np.uint8)
    for b in batches:
        names = b.column(0).dictionary_encode()
        at = np.array([names.indices.to_numpy(), *(b.column(i).to_numpy() for i in (1, 2, 3))])
        found, row = np.unique(at, axis=1, return_inverse=True)
        keys = [(names.dictionary[f].as_py(), n, level, s) for f, n, level, s in found.T.tolist()]
        if spots and len(spots.keys() | keys) > OPEN_SLICES:
            yield done()
            spots = {}
            flat[:] = 0
        own = np.array([spots.setdefault(k, len(spots)) for k in keys], np.int64)
        if len(spots) > len(flat):
            flat = np.concatenate([flat, np.zeros((2 * len(spots) - len(flat), SLICE_BITS // 8), np.uint8)])
        to = own[row.ravel()] * (SLICE_BITS // 8)
        for i in range(PROBES):
            bit = b.column(4 + i // 4).to_numpy().view(np.uint64) >> np.uint64(15 * (i % 4)) \
                & np.uint64(SLICE_BITS - 1)
            np.bitwise_or.at(flat.reshape(-1), to + (bit >> np.uint64(3)).astype(np.int64),
                             np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
    if spots:
        yield done()


def filters(keys: DataFrame, id_col: str) -> DataFrame:
    """Index rows from ``file, length`` and an id: one per slice, one (slice -1) per file.

    A file whose ids are all NULL, or without rows, has only the latter."""
    k = keys.select("file", "length", F.col(id_col).alias("id"), spot(id_col).alias("at"))
    width = F.greatest((F.max("at") - F.min("at")) / F.lit(float(1 << 63)), F.lit(1 / 4096))
    need = F.ceil(F.log2(F.greatest(F.count("id"), F.lit(1)) / F.lit(SLICE_KEYS) / width))
    levels = k.groupBy("file", "length").agg(
        F.greatest(F.lit(MIN_LEVEL), F.least(F.lit(MAX_LEVEL), F.coalesce(need, F.lit(0))))
        .cast("int").alias("level"))
    # One row a file: repeated, so that ids are not shuffled to their few files.
    levelled = k.join(F.broadcast(levels), ["file", "length"])
    # A row per probe would be sorted by Spark's bitmap aggregate, 22 an id.  Rows
    # of a file come in any order: with more slices than a task holds, each would
    # leave the task in a part for every few ids, so the task's rows go by slice.
    placed = (levelled.filter("id IS NOT NULL")
              .select("file", "length", "level", _slice(F.col("at"), F.col("level")).alias("slice"), "id")
              .sortWithinPartitions("slice")
              .select("file", "length", "level", "slice",
                      *[h.alias(f"h{i}") for i, h in enumerate(_hashes("id"))]))
    bits = (placed.mapInArrow(_slice_bits, BITS_SCHEMA).groupBy("file", "length", "level", "slice")
            .agg(F.bitmap_or_agg("bits").alias("bits")))
    sliced = bits.select("file", "length", "level", "slice", F.lit(None).cast("long").alias("n_slices"),
                         "bits", F.crc32("bits").alias("checksum"))
    # Distinct slices of a file are counted from the ids, not from the rows above,
    # so a row lost on the way shows.
    counted = (levelled.groupBy("file", "length", "level")
               .agg(F.count_distinct(_slice(F.col("at"), F.col("level"))).alias("n_slices")))
    return sliced.unionByName(counted.select(
        "file", "length", "level", F.lit(-1).cast("long").alias("slice"), "n_slices",
        F.lit(None).cast("binary").alias("bits"), F.lit(None).cast("long").alias("checksum")))


def _index(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path.rstrip('/')}/{INDEX}"
    if not path_exists(spark, where):
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).parquet(where)


def _sound(index: DataFrame) -> DataFrame:
    """``file, length, level`` of the filters with every slice present and intact."""
    right = (F.col("slice") >= 0) & (F.crc32("bits") == F.col("checksum"))
    return (index.groupBy("file", "length", "level")
            .agg(F.max("n_slices").alias("n"), F.count_distinct(F.when(right, F.col("slice"))).alias("have"))
            .filter("n = have").select("file", "length", "level"))


def files_without_filter(spark: SparkSession, path: str) -> DataFrame:
    """``file, length`` of the data files that have no sound filter."""
    return data_files(spark, path).join(_sound(_index(spark, path)), ["file", "length"], "left_anti")


def index_files(spark: SparkSession, path: str, id_col: str) -> int:
    """Build the filters that are missing; only those files are read.  Their number."""
    try:
        todo = [(r.file, r.length) for r in files_without_filter(spark, path).collect()]
    except (PySparkException, Py4JJavaError) as e:
        log.warning("key index of %s cannot be read and is built anew: %s", path, type(e).__name__)
        delete_path(spark, f"{path.rstrip('/')}/{INDEX}")
        todo = [(r.file, r.length) for r in data_files(spark, path).collect()]
    if not todo:
        return 0
    table = spark.read.schema(spark.read.parquet(path).schema).option("basePath", path)
    keys = table.parquet(*[f for f, _ in todo]).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"), id_col)
    filters(keys, id_col).write.mode("append").parquet(f"{path.rstrip('/')}/{INDEX}")
    return len(todo)


def files_for_keys(spark: SparkSession, path: str, ids: DataFrame, id_col: str) -> tuple[list[str], int]:
    """The files that may hold one of the ids, and the number of all files."""
    files = data_files(spark, path)
    try:
        index = _index(spark, path)
        sound = _sound(index)
        levels = [r.level for r in sound.select("level").distinct().collect()]
        keys = ids.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
        keys = keys.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
        keys = keys.withColumn("slice", _slice(spot("id"), F.col("level")))
        hit = F.lit(True)
        for p in probes("id"):
            hit = hit & _has_bit(F.col("bits"), p)
        met = (keys.join(index.filter("slice >= 0").select("file", "length", "level", "slice", "bits"),
                         ["level", "slice"]).filter(hit).select("file", "length").distinct()
               .withColumn("met", F.lit(True)))
        marked = (files.join(sound.select("file", "length", F.lit(True).alias("sound")),
                             ["file", "length"], "left").join(met, ["file", "length"], "left"))
        rows = marked.select("file", (F.col("sound").isNull() | F.col("met")).alias("open")).collect()
        return [r.file for r in rows if r.open], len(rows)
    except (PySparkException, Py4JJavaError) as e:
        log.warning("key index of %s cannot be read, every file is opened: %s", path, type(e).__name__)
        every = [r.file for r in files.collect()]
        return every, len(every)


def append_keyed(df: DataFrame, path: str, id_col: str, rows: int,
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append ``rows`` rows along the hash of their id, about ``rows_per_file`` a file.

    Rows without an id, and rows of one frequent id, are told apart by a hash of
    the row and of the input split, the same when a task runs again."""
    plain = [F.col(c) for c in df.columns if not _has_map(df.schema[c].dataType)]
    tie = F.xxhash64(F.input_file_name(), F.input_file_block_start(), *plain)
    (df.withColumn("__tie", tie).withColumn("__at", F.coalesce(spot(id_col), F.shiftrightunsigned("__tie", 1)))
     .repartitionByRange(max(1, -(-rows // rows_per_file)), "__at", "__tie")
     .drop("__at", "__tie").write.mode("append").parquet(path))


def insert_only_indexed(spark: SparkSession, path: str, source: DataFrame, id_col: str,
                        rows_per_file: int = ROWS_PER_FILE) -> Merge:
    """LOAD-06 / LOAD-13: append the rows of ``source`` whose id the table lacks.

    The same rows as ``loads.insert_only_table``; the table's files are read only
    where a filter says that they may hold an id of the batch.  A missing table
    is created from ``source``."""
    opened = files = 0
    if table_exists(spark, path):
        schema = spark.read.parquet(path).schema
        batch = staged(source.select(*schema.names), "keyed-batch")
        names, files = files_for_keys(spark, path, batch, id_col)
        opened = len(names)
        fresh = kept = batch
        if names:
            kept = None
            held = spark.read.schema(schema).option("basePath", path).parquet(*names).select(id_col)
            fresh = batch.join(held, id_col, "left_anti").select(*schema.names)
    else:
        fresh, kept = source, None
    # Written once: the count sizes the files, and the append must not change its input.
    # A batch of which no file may hold an id is written already.
    if kept is None:
        fresh = staged(fresh, "keyed-fresh")
    n = fresh.count()
    if n or not files:
        append_keyed(fresh, path, id_col, n, rows_per_file)
    index_files(spark, path, id_col)
    return Merge(n, files, opened)
