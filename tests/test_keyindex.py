"""Key index: same rows as the full anti-join, few files read, safe when damaged."""

import glob
import os

from pyspark.sql import functions as F

from fareflow.operators import keyindex as K
from fareflow.operators import loads as L


def batch(spark, lo, hi, tag="a"):
    return spark.range(lo, hi).select(F.md5(F.col("id").cast("string")).alias("rid"),
                                      F.lit(tag).alias("tag"), F.col("id").alias("v"))


def repeated(spark, v):
    return spark.range(1500).select(F.md5(F.lit(str(v))).alias("rid"), F.lit("hot").alias("tag"),
                                    F.lit(v).cast("long").alias("v"))


def table_of_months(spark, path, months=6, size=4000, per_file=1000):
    for m in range(months):
        K.insert_only_indexed(spark, path, batch(spark, m * size, (m + 1) * size, f"m{m}"), "rid", per_file)


def test_rerun_of_a_month_opens_that_month_and_a_new_month_opens_none(spark, tmp):
    p = f"{tmp}/t"
    table_of_months(spark, p)
    assert spark.read.parquet(p).count() == 24000
    again = K.insert_only_indexed(spark, p, batch(spark, 8000, 12000, "again"), "rid", 1000)
    assert again.inserted == 0 and again.files == 24 and again.opened == 4
    new = K.insert_only_indexed(spark, p, batch(spark, 24000, 28000, "new"), "rid", 1000)
    assert new.inserted == 4000 and new.opened == 0
    # Half known, half new: only the known half's files.
    mixed = K.insert_only_indexed(spark, p, batch(spark, 26000, 30000, "mixed"), "rid", 1000)
    assert mixed.inserted == 2000 and mixed.opened <= 4 < mixed.files


def test_unread_files_are_not_read(spark, tmp):
    """Files that the index rules out may even be unreadable."""
    p = f"{tmp}/t"
    table_of_months(spark, p, months=3)
    keep = set(K.files_for_keys(spark, p, batch(spark, 0, 4000), "rid")[0])
    for f in glob.glob(f"{p}/*.parquet"):
        if f"file:{f}" not in keep:
            size = os.path.getsize(f)
            with open(f, "r+b") as h:
                h.seek(4)
                h.write(b"\xff" * (size // 2))  # pages go, the footer stays
    got = K.insert_only_indexed(spark, p, batch(spark, 0, 4000), "rid", 1000)
    assert got.inserted == 0 and got.opened == len(keep) == 4 and got.files == 12


def test_equals_the_full_anti_join_with_nulls_repeats_and_hot_ids(spark, tmp):
    first = batch(spark, 0, 3000).unionByName(repeated(spark, 0))
    second = (batch(spark, 2000, 5000, "b").unionByName(batch(spark, 4000, 4500, "c"))
              .unionByName(repeated(spark, 9000)))
    null = batch(spark, 0, 700, "null").withColumn("rid", F.lit(None).cast("string"))
    keyed, plain = f"{tmp}/keyed", f"{tmp}/plain"
    for b in (first.unionByName(null), second.unionByName(null), second.limit(0)):
        n = L.insert_only_table(spark, plain, b, "rid") if os.path.exists(plain) else None
        got = K.insert_only_indexed(spark, keyed, b, "rid", 500)
        if n is None:
            L.insert_only_table(spark, plain, b, "rid")
        else:
            assert got.inserted == n
    key = lambda r: tuple(str(x) for x in r)
    read = lambda p: sorted((tuple(r) for r in spark.read.parquet(p).collect()), key=key)
    assert read(keyed) == read(plain)


def test_absent_damaged_and_partial_filters_open_their_files(spark, tmp):
    p = f"{tmp}/t"
    table_of_months(spark, p, months=3)
    everything, fresh = batch(spark, 0, 12000), batch(spark, 50000, 50100)
    # A file from a writer that knows nothing of the index.
    L.append(batch(spark, 50000, 50050, "x"), p)
    n_new = spark.read.parquet(p).select(F.input_file_name()).distinct().count() - 12
    opened, files = K.files_for_keys(spark, p, fresh, "rid")
    assert len(opened) == n_new and files == 12 + n_new
    got = K.insert_only_indexed(spark, p, fresh, "rid", 1000)
    assert got.inserted == 50
    assert K.files_without_filter(spark, p).count() == 0
    # Rows of one filter missing, bits of another changed.
    index = spark.read.parquet(f"{p}/{K.INDEX}").collect()
    a, b = sorted({r.file for r in index if r.n_slices and r.n_slices > 3})[:2]
    held, hurt = [], True
    for r in index:
        if r.file == a and r.slice >= 0 and hurt:
            hurt = False
            continue
        held.append((*r[:5], bytearray(len(r.bits)) if r.file == b and r.bits else r.bits, r.checksum))
    L.write_swap(spark.createDataFrame(held, K.INDEX_SCHEMA), f"{p}/{K.INDEX}")
    assert {r.file for r in K.files_without_filter(spark, p).collect()} == {a, b}
    assert {a, b} <= set(K.files_for_keys(spark, p, batch(spark, 90000, 90010), "rid")[0])
    assert K.insert_only_indexed(spark, p, everything, "rid", 1000).inserted == 0
    assert K.files_without_filter(spark, p).count() == 0
    # An index that is no Parquet at all: every file, then a new index.
    for f in glob.glob(f"{p}/{K.INDEX}/*.parquet"):
        with open(f, "wb") as h:
            h.write(b"not parquet")
        os.path.exists(crc := os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")) and os.remove(crc)
    got = K.insert_only_indexed(spark, p, everything, "rid", 1000)
    assert got.inserted == 0 and got.opened == got.files
    assert K.files_without_filter(spark, p).count() == 0
    assert K.insert_only_indexed(spark, p, batch(spark, 90000, 90010), "rid", 1000).opened == 0


def test_no_false_negatives_and_few_false_alarms(spark):
    keys = batch(spark, 0, 60000).select(F.lit("f").alias("file"), F.lit(1).cast("long").alias("length"), "rid")
    index = K.filters(keys, "rid").cache()
    level = index.select("level").distinct().collect()
    assert len(level) == 1 and 2 ** level[0].level * K.SLICE_KEYS >= 60000
    hit = F.lit(True)
    for q in K.probes("id"):
        hit = hit & K._has_bit(F.col("bits"), q)
    def passed(lo, hi):
        ids = batch(spark, lo, hi).select(F.col("rid").alias("id")).withColumn(
            "slice", K._slice(K.spot("id"), F.lit(level[0].level)))
        return ids.join(index.filter("slice >= 0"), "slice").filter(hit).count()
    assert passed(0, 60000) == 60000
    assert passed(100000, 200000) <= 2  # expected 100,000 x 2e-7
    assert K.FALSE_SHARE < 3e-7


def test_slice_bits_equal_the_bitmap_aggregate_without_a_row_per_probe(spark, monkeypatch):
    keys = batch(spark, 0, 5000).select(F.concat(F.lit("f"), F.col("v") % 3).alias("file"),
                                        F.lit(7).cast("long").alias("length"), "rid")
    got = K.filters(keys, "rid")
    assert "explode" not in got._jdf.queryExecution().optimizedPlan().toString()
    placed = keys.select("file", "length", F.lit(K.MIN_LEVEL).alias("level"), F.col("rid").alias("id"),
                         K._slice(K.spot("rid"), F.lit(K.MIN_LEVEL)).alias("slice"))
    key = ["file", "length", "level", "slice"]
    want = (placed.select(*key, F.explode(F.array(*K.probes("id"))).alias("bit")).groupBy(*key)
            .agg(F.bitmap_construct_agg("bit").alias("bits")))
    want = {tuple(r)[:4]: bytes(r.bits) for r in want.collect()}
    sliced = {(r.file, r.length, r.level, r.slice): bytes(r.bits)
              for r in got.filter("slice >= 0").collect()}
    assert len(want) == 3 * 64 and sliced == want
    # In parts, when more slices are met than a task holds.
    monkeypatch.setattr(K, "OPEN_SLICES", 50)
    rows = placed.select(*key, *[h.alias(f"h{i}") for i, h in enumerate(K._hashes("id"))]).toArrow()
    parts, n = {}, 0
    for b in K._slice_bits(iter(rows.to_batches(max_chunksize=40))):
        for r in b.to_pylist():
            at, n = (r["file"], r["length"], r["level"], r["slice"]), n + 1
            parts[at] = parts.get(at, 0) | int.from_bytes(r["bits"], "little")
    assert n > len(want) and parts == {k: int.from_bytes(v, "little") for k, v in want.items()}


def test_a_slice_leaves_a_task_about_once_however_many_there_are(spark, tmp, monkeypatch):
    """More slices than a task holds at once, ids in any order."""
    keys = batch(spark, 0, 60000).coalesce(1).select(
        F.concat(F.lit("f"), F.col("v") % 300).alias("file"), F.lit(7).cast("long").alias("length"), "rid")
    bits, said = K._slice_bits, f"{tmp}/said"
    os.makedirs(said)

    def counted(batches):
        for b in bits(batches):
            with open(f"{said}/{os.getpid()}", "a") as f:
                f.write(f"{b.num_rows}\n")
            yield b

    monkeypatch.setattr(K, "_slice_bits", counted)
    index = K.filters(keys, "rid")
    slices = index.filter("slice >= 0").count()
    parts = sum(int(x) for f in glob.glob(f"{said}/*") for x in open(f))
    assert slices > 4 * K.OPEN_SLICES and parts < 1.1 * slices
    assert "SortMergeJoin" not in index._jdf.queryExecution().executedPlan().toString()
