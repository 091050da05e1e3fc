"""Clustered layouts: order inside files, pruning by bounds, hot values."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareflow.operators import clustering as CL
from fareflow.operators import layout as LY


def make(spark, n=20_000, hot=False):
    rng = random.Random(4)
    rows = [(None if i % 97 == 0 else (7 if hot and i % 3 == 0 else rng.randrange(1000)), rng.random(),
             f"k{rng.randrange(50):02d}") for i in range(n)]
    return spark.createDataFrame(rows, "a int, b double, s string")


def opened(spark, path, box):
    r = CL.files_for_box(CL.file_bounds(spark, path, ["a", "b"]), box).first()
    return r.opened, r.files


def test_a_filter_on_either_column_skips_files(spark, tmp):
    df = make(spark)
    CL.write_clustered(df, f"{tmp}/z", ["a", "b"], files=16)
    df.repartitionByRange(16, "a").write.parquet(f"{tmp}/one")
    assert sorted(map(str, spark.read.parquet(f"{tmp}/z").collect())) == sorted(map(str, df.collect()))
    on_a, on_b = {"a": (100, 110)}, {"b": (0.5, 0.51)}
    for box in (on_a, on_b):
        few, files = opened(spark, f"{tmp}/z", box)
        assert files == 16 and few <= 10
    both, files = opened(spark, f"{tmp}/z", {**on_a, **on_b})
    assert both <= 4
    assert opened(spark, f"{tmp}/one", on_b)[0] == 16  # ordering by one column helps that one alone


def test_rows_lie_in_curve_order_in_every_file(spark, tmp):
    df = make(spark)
    cuts = CL.quantile_cuts(df, ["a", "b"])
    CL.write_clustered(df, tmp + "/z", ["a", "b"], files=6)
    lows = []
    for f in glob.glob(tmp + "/z/*.parquet"):
        one = spark.read.parquet(f)
        z = [r[0] for r in one.select(CL.curve(one, ["a", "b"], cuts=cuts)).collect()]
        assert z == sorted(z)
        lows.append((z[0], z[-1]))
    lows.sort()
    assert all(x[1] <= y[0] for x, y in zip(lows, lows[1:]))  # files follow one another


def test_a_hot_value_spreads_over_files(spark, tmp):
    df = spark.range(9000).select(F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(F.col("id")).alias("a"),
                                  F.lit(0.5).alias("b"))
    df.repartition(30).write.parquet(f"{tmp}/in")  # two thirds of all rows are equal
    CL.write_clustered(spark.read.parquet(f"{tmp}/in"), f"{tmp}/z", ["a", "b"], files=9)
    rows = [r.rows for r in CL.file_bounds(spark, f"{tmp}/z", ["a"]).collect()]
    assert sum(rows) == 9000 and max(rows) <= 2 * 1000


def test_buckets_and_bits(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 5, 6, 99)], "v int")
    got = [r[0] for r in df.select(CL.bucket(F.col("v").cast("double"), [0, 5, 50])).collect()]
    assert got == [0, 0, 1, 2, 3]
    z = spark.range(1).select(CL.interleave([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert z == 0b100111
    with pytest.raises(ValueError):
        CL.interleave([F.lit(0)] * 11, 6)


def test_types_keep_their_order(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (date'2020-01-01', timestamp_ntz'2020-01-01 00:00:01', 'Ab', true, 1.5BD),
        (date'2020-01-02', timestamp_ntz'2020-01-01 00:00:02', 'Abc', false, 2.5BD),
        (date'2021-01-02', timestamp_ntz'2021-01-01 00:00:00', 'é', true, 3.5BD) AS t(d, t, s, b, m)""")
    for c in ("d", "t", "s", "m"):
        x = [r[0] for r in df.orderBy("m").select(CL.as_number(df, c)).collect()]
        assert x == sorted(x) and len(set(x)) == 3, c
    with pytest.raises(TypeError):
        CL.as_number(df.select(F.array("b").alias("arr")), "arr")


def test_empty_and_null_tables(spark, tmp):
    for name, df in (("e", spark.createDataFrame([], "a int, b double")),
                     ("n", spark.createDataFrame([(None, None)] * 5, "a int, b double"))):
        CL.write_clustered(df, f"{tmp}/{name}", ["a", "b"], files=3)
        assert spark.read.parquet(f"{tmp}/{name}").count() == df.count()


def test_date_partitions_are_sorted_inside_each_file(spark, tmp):
    df = make(spark).withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,cast(b * 4 as int))"))
    LY.write_by_date(df, f"{tmp}/d", "ts", "day", cluster_by=["s", "a"])
    files = glob.glob(f"{tmp}/d/day=*/*.parquet")
    assert len(files) >= 4
    for f in files:
        t = pq.read_table(f, columns=["s", "a"]).to_pylist()
        keys = [(r["s"], r["a"] is not None, r["a"] or 0) for r in t]
        assert keys == sorted(keys)
