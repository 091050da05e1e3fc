"""Sources, sinks and layout: round trips over data derived from the driver tables."""

import glob
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators import layout as LY
from fareflow.sources import driver as D
from fareflow.sources import files as SRC
from fareflow.sources import sinks as SNK

YELLOW_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
])


def _files(path, ext=".parquet"):
    return [f for f in glob.glob(f"{path}/**/*{ext}*", recursive=True) if not f.endswith(".crc")]


def test_csv_round_trip_modes(spark, sf_small, tmp):
    y = D.raw_yellow(spark, sf_small)
    p = f"{tmp}/yellow_csv"
    SNK.write(y, p, fmt="csv", mode="overwrite", header=True, compression="gzip")
    strings = SRC.read_csv(spark, p)
    assert all(t == "string" for _, t in strings.dtypes)
    typed = SRC.read_csv(spark, p, schema=YELLOW_SCHEMA)
    assert typed.exceptAll(y).count() == 0 and typed.count() == y.count()
    inferred = SRC.read_csv(spark, p, infer=True)
    assert dict(inferred.dtypes)["fare_amount"] == "double"


def test_csv_bad_lines_are_kept_or_fail(spark, tmp):
    import pytest
    p = f"{tmp}/bad.csv"
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,3\n4,5,extra\n")
    good, bad = SRC.split_rejects(SRC.read_csv(spark, p, schema="a int, b int", permissive=True))
    assert [tuple(r) for r in good.collect()] == [(2, 3)]
    assert sorted(r[0] for r in bad.collect()) == ["1,x", "4,5,extra"]
    with pytest.raises(Exception):
        SRC.read_csv(spark, p, schema="a int, b int", strict=True).collect()


def test_read_months_skips_missing(spark, sf_small, tmp):
    y = D.raw_yellow(spark, sf_small)
    for m in ("1998-01", "1998-03"):
        y.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == m).write.parquet(
            f"{tmp}/yellow_tripdata_{m}.parquet")
    df = SRC.read_months(spark, tmp, ["yellow", "green"], "1998-01-01", "1998-04-01")
    months = sorted(r[0] for r in df.select(F.date_format("tpep_pickup_datetime", "yyyy-MM")).distinct().collect())
    assert months == ["1998-01", "1998-03"]
    none = SRC.read_months(spark, tmp, ["fhv"], "1998-01-01", "1998-04-01", schema="a int")
    assert none.columns == ["a", "taxi_type"] and none.count() == 0


def test_read_months_keeps_columns_of_any_month(spark, tmp):
    spark.createDataFrame([(1, 2)], "id int, n int").write.parquet(f"{tmp}/yellow_tripdata_1998-01.parquet")
    spark.createDataFrame([(2, 3, 1.5)], "id long, n int, airport_fee double").write.parquet(
        f"{tmp}/yellow_tripdata_1998-02.parquet")
    df = SRC.read_months(spark, tmp, ["yellow"], "1998-01-01", "1998-03-01")
    assert sorted((r.id, r.airport_fee) for r in df.collect()) == [(1, None), (2, 1.5)]
    assert dict(df.dtypes)["id"] == "int"


def test_overwrites_leave_no_stale_partitions(spark, tmp):
    rows = spark.range(100).selectExpr("id", "id % 4 as p", "timestamp_ntz '2024-01-01' + make_interval(0, int(id % 4)) as ts")
    few = rows.filter("p = 1")
    SNK.write(rows, f"{tmp}/a", mode="overwrite", partition_by=["p"])
    SNK.write(few, f"{tmp}/a", mode="overwrite", partition_by=["p"])
    LY.write_by_year_month(rows, f"{tmp}/b", "ts")
    LY.write_by_year_month(few, f"{tmp}/b", "ts")
    SNK.convert_months(rows, "ts", f"{tmp}/c")
    SNK.convert_months(few, "ts", f"{tmp}/c")
    LY.write_by_date(rows, f"{tmp}/d", "ts")
    LY.write_by_date(few, f"{tmp}/d", "ts")
    assert [spark.read.parquet(f"{tmp}/{x}").count() for x in "abcd"] == [25] * 4
    LY.write_by_date(rows.filter("p = 2"), f"{tmp}/d", "ts", only_own_dates=True)
    assert spark.read.parquet(f"{tmp}/d").count() == 50


def test_json_array_document(spark, sf_small, tmp):
    part = D.table(spark, sf_small, "part").select("p_brand", "p_retailprice").limit(50).collect()
    doc = {"products": [({"brand": r[0], "price": r[1]} if i % 5 else {"price": r[1]})
                        for i, r in enumerate(part)]}
    p = f"{tmp}/products.json"
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    rows = SRC.read_json_array(spark, p, "products")
    assert rows.count() == 50
    from fareflow.operators.projection import project_with_default
    out = project_with_default(rows, ["brand", "price"])
    assert out.filter(F.col("brand") == "N/A").count() == 10


def test_convert_months_layout(spark, sf_small, tmp):
    y = D.raw_yellow(spark, sf_small)
    SNK.convert_months(y, "tpep_pickup_datetime", f"{tmp}/pq")
    parts = glob.glob(f"{tmp}/pq/year=*/month=*")
    assert len(parts) == y.select(F.date_format("tpep_pickup_datetime", "yyyy-MM")).distinct().count()
    back = spark.read.parquet(f"{tmp}/pq")
    assert back.count() == y.count()


def test_file_counts(spark, sf_small, tmp):
    o = D.table(spark, sf_small, "orders")
    SNK.write_n_files(o, f"{tmp}/n4", 4)
    assert len(_files(f"{tmp}/n4")) == 4
    SNK.write_single_file(o.groupBy("o_orderstatus").count(), f"{tmp}/one", fmt="csv")
    assert len(_files(f"{tmp}/one", ".csv")) == 1
    SNK.write_capped_files(o.coalesce(1), f"{tmp}/capped", 400)
    assert len(_files(f"{tmp}/capped")) == -(-o.count() // 400)


def test_create_if_missing_and_ddl(spark, tmp):
    schema = T.StructType([T.StructField("unique_row_id", T.StringType()),
                           T.StructField("fare_amount", T.DecimalType(38, 9))])
    p = f"{tmp}/target"
    assert SNK.create_if_missing(spark, p, schema, {"fare_amount": "The metered fare"})
    assert not SNK.create_if_missing(spark, p, schema)
    df = spark.read.parquet(p)
    assert df.count() == 0
    assert df.schema["fare_amount"].metadata.get("comment") == "The metered fare"
    assert SNK.schema_ddl(df).startswith("unique_row_id STRING")


def test_external_table_two_patterns(spark, sf_small):
    df = SRC.external_table(spark, "ext_lines", [f"{sf_small}/lineitem.parquet", f"{sf_small}/lineitem.parquet"])
    n = spark.sql("SELECT count(*) FROM ext_lines").first()[0]
    assert n == 2 * D.table(spark, sf_small, "lineitem").count()


def test_bronze_columns(spark, sf_small):
    from fareflow.plans.medallion import bronze
    b = bronze(D.table(spark, sf_small, "part"), "2024-01-01 00:00:00")
    r = b.first()
    assert r._source_file.endswith("part.parquet") and json.loads(r.raw_data)["p_partkey"] is not None


def test_partition_by_date_and_pruning(spark, sf_small, tmp):
    y = D.raw_yellow(spark, sf_small)
    p = f"{tmp}/by_date"
    LY.write_by_date(y, p, "tpep_dropoff_datetime", "dropoff_date", cluster_by=["VendorID"])
    t = spark.read.parquet(p)
    q = t.filter(F.col("dropoff_date").between("1998-03-01", "1998-03-15")).select("VendorID").distinct()
    plan = LY.plan_text(q)
    assert "PartitionFilters: [isnotnull(dropoff_date" in plan
    want = y.filter(F.to_date("tpep_dropoff_datetime").between("1998-03-01", "1998-03-15")).select("VendorID").distinct()
    assert sorted(map(tuple, q.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_compaction_and_archive(spark, sf_small, tmp):
    o = D.table(spark, sf_small, "orders")
    p = f"{tmp}/small_files"
    o.repartition(20).write.parquet(p)
    assert len(_files(p)) == 20
    LY.compact(spark, p)
    assert len(_files(p)) == 1 and spark.read.parquet(p).count() == o.count()
    parts = f"{tmp}/parts"
    o.repartition(6).write.partitionBy("o_orderstatus").parquet(parts)
    LY.compact(spark, parts)
    assert LY.partition_columns(spark, parts) == ["o_orderstatus"]
    assert spark.read.parquet(parts).count() == o.count()
    LY.archive_split(o, "o_orderdate", "1997-01-01 00:00:00", f"{tmp}/hot", f"{tmp}/cold")
    before = spark.read.parquet(f"{tmp}/cold").count()
    for _ in range(2):  # the hot path as its own source
        LY.archive_split(spark.read.parquet(f"{tmp}/hot"), "o_orderdate", "1997-01-01 00:00:00",
                         f"{tmp}/hot", f"{tmp}/cold")
    assert spark.read.parquet(f"{tmp}/cold").count() == before
    assert spark.read.parquet(f"{tmp}/hot").count() + spark.read.parquet(f"{tmp}/cold").count() == o.count()


def test_target_partitions_and_skew(spark, sf_small):
    assert LY.target_partitions(10 * 2**30, 8) == 80
    assert LY.target_partitions(1000, 8) == 16
    r = LY.skew_report(D.table(spark, sf_small, "lineitem").repartition(4)).first()
    assert r.partitions == 4 and r.total_rows == D.table(spark, sf_small, "lineitem").count()


def test_from_pandas_schema_sample(spark):
    import pandas as pd
    pdf = pd.DataFrame({"a": range(2000), "b": [1.5] * 2000})
    s = SRC.schema_from_sample(spark, pdf, 1000)
    assert [(f.name, f.dataType.simpleString()) for f in s.fields] == [("a", "bigint"), ("b", "double")]


def test_job07_ingest_months_from_files(spark, sf_small, tmp):
    from fareflow.plans.loading import ingest_months
    y = D.raw_yellow(spark, sf_small)
    g = D.raw_green(spark, sf_small)
    for m in ("1998-01", "1998-02"):
        y.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == m).write.parquet(
            f"{tmp}/yellow_tripdata_{m}.parquet")
    g.filter(F.date_format("lpep_pickup_datetime", "yyyy-MM") == "1998-02").write.parquet(
        f"{tmp}/green_tripdata_1998-02.parquet")
    df = ingest_months(spark, tmp, ["yellow", "green"], "1998-01-01", "1998-03-01", "2024-06-01 00:00:00")
    from fareflow.plans.models import INGEST_TYPES
    assert df.columns == list(INGEST_TYPES)
    got = {r.taxi_type: r.n for r in df.groupBy("taxi_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    want_y = y.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM").isin("1998-01", "1998-02")).count()
    want_g = g.filter(F.date_format("lpep_pickup_datetime", "yyyy-MM") == "1998-02").count()
    assert got == {"yellow": want_y, "green": want_g}
    assert df.filter(F.col("taxi_type") == "green").filter(F.col("airport_fee").isNotNull()).count() == 0
    none = ingest_months(spark, tmp, ["fhv"], "1998-01-01", "1998-03-01", "2024-06-01 00:00:00")
    assert none.columns == list(INGEST_TYPES) and none.count() == 0


def test_job08_row_id_merge_load_is_rerun_safe(spark, sf_small, tmp):
    from fareflow.plans.loading import row_id_merge_load
    y = D.raw_yellow(spark, sf_small)
    jan = y.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == "1998-01")
    feb = y.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == "1998-02")
    p = f"{tmp}/yellow_tripdata"
    n1 = row_id_merge_load(spark, jan, p, "yellow", "yellow_tripdata_1998-01.csv")
    n2 = row_id_merge_load(spark, feb, p, "yellow", "yellow_tripdata_1998-02.csv")
    n3 = row_id_merge_load(spark, jan, p, "yellow", "yellow_tripdata_1998-01.csv")
    assert (n1, n2, n3) == (jan.count(), feb.count(), 0)
    t = spark.read.parquet(p)
    assert t.count() == n1 + n2 and t.columns[:2] == ["unique_row_id", "filename"]
    b = f"{tmp}/yellow_bq"
    row_id_merge_load(spark, jan, b, "yellow", "f.csv", binary_id=True)
    assert dict(spark.read.parquet(b).dtypes)["unique_row_id"] == "binary"


def test_job10_csv_to_parquet(spark, sf_small, tmp):
    from fareflow.plans.loading import convert_csv_to_parquet
    y = D.raw_yellow(spark, sf_small)
    SNK.write(y, f"{tmp}/csv", fmt="csv", mode="overwrite", header=True, compression="gzip")
    convert_csv_to_parquet(spark, f"{tmp}/csv", YELLOW_SCHEMA, "tpep_pickup_datetime", f"{tmp}/pq", partitions=4)
    back = spark.read.parquet(f"{tmp}/pq").drop("year", "month")
    assert back.exceptAll(y).count() == 0 and back.count() == y.count()


def test_job13_rebuild_store_then_search(spark, sf_small, tmp):
    from fareflow.plans.retrieval import rebuild_store, search
    emb = D.table(spark, sf_small, "embeddings")
    p = f"{tmp}/store"
    rebuild_store(emb, p)
    rebuild_store(emb, p)  # drop: true — a rebuild replaces, never appends
    assert spark.read.parquet(p).count() == emb.count()
    queries = emb.groupBy("label").agg(F.first("embedding").alias("qv")).withColumnRenamed("label", "query_id")
    hits = search(spark, p, queries, 3)
    assert hits.count() == 3 * queries.count()
    assert hits.filter(F.col("rank") == 1).filter(F.col("score") < 0.999).count() == 0
