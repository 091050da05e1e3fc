"""Readers, writers, layouts and whole load flows as queries.

Each query writes data derived from the driver's tables under the shared
checkpoint root with the library's writers, reads it back with its readers,
and returns what a user would then see.  The oracle computes the same from the
tables directly, so a lost, stale or doubled row shows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fareflow.operators import joins as J
from fareflow.operators import layout as LY
from fareflow.operators import loads as L
from fareflow.operators import projection as P
from fareflow.plans import loading, medallion, retrieval
from fareflow.plans.catalog import query
from fareflow.plans.oracle import avg_sql, sql
from fareflow.plans.q_relational import GOLD_SQL, TOPK_SQL
from fareflow.session import path_exists, rename_path, scratch_path
from fareflow.sources import driver as D
from fareflow.sources import files as SRC
from fareflow.sources import sinks as SNK

_YELLOW_DDL = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
               "passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string, "
               "PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double, "
               "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
               "total_amount double, congestion_surcharge double")


# ---------------------------------------------------------------- readers
@query("src01_csv_as_text", ids=("SRC-01", "SNK-01", "SRC-12"),
       oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey,
       'string' AS kinds FROM orders""")
def src01(spark, sf):
    """CSV without a schema: every column is text."""
    path = scratch_path(spark, "src01")
    SNK.write(D.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"),
              path, fmt="csv", mode="overwrite", header=True)
    df = SRC.read_csv(spark, path)
    return df.withColumn("kinds", F.lit(",".join(sorted({t for _, t in df.dtypes}))))


@query("src02_csv_typed", ids=("SRC-02", "SNK-01"), oracle=sql("SELECT * FROM raw_yellow"))
def src02(spark, sf):
    """Compressed CSV read back with declared types."""
    path = scratch_path(spark, "src02")
    SNK.write(D.raw_yellow(spark, sf), path, fmt="csv", header=True, compression="gzip")
    return SRC.read_csv(spark, path, schema=_YELLOW_DDL)


@query("src03_csv_inferred", ids=("SRC-03",),
       oracle="SELECT p_brand, sum(p_size)::BIGINT AS sizes, max(p_retailprice) AS top_price FROM part GROUP BY 1")
def src03(spark, sf):
    path = scratch_path(spark, "src03")
    SNK.write(D.table(spark, sf, "part"), path, fmt="csv", header=True)
    return SRC.read_csv(spark, path, infer=True).groupBy("p_brand").agg(
        F.sum("p_size").cast("bigint").alias("sizes"), F.max("p_retailprice").alias("top_price"))


@query("src04_csv_rejects", ids=("SRC-04", "DQ-10"),
       oracle="""
SELECT 'kept' AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderpriority NOT LIKE '5%'
UNION ALL SELECT 'rejected', count(*), NULL FROM orders WHERE o_orderpriority LIKE '5%'""")
def src04(spark, sf):
    """Lines whose price does not parse (here: of priority 5) become dead letters."""
    path = scratch_path(spark, "src04")
    price = F.when(F.col("o_orderpriority").startswith("5"), F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("string"))
    D.table(spark, sf, "orders").select(F.concat_ws(",", "o_orderkey", price)).write.text(path)
    good, bad = SRC.split_rejects(SRC.read_csv(spark, path, schema="k bigint, price double",
                                               header=False, permissive=True))
    return (good.agg(F.lit("kept").alias("status"), F.count(F.lit(1)).alias("n"),
                     F.round(F.sum("price"), 2).alias("total"))
            .unionByName(bad.agg(F.lit("rejected").alias("status"), F.count(F.lit(1)).alias("n"),
                                 F.lit(None).cast("double").alias("total"))))


@query("src06_monthly_files", ids=("SRC-06", "SRC-07", "JOB-07", "SCL-21"),
       oracle=sql("""
SELECT CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS month, count(*) AS trips,
       round(sum(CASE WHEN tpep_pickup_datetime >= TIMESTAMP '1997-01-01' THEN Airport_fee END), 2) AS fees
FROM raw_yellow_fee GROUP BY 1"""))
def src06(spark, sf):
    """Monthly files whose columns differ: only those from 1997 on carry the fee."""
    from fareflow.plans.inputs import yellow_with_airport_fee
    root = scratch_path(spark, "src06")
    y = yellow_with_airport_fee(spark, sf)
    ts = F.col("tpep_pickup_datetime")
    y = y.withColumn("file", F.concat(F.lit("yellow_tripdata_"), F.date_format(ts, "yyyy-MM"),
                                      F.lit(".parquet")))
    new = F.year(ts) >= 1997
    y.filter(~new).drop("Airport_fee").write.partitionBy("file").parquet(root)
    y.filter(new).write.mode("append").partitionBy("file").parquet(root)
    for _, path in SRC.month_paths(root, ["yellow"], "1990-01-01", "2003-01-01"):
        name = path.rsplit("/", 1)[1]
        if path_exists(spark, f"{root}/file={name}"):
            rename_path(spark, f"{root}/file={name}", path)
    df = SRC.read_months(spark, root, ["yellow"], "1990-01-01", "2003-01-01")
    return df.groupBy(F.trunc(F.to_date("tpep_pickup_datetime"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("Airport_fee"), 2).alias("fees"))


@query("job11_from_json_document", ids=("JOB-11", "SRC-08", "PRJ-11", "AGG-08", "SNK-11"),
       oracle=f"""
SELECT COALESCE(CASE WHEN p_size > 45 THEN NULL ELSE p_brand END, 'N/A') AS brand,
       {avg_sql("p_retailprice", 2)} AS avg_price FROM part GROUP BY 1""")
def job11_json(spark, sf):
    """API extracts ``{products: [...]}`` (one document per container) to the report."""
    path = scratch_path(spark, "job11")
    part = D.table(spark, sf, "part").select(
        "p_container" if "p_container" in D.table(spark, sf, "part").columns else "p_type",
        F.struct(F.when(F.col("p_size") <= 45, F.col("p_brand")).alias("brand"),
                 F.col("p_retailprice").alias("price")).alias("item"))
    key = part.columns[0]
    part.groupBy(key).agg(F.collect_list("item").alias("products")).select("products") \
        .write.json(path)
    rows = SRC.read_json_array(spark, path, "products",
                               "products array<struct<brand string, price double>>", multi_line=False)
    rows = P.project_with_default(rows, ["brand", "price"])
    from fareflow.operators.aggregates import avg_rounded_desc
    return avg_rounded_desc(rows.withColumn("price", F.col("price").cast("double")), "brand", "price")


@query("src09_json_lines", ids=("SRC-09", "SNK-11"),
       oracle="SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def src09(spark, sf):
    path = scratch_path(spark, "src09")
    SNK.write(D.table(spark, sf, "events").select("event_id", "event_type", "value"), path, fmt="json")
    df = SRC.read_json(spark, path, "event_id bigint, event_type string, value double")
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                        F.round(F.sum("value"), 2).alias("total"))


@query("src10_seed", ids=("SRC-10", "SRC-11", "JON-01"),
       oracle=sql("""
SELECT z.zone, p.payment_type_name, count(*) AS trips FROM notebook_trips t
JOIN zones z ON t.PULocationID = z.locationid
LEFT JOIN payment_lookup p ON t.payment_type = p.payment_type_id GROUP BY 1, 2"""))
def src10(spark, sf):
    """Trips by two lookups: a CSV seed with declared types and literal rows."""
    from fareflow.plans.inputs import notebook_trips
    path = scratch_path(spark, "src10")
    SNK.write_single_file(D.zones(spark, sf), path, fmt="csv")
    zones = SRC.seed(spark, path, "locationid int, borough string, zone string, service_zone string")
    pay = SRC.from_rows(spark, D.PAYMENT_LOOKUP, "payment_type_id int, payment_type_name string")
    t = J.lookup_join(notebook_trips(spark, sf), zones, "PULocationID", "locationid", "inner")
    t = J.lookup_join(t, pay, "payment_type", "payment_type_id")
    return t.groupBy("zone", "payment_type_name").agg(F.count(F.lit(1)).alias("trips"))


@query("src12_schema_from_sample", ids=("SRC-12",),
       oracle="SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def src12(spark, sf):
    """A CSV read with the schema of a pandas sample (the sample is the feature)."""
    path = scratch_path(spark, "src12")
    c = D.table(spark, sf, "customer")
    SNK.write(c, path, fmt="csv", header=True)
    schema = SRC.schema_from_sample(spark, c.limit(1000).toPandas())
    return SRC.read_csv(spark, path, schema=schema).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("load15_through_bronze", ids=("LOAD-15", "SRC-15", "JOB-12"), oracle=GOLD_SQL)
def load15(spark, sf):
    """Bronze (records as JSON with load columns) → silver → gold."""
    path = scratch_path(spark, "bronze")
    medallion.bronze(D.fhvhv_raw(spark, sf), "2024-01-01 00:00:00", "fhvhv.parquet").write.parquet(path)
    landed = spark.read.parquet(path)
    silver = medallion.silver_trips(medallion.from_bronze(landed))
    return medallion.gold_daily_summary(silver, D.zones(spark, sf))


@query("src17_salt_values", ids=("SRC-17",),
       oracle="SELECT CAST(c_custkey % 8 AS INTEGER) AS salt, count(*) AS n FROM customer GROUP BY 1")
def src17(spark, sf):
    c = D.table(spark, sf, "customer").select((F.col("c_custkey") % 8).cast("int").alias("salt"))
    return SRC.salt_values(spark, 8).join(c, "salt").groupBy("salt").agg(F.count(F.lit(1)).alias("n"))


@query("src18_any_format", ids=("SRC-18",),
       oracle="SELECT s_suppkey, s_nationkey FROM supplier")
def src18(spark, sf):
    path = scratch_path(spark, "src18")
    SNK.write(D.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), path, fmt="orc")
    return SRC.read_any(spark, path, "orc")


# ---------------------------------------------------------------- writers
def _files(df):
    return df.select(F.col("_metadata.file_path").alias("f"), "*")


@query("snk02_error_if_exists", ids=("SNK-02",),
       oracle="SELECT count(*) AS n, TRUE AS second_write_refused FROM orders")
def snk02(spark, sf):
    path = scratch_path(spark, "snk02")
    o = D.table(spark, sf, "orders")
    SNK.write(o, path)
    try:
        SNK.write(o, path)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"),
                                        F.lit(refused).alias("second_write_refused"))


@query("snk03_fixed_file_count", ids=("SNK-03",),
       oracle="SELECT 4::BIGINT AS files, count(*) AS n FROM orders")
def snk03(spark, sf):
    path = scratch_path(spark, "snk03")
    SNK.write_n_files(D.table(spark, sf, "orders"), path, 4)
    return _files(spark.read.parquet(path)).agg(F.count_distinct("f").alias("files"),
                                                F.count(F.lit(1)).alias("n"))


@query("snk04_single_file_report", ids=("SNK-04", "SNK-05", "LAY-03"),
       oracle="SELECT 1::BIGINT AS files, count(*) AS n, sum(c)::BIGINT AS orders FROM "
              "(SELECT o_orderstatus, count(*) AS c FROM orders GROUP BY 1)")
def snk04(spark, sf):
    path = scratch_path(spark, "snk04")
    SNK.write_single_file(D.table(spark, sf, "orders").groupBy("o_orderstatus").count(), path, fmt="csv")
    df = SRC.read_csv(spark, path, schema="o_orderstatus string, c bigint")
    return _files(df).agg(F.count_distinct("f").alias("files"), F.count(F.lit(1)).alias("n"),
                          F.sum("c").alias("orders"))


@query("snk06_append", ids=("SNK-06", "LOAD-02"),
       oracle="SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY 1")
def snk06(spark, sf):
    path = scratch_path(spark, "snk06")
    for _ in range(2):
        L.append(D.table(spark, sf, "orders"), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("job10_csv_to_parquet", ids=("JOB-10", "SNK-07"),
       oracle=sql("""
SELECT year(tpep_pickup_datetime)::INTEGER AS year, month(tpep_pickup_datetime)::INTEGER AS month,
       count(*) AS trips, round(sum(total_amount), 2) AS total
FROM raw_yellow WHERE tpep_pickup_datetime >= TIMESTAMP '1997-01-01' GROUP BY 1, 2"""))
def job10_files(spark, sf):
    """CSV → Parquet by year and month; the second conversion replaces the
    first, months it does not hold included."""
    src, dst = scratch_path(spark, "job10-csv"), scratch_path(spark, "job10-pq")
    y = D.raw_yellow(spark, sf)
    SNK.convert_months(y, "tpep_pickup_datetime", dst)
    late = y.filter(F.col("tpep_pickup_datetime") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    SNK.write(late, src, fmt="csv", header=True, compression="gzip")
    loading.convert_csv_to_parquet(spark, src, _YELLOW_DDL, "tpep_pickup_datetime", dst, partitions=8)
    return spark.read.parquet(dst).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("total_amount"), 2).alias("total"))


@query("snk08_create_or_replace", ids=("SNK-08", "LOAD-01"),
       oracle="SELECT c_mktsegment, round(sum(c_acctbal + 1), 2) AS balance FROM customer GROUP BY 1")
def snk08(spark, sf):
    """The replaced table is an input of its own replacement."""
    path = scratch_path(spark, "snk08")
    SNK.create_or_replace(D.table(spark, sf, "customer"), path)
    again = spark.read.parquet(path).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    SNK.create_or_replace(again, path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(
        F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("snk09_capped_files", ids=("SNK-09",),
       oracle="SELECT count(*) AS n, TRUE AS within_cap FROM orders")
def snk09(spark, sf):
    path = scratch_path(spark, "snk09")
    SNK.write_capped_files(D.table(spark, sf, "orders"), path, 500)
    per = _files(spark.read.parquet(path)).groupBy("f").agg(F.count(F.lit(1)).alias("c"))
    return per.agg(F.sum("c").alias("n"), (F.max("c") <= 500).alias("within_cap"))


@query("snk14_create_if_missing", ids=("SNK-14", "SNK-13"),
       oracle="""
SELECT count(*) AS n, 'The key' AS key_comment, 'o_orderkey BIGINT,o_totalprice DOUBLE' AS ddl, FALSE AS again
FROM orders""")
def snk14(spark, sf):
    path = scratch_path(spark, "snk14")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    SNK.create_if_missing(spark, path, o.schema, {"o_orderkey": "The key"})
    again = SNK.create_if_missing(spark, path, o.schema)
    comment = spark.read.parquet(path).schema["o_orderkey"].metadata["comment"]
    L.append(o, path)
    df = spark.read.schema(o.schema).parquet(path)
    return df.agg(F.count(F.lit(1)).alias("n"), F.lit(comment).alias("key_comment"),
                  F.lit(SNK.schema_ddl(df)).alias("ddl"), F.lit(again).alias("again"))


# ---------------------------------------------------------------- loads
DAY = "1996-03-13"


@query("load10_daily_partition", ids=("LOAD-10", "LOAD-16", "SNK-10", "LAY-04"),
       oracle=f"""
SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS n,
       round(sum(CASE WHEN CAST(o_orderdate AS DATE) = DATE '{DAY}' THEN 2 ELSE 1 END * o_totalprice), 2) AS total
FROM orders GROUP BY 1""")
def load10(spark, sf):
    """A daily job rerun with another transform replaces its day alone."""
    path = scratch_path(spark, "load10")
    o = D.table(spark, sf, "orders")
    LY.write_by_date(o, path, "o_orderdate", "dt")
    L.daily_job(o, "o_orderdate", DAY, path,
                lambda d: d.withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return spark.read.parquet(path).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("load12_interval_on_partitions", ids=("LOAD-12", "LOAD-04"),
       oracle="""
SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS n FROM orders
WHERE NOT (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-03-01' AND o_orderstatus = 'O')
GROUP BY 1""")
def load12(spark, sf):
    """Two months of a date-partitioned table reloaded without open orders."""
    path = scratch_path(spark, "load12")
    o = D.table(spark, sf, "orders").withColumn("dt", F.to_date("o_orderdate"))
    LY.write_by_date(o, path, "o_orderdate", "dt")
    rerun = o.filter(F.col("o_orderstatus") != "O")
    L.replace_interval_table(spark, path, rerun, "o_orderdate", "1996-01-01 00:00:00",
                             "1996-03-01 00:00:00", "dt")
    return spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("load14_skip_if_exists", ids=("LOAD-14",),
       oracle="SELECT count(*) AS n, TRUE AS first_run, FALSE AS second_run FROM customer")
def load14(spark, sf):
    path = scratch_path(spark, "load14")
    c = D.table(spark, sf, "customer")
    first = L.skip_if_exists(spark, path, lambda: c)
    second = L.skip_if_exists(spark, path, lambda: c.unionByName(c))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.lit(first).alias("first_run"),
                                        F.lit(second).alias("second_run"))


_ID_TIMES = "COALESCE(CAST({p}_pickup_datetime AS VARCHAR), '') || COALESCE(CAST({p}_dropoff_datetime AS VARCHAR), '')"


def _id_sql(p: str, binary: bool) -> str:
    text = ("COALESCE(CAST(VendorID AS VARCHAR), '') || " + _ID_TIMES.format(p=p)
            + " || COALESCE(CAST(PULocationID AS VARCHAR), '') || COALESCE(CAST(DOLocationID AS VARCHAR), '')")
    if not binary:
        text += (" || COALESCE(CAST(CAST(fare_amount AS DECIMAL(18,3)) AS VARCHAR), '')"
                 " || COALESCE(CAST(CAST(trip_distance AS DECIMAL(18,3)) AS VARCHAR), '')")
    return f"md5({text})"


def _merge_load_sql(taxi: str, binary: bool) -> str:
    """Rows of both loads: the first file's, then unseen ids of the second."""
    p = "lpep" if taxi == "green" else "tpep"
    return sql(f"""
SELECT filename, count(*) AS n, count(DISTINCT id) AS ids FROM (
  SELECT * FROM first_load UNION ALL
  SELECT * FROM all_rows WHERE id NOT IN (SELECT id FROM first_load)) GROUP BY 1""", extra_ctes=f"""
all_rows AS (SELECT {_id_sql(p, binary)} AS id, 'all.csv' AS filename FROM raw_{taxi}),
first_load AS (SELECT {_id_sql(p, binary)} AS id, '1997.csv' AS filename FROM raw_{taxi}
               WHERE {p}_pickup_datetime < TIMESTAMP '1998-01-01')""")


def _merge_load(spark, sf, taxi, binary):
    path = scratch_path(spark, f"job08-{taxi}")
    raw = D.raw_green(spark, sf) if taxi == "green" else D.raw_yellow(spark, sf)
    ts = "lpep_pickup_datetime" if taxi == "green" else "tpep_pickup_datetime"
    early = raw.filter(F.col(ts) < F.lit("1998-01-01").cast("timestamp_ntz"))
    loading.row_id_merge_load(spark, early, path, taxi, "1997.csv", binary)
    loading.row_id_merge_load(spark, raw, path, taxi, "all.csv", binary)
    loading.row_id_merge_load(spark, raw, path, taxi, "rerun.csv", binary)
    return spark.read.parquet(path).groupBy("filename").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("unique_row_id").alias("ids"))


@query("job08_green_text_id", ids=("JOB-08", "LOAD-08"), oracle=_merge_load_sql("green", False))
def job08_green(spark, sf):
    return _merge_load(spark, sf, "green", False)


@query("job08_green_binary_id", ids=("JOB-08", "SCL-12"), oracle=_merge_load_sql("green", True))
def job08_green_binary(spark, sf):
    return _merge_load(spark, sf, "green", True)


@query("job08_yellow_binary_id", ids=("JOB-08", "SCL-12"), oracle=_merge_load_sql("yellow", True))
def job08_yellow_binary(spark, sf):
    return _merge_load(spark, sf, "yellow", True)


@query("job13_rebuild_and_search", ids=("JOB-13", "AGG-16"), oracle=TOPK_SQL)
def job13(spark, sf):
    """Rebuild the stored vectors twice (drop semantics), then search them."""
    from fareflow.plans.q_relational import label_centroids
    path = scratch_path(spark, "job13")
    emb = D.table(spark, sf, "embeddings")
    for _ in range(2):
        retrieval.rebuild_store(emb, path)
    return retrieval.search(spark, path, label_centroids(emb), 5, query_id="label")


# ---------------------------------------------------------------- layout
@query("jon14_bucketed_join", ids=("JON-14", "LAY-08"),
       oracle="""
SELECT o.o_orderstatus, count(*) AS lines, round(sum(l.l_extendedprice), 2) AS gross
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def jon14(spark, sf):
    """Both tables stored in buckets of the join key."""
    tag = scratch_path(spark, "jon14")
    names = [f"jon14_{side}_{tag.rsplit('-', 1)[1]}" for side in ("l", "o")]
    li = D.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_extendedprice")
    o = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    for name, df in zip(names, (li, o), strict=True):
        J.write_bucketed(df, name, "k", 16, f"{tag}/{name}")
    j = J.bucketed_join(spark, *names, "k")
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("lines"),
                                          F.round(F.sum("l_extendedprice"), 2).alias("gross"))


@query("lay05_clustered_dates", ids=("LAY-04", "LAY-05", "LAY-06"),
       oracle=sql("""
SELECT CAST(tpep_dropoff_datetime AS DATE) AS dropoff_date, VendorID, count(*) AS n
FROM raw_yellow GROUP BY 1, 2"""))
def lay05(spark, sf):
    path = scratch_path(spark, "lay05")
    LY.write_by_date(D.raw_yellow(spark, sf), path, "tpep_dropoff_datetime", "dropoff_date",
                     cluster_by=["VendorID"])
    return spark.read.parquet(path).groupBy("dropoff_date", "VendorID").agg(
        F.count(F.lit(1)).alias("n"))


@query("lay07_year_month", ids=("LAY-07",),
       oracle="""
SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) AS n
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1, 2""")
def lay07(spark, sf):
    """The second write holds later years only; earlier folders must go."""
    path = scratch_path(spark, "lay07")
    o = D.table(spark, sf, "orders")
    LY.write_by_year_month(o, path, "o_orderdate")
    late = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    LY.write_by_year_month(late, path, "o_orderdate")
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("lay12_compaction", ids=("LAY-12",),
       oracle="SELECT o_orderstatus, count(*) AS n, 'o_orderstatus' AS partitioned_by FROM orders GROUP BY 1")
def lay12(spark, sf):
    path = scratch_path(spark, "lay12")
    D.table(spark, sf, "orders").repartition(12).write.partitionBy("o_orderstatus").parquet(path)
    LY.compact(spark, path)
    cols = ",".join(LY.partition_columns(spark, path))
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.lit(cols).alias("partitioned_by"))


@query("lay13_archive", ids=("LAY-13",),
       oracle="""
SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'cold' ELSE 'hot' END AS part, count(*) AS n
FROM orders GROUP BY 1""")
def lay13(spark, sf):
    """The hot path is its own source; the archive job runs twice."""
    hot, cold = scratch_path(spark, "lay13-hot"), scratch_path(spark, "lay13-cold")
    D.table(spark, sf, "orders").write.parquet(hot)
    for _ in range(2):
        LY.archive_split(spark.read.parquet(hot), "o_orderdate", "1997-01-01 00:00:00", hot, cold)
    read = lambda p, t: spark.read.parquet(p).agg(F.lit(t).alias("part"),
                                                  F.count(F.lit(1)).alias("n"))
    return read(cold, "cold").unionByName(read(hot, "hot"))
