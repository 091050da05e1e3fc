"""The driver's tables and their mapping onto the trip data model.

The reference computes over NYC-taxi files that are not available offline.
The driver supplies TPC-H-like tables instead; the functions here derive the
taxi frames from them with plain joins and column expressions (see
same mapping in DuckDB SQL so that every query can be checked against an
independent engine.

Scale notes: ``orders ⋈ customer`` and ``lineitem ⋈ (orders ⋈ customer)``
are large-large equi-joins; they are left to the planner, which broadcasts
only what is under its byte threshold.  Building a frame starts no job beyond
reading each table's footer once per session.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# ---------------------------------------------------------------------------
# Fixed values of the mapping (constants of the synthetic taxi model).
# ---------------------------------------------------------------------------
EXTRA = Decimal("0.50")
TOLLS = Decimal("0.00")
IMPROVEMENT = Decimal("0.30")
CONGESTION_YELLOW = Decimal("2.50")
CONGESTION_GREEN = Decimal("0.00")
AIRPORT_FEE = Decimal("0.00")
# Payment seed of the Bruin pipeline, ids 0..6.
PAYMENT_LOOKUP = [
    (0, "flex_fare"),
    (1, "credit_card"),
    (2, "cash"),
    (3, "no_charge"),
    (4, "dispute"),
    (5, "unknown"),
    (6, "voided_trip"),
]
# One extraction stamp per fetched batch (S22); the re-fetch is one day later.
FIRST_EXTRACT = "2024-06-01 00:00:00"
REFETCH_EXTRACT = "2024-06-02 00:00:00"
# ---------------------------------------------------------------------------


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; its schema is read once per path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def _money(c) -> F.Column:
    # DECIMAL(12,2) keeps products with DECIMAL(4,2) rates at 17 digits, so
    # Spark computes them on longs instead of BigDecimal.
    return F.col(c).cast("decimal(12,2)")


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with everything the taxi columns derive from."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Join order is explicit (Catalyst keeps the written order without CBO
    # statistics): orders ⋈ customer first, so the fact table is shuffled
    # once on the order key and once on the supplier key, instead of a third
    # time on the customer key after its first join.
    oc = (o.join(c, o.o_custkey == c.c_custkey)
           .select("o_orderkey", "o_orderpriority", "c_nationkey"))
    return (li.join(oc, li.l_orderkey == oc.o_orderkey)
              .join(s, F.col("l_suppkey") == s.s_suppkey))


def _raw_columns(green: bool) -> dict[str, F.Column]:
    price = _money("l_extendedprice")
    tip = (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
    tax = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)")
    congestion = CONGESTION_GREEN if green else CONGESTION_YELLOW
    fixed = EXTRA + TOLLS + IMPROVEMENT + congestion
    total = (price + tip + tax + F.lit(fixed)).cast("decimal(18,2)")
    pickup = F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate"))
    dropoff = F.timestamp_add("MINUTE", F.col("l_quantity").cast("int"), pickup)
    return {
        "VendorID": F.nullif(F.col("l_suppkey") % 5, F.lit(0)).cast("int"),
        "pickup": pickup,
        "dropoff": dropoff,
        "store_and_fwd_flag": F.when(F.col("l_linestatus") == "O", F.lit("Y")).otherwise(F.lit("N")),
        "RatecodeID": (F.col("l_partkey") % 6 + 1).cast("int"),
        "PULocationID": F.col("s_nationkey").cast("int"),
        "DOLocationID": F.col("c_nationkey").cast("int"),
        "passenger_count": F.col("l_linenumber").cast("int"),
        "trip_distance": F.col("l_quantity").cast("double"),
        "fare_amount": price.cast("double"),
        "extra": F.lit(float(EXTRA)),
        "mta_tax": tax.cast("double"),
        "tip_amount": tip.cast("double"),
        "tolls_amount": F.lit(float(TOLLS)),
        "improvement_surcharge": F.lit(float(IMPROVEMENT)),
        "total_amount": total.cast("double"),
        "payment_type": F.substring("o_orderpriority", 1, 1).cast("int"),
        "trip_type": (F.col("l_orderkey") % 2 + 1).cast("int"),
        "congestion_surcharge": F.lit(float(congestion)),
    }


GREEN_COLUMNS = [
    "VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "store_and_fwd_flag",
    "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "trip_distance",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type",
    "congestion_surcharge",
]
YELLOW_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
]


def raw_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green raw trips (20 columns of the green schema): return flag 'A'."""
    cols = _raw_columns(green=True)
    cols["lpep_pickup_datetime"] = cols.pop("pickup")
    cols["lpep_dropoff_datetime"] = cols.pop("dropoff")
    cols["ehail_fee"] = F.lit(None).cast("double")
    base = trip_lines(spark, sf_dir).filter(F.col("l_returnflag") == "A")
    return base.select(*[cols[c].alias(c) for c in GREEN_COLUMNS])


def raw_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yellow raw trips (18 columns of the yellow schema): other return flags."""
    cols = _raw_columns(green=False)
    cols["tpep_pickup_datetime"] = cols.pop("pickup")
    cols["tpep_dropoff_datetime"] = cols.pop("dropoff")
    base = trip_lines(spark, sf_dir).filter(F.col("l_returnflag") != "A")
    return base.select(*[cols[c].alias(c) for c in YELLOW_COLUMNS])


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green and yellow raw trips in one frame, from one scan of the line items.

    Columns of the green schema with neutral datetime names, plus
    ``service_type`` and the yellow files' ``zone_fee``.
    """
    base = trip_lines(spark, sf_dir).filter(F.col("l_returnflag").isNotNull())
    green = F.col("l_returnflag") == "A"
    g, y = _raw_columns(green=True), _raw_columns(green=False)
    cols = {c: F.when(green, g[c]).otherwise(y[c]) if c in ("total_amount", "congestion_surcharge")
            else g[c] for c in g}
    cols["pickup_datetime"], cols["dropoff_datetime"] = cols.pop("pickup"), cols.pop("dropoff")
    cols["ehail_fee"] = F.lit(None).cast("double")
    cols["service_type"] = F.when(green, F.lit("green")).otherwise(F.lit("yellow"))
    cols["zone_fee"] = F.when(F.col("s_nationkey") % 7 == 0, F.lit(1.25)).otherwise(F.lit(0.0))
    return base.select(*[c.alias(n) for n, c in cols.items()])


def fhvhv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-volume for-hire trips (7 columns) from line items and parts.

    ``dispatching_base_num`` is ``B`` + the zero-padded part key, the input of
    the notebook's base-number UDF.
    """
    cols = _raw_columns(green=False)
    base = trip_lines(spark, sf_dir)
    return base.select(
        F.concat(F.lit("HV000"), (F.col("l_suppkey") % 5 + 2).cast("string")).alias("hvfhs_license_num"),
        F.concat(F.lit("B"), F.lpad(F.col("l_partkey").cast("string"), 5, "0")).alias("dispatching_base_num"),
        cols["pickup"].alias("pickup_datetime"),
        cols["dropoff"].alias("dropoff_datetime"),
        cols["PULocationID"].alias("PULocationID"),
        cols["DOLocationID"].alias("DOLocationID"),
        F.when(F.col("l_linestatus") == "O", F.lit("1")).alias("SR_Flag"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup (``locationid, borough, zone, service_zone``): nation ⋈ region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("int").alias("locationid"),
                     F.col("r_name").alias("borough"),
                     F.col("n_name").alias("zone"),
                     F.when(F.col("n_regionkey") % 2 == 0, F.lit("Boro Zone"))
                      .otherwise(F.lit("Yellow Zone")).alias("service_zone")))


def payment_lookup(spark: SparkSession) -> DataFrame:
    """The 7-row payment seed (``payment_type_id int, payment_type_name string``)."""
    return spark.createDataFrame(PAYMENT_LOOKUP, "payment_type_id int, payment_type_name string")


def customers_as_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``employees``/``players`` stand-in: name, age, department from customers."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_name").alias("name"),
                    (F.col("c_custkey") % 40 + 20).alias("age"),
                    F.col("c_mktsegment").alias("department"))
