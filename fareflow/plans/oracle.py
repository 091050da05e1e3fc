"""DuckDB SQL mirror of ``sources/driver.py`` and ``plans/inputs.py``.

``sql(body, extra)`` prefixes a query with the base CTEs so each oracle
string in the catalog is self-contained over the driver's views.
"""

from __future__ import annotations

from fareflow.sources.driver import GREEN_COLUMNS, YELLOW_COLUMNS

# Fixed values, written here a second time on purpose: an error in the code
# under test must not reach its own oracle.
PAYMENT_DESCRIPTIONS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute",
                        5: "Unknown", 6: "Voided trip"}
PAYMENT_OTHER = "Other"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
PAYMENT_LOOKUP = [(0, "flex_fare"), (1, "credit_card"), (2, "cash"), (3, "no_charge"),
                  (4, "dispute"), (5, "unknown"), (6, "voided_trip")]
EXTRA, TOLLS, IMPROVEMENT = "0.50", "0.00", "0.30"
CONGESTION = {True: "0.00", False: "2.50"}
FIXED_PART = {True: "0.80", False: "3.30"}
FIRST_EXTRACT, REFETCH_EXTRACT = "2024-06-01 00:00:00", "2024-06-02 00:00:00"

_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_TIP = f"CAST({_PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))"
_TAX = f"CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))"
_PICKUP = "(l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)))"
_DROPOFF = f"({_PICKUP} + to_minutes(CAST(CAST(l_quantity AS INTEGER) AS BIGINT)))"


def _raw(green: bool) -> str:
    fixed = FIXED_PART[green]
    p = "lpep" if green else "tpep"
    cols = {
        "VendorID": "CAST(NULLIF(l_suppkey % 5, 0) AS INTEGER)",
        f"{p}_pickup_datetime": _PICKUP,
        f"{p}_dropoff_datetime": _DROPOFF,
        "store_and_fwd_flag": "CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END",
        "RatecodeID": "CAST(l_partkey % 6 + 1 AS INTEGER)",
        "PULocationID": "CAST(s_nationkey AS INTEGER)",
        "DOLocationID": "CAST(c_nationkey AS INTEGER)",
        "passenger_count": "CAST(l_linenumber AS INTEGER)",
        "trip_distance": "CAST(l_quantity AS DOUBLE)",
        "fare_amount": f"CAST({_PRICE} AS DOUBLE)",
        "extra": f"CAST({EXTRA} AS DOUBLE)",
        "mta_tax": f"CAST({_TAX} AS DOUBLE)",
        "tip_amount": f"CAST({_TIP} AS DOUBLE)",
        "tolls_amount": f"CAST({TOLLS} AS DOUBLE)",
        "ehail_fee": "CAST(NULL AS DOUBLE)",
        "improvement_surcharge": f"CAST({IMPROVEMENT} AS DOUBLE)",
        "total_amount": f"CAST(CAST({_PRICE} + {_TIP} + {_TAX} + CAST('{fixed}' AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS DOUBLE)",
        "payment_type": "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)",
        "trip_type": "CAST(l_orderkey % 2 + 1 AS INTEGER)",
        "congestion_surcharge": f"CAST({CONGESTION[green]} AS DOUBLE)",
    }
    order = GREEN_COLUMNS if green else YELLOW_COLUMNS
    return ", ".join(f"{cols[c]} AS {c}" for c in order)


def _payment_values() -> str:
    return ", ".join(f"({k}, '{v}')" for k, v in PAYMENT_LOOKUP)


def _payment_case(c: str) -> str:
    whens = " ".join(f"WHEN {c} = {k} THEN '{v}'" for k, v in PAYMENT_DESCRIPTIONS.items())
    return f"CASE {whens} ELSE '{PAYMENT_OTHER}' END"


def surrogate(cols: list[str], decimals: dict[str, bool] | None = None) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '{SURROGATE_NULL}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


_STG_COMMON = """
    CAST(VendorID AS INTEGER) AS vendor_id,
    CAST(RatecodeID AS INTEGER) AS ratecode_id,
    CAST(PULocationID AS INTEGER) AS pickup_location_id,
    CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    CAST({p}_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST({p}_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    store_and_fwd_flag,
    CAST(passenger_count AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DECIMAL(18,3)) AS trip_distance,
    {trip_type} AS trip_type,
    CAST(fare_amount AS DECIMAL(18,3)) AS fare_amount,
    CAST(extra AS DECIMAL(18,3)) AS extra,
    CAST(mta_tax AS DECIMAL(18,3)) AS mta_tax,
    CAST(tip_amount AS DECIMAL(18,3)) AS tip_amount,
    CAST(tolls_amount AS DECIMAL(18,3)) AS tolls_amount,
    {ehail} AS ehail_fee,
    CAST(improvement_surcharge AS DECIMAL(18,3)) AS improvement_surcharge,
    CAST(total_amount AS DECIMAL(18,3)) AS total_amount,
    CAST(payment_type AS INTEGER) AS payment_type,
    '{service}' AS service_type
"""

_FCT_KEY = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
            "dropoff_location_id", "trip_distance"]
_UNION_COLS = ["vendor_id", "ratecode_id", "pickup_location_id", "dropoff_location_id",
               "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
               "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
               "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
               "payment_type", "service_type"]


def tiebreak(order_first: list[str], keys: list[str], cols: list[str], desc: bool = False) -> str:
    """ORDER BY matching ``keep_first``: order columns, then all others."""
    rest = [c for c in cols if c not in keys and c not in order_first]
    d = "DESC NULLS LAST" if desc else "ASC NULLS FIRST"
    return ", ".join(f"{c} {d}" for c in order_first + rest)


_INGEST_COLS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
                "trip_distance", "pickup_location_id", "dropoff_location_id", "rate_code_id",
                "store_and_fwd_flag", "payment_type", "fare_amount", "extra", "mta_tax",
                "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
                "congestion_surcharge", "airport_fee", "taxi_type", "extracted_at"]
_STAGING_KEY = ["pickup_datetime", "dropoff_datetime", "pickup_location_id",
                "dropoff_location_id", "fare_amount"]


def _ingest(src: str, taxi: str, fee: str) -> str:
    return f"""
    SELECT CAST(VendorID AS INTEGER) AS vendor_id,
           CAST({'lpep' if taxi == 'green' else 'tpep'}_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
           CAST({'lpep' if taxi == 'green' else 'tpep'}_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
           CAST(passenger_count AS DOUBLE) AS passenger_count,
           CAST(trip_distance AS DOUBLE) AS trip_distance,
           CAST(PULocationID AS INTEGER) AS pickup_location_id,
           CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
           CAST(RatecodeID AS DOUBLE) AS rate_code_id,
           store_and_fwd_flag,
           CAST(payment_type AS INTEGER) AS payment_type,
           fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
           total_amount, congestion_surcharge,
           CAST({fee} AS DOUBLE) AS airport_fee,
           '{taxi}' AS taxi_type,
           x.extracted_at
    FROM {src}
    CROSS JOIN LATERAL (SELECT unnest(CASE WHEN passenger_count = 1
        THEN [TIMESTAMP '{FIRST_EXTRACT}', TIMESTAMP '{REFETCH_EXTRACT}']
        ELSE [TIMESTAMP '{FIRST_EXTRACT}'] END) AS extracted_at) x
    """


ALL_START = "1990-01-01 00:00:00"
ALL_END = "2030-01-01 00:00:00"


def base_ctes(start: str = ALL_START, end: str = ALL_END) -> str:
    fct_cols = ", ".join(_UNION_COLS)
    return f"""
trip_lines AS (
    SELECT l.*, o.o_custkey, o.o_orderpriority, c.c_nationkey, s.s_nationkey
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw_green AS (SELECT {_raw(True)} FROM trip_lines WHERE l_returnflag = 'A'),
raw_yellow AS (SELECT {_raw(False)} FROM trip_lines WHERE l_returnflag <> 'A'),
raw_yellow_fee AS (
    SELECT {_raw(False)}, CASE WHEN s_nationkey % 7 = 0 THEN 1.25 ELSE 0.0 END AS Airport_fee
    FROM trip_lines WHERE l_returnflag <> 'A'
),
zones AS (
    SELECT CAST(n_nationkey AS INTEGER) AS locationid, r_name AS borough, n_name AS zone,
           CASE WHEN n_regionkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
payment_lookup AS (
    SELECT * FROM (VALUES {_payment_values()}) AS t(payment_type_id, payment_type_name)
),
nb_green AS (
    SELECT * RENAME (lpep_pickup_datetime AS pickup_datetime, lpep_dropoff_datetime AS dropoff_datetime)
    FROM raw_green
),
nb_yellow AS (
    SELECT * RENAME (tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime)
    FROM raw_yellow
),
notebook_trips AS (
    SELECT VendorID, pickup_datetime, dropoff_datetime, store_and_fwd_flag, RatecodeID,
           PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra,
           mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
           payment_type, congestion_surcharge, 'green' AS service_type
    FROM nb_green
    UNION ALL
    SELECT VendorID, pickup_datetime, dropoff_datetime, store_and_fwd_flag, RatecodeID,
           PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra,
           mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
           payment_type, congestion_surcharge, 'yellow' AS service_type
    FROM nb_yellow
),
stg_green AS (
    SELECT {_STG_COMMON.format(p='lpep', trip_type='CAST(trip_type AS INTEGER)', ehail='CAST(ehail_fee AS DECIMAL(18,3))', service='green')}
    FROM raw_green WHERE VendorID IS NOT NULL
),
stg_yellow AS (
    SELECT {_STG_COMMON.format(p='tpep', trip_type='CAST(1 AS INTEGER)', ehail='CAST(0 AS DECIMAL(18,3))', service='yellow')}
    FROM raw_yellow WHERE VendorID IS NOT NULL
),
int_trips_unioned AS (
    SELECT {fct_cols} FROM stg_green UNION ALL SELECT {fct_cols} FROM stg_yellow
),
dim_zones AS (
    SELECT locationid AS location_id, borough, zone, service_zone FROM zones
),
fct_deduped AS (
    SELECT *, row_number() OVER (
        PARTITION BY {', '.join(_FCT_KEY)}
        ORDER BY {tiebreak(['pickup_datetime'], _FCT_KEY, _UNION_COLS)}) AS rn
    FROM int_trips_unioned
),
fct_trips AS (
    SELECT {surrogate(_FCT_KEY)} AS trip_id,
        d.vendor_id, d.ratecode_id, d.pickup_location_id,
        pz.borough AS pickup_borough, pz.zone AS pickup_zone,
        d.dropoff_location_id, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
        d.pickup_datetime, d.dropoff_datetime, d.store_and_fwd_flag, d.passenger_count,
        d.trip_distance, d.trip_type, d.fare_amount, d.extra, d.mta_tax, d.tip_amount,
        d.tolls_amount, d.ehail_fee, d.improvement_surcharge, d.total_amount, d.payment_type,
        {_payment_case('d.payment_type')} AS payment_type_description,
        d.service_type
    FROM fct_deduped d
    LEFT JOIN dim_zones pz ON d.pickup_location_id = pz.location_id
    LEFT JOIN dim_zones dz ON d.dropoff_location_id = dz.location_id
    WHERE d.rn = 1
),
ingestion_trips AS (
    {_ingest('raw_green', 'green', 'NULL')}
    UNION ALL
    {_ingest('raw_yellow_fee', 'yellow', 'Airport_fee')}
),
staging_dedup AS (
    SELECT t.*, row_number() OVER (
        PARTITION BY {', '.join(_STAGING_KEY)}
        ORDER BY {tiebreak(['extracted_at'], _STAGING_KEY, _INGEST_COLS, desc=True)}) AS row_num
    FROM ingestion_trips t
    WHERE t.pickup_datetime >= TIMESTAMP '{start}' AND t.pickup_datetime < TIMESTAMP '{end}'
      AND t.pickup_datetime IS NOT NULL AND t.dropoff_datetime IS NOT NULL
      AND t.pickup_location_id IS NOT NULL AND t.dropoff_location_id IS NOT NULL
      AND t.fare_amount IS NOT NULL AND t.fare_amount >= 0 AND t.total_amount >= 0
),
staging_trips AS (
    SELECT d.vendor_id, d.pickup_datetime, d.dropoff_datetime, d.passenger_count,
        d.trip_distance, d.pickup_location_id, d.dropoff_location_id, d.rate_code_id,
        d.store_and_fwd_flag, d.payment_type, p.payment_type_name, d.fare_amount, d.extra,
        d.mta_tax, d.tip_amount, d.tolls_amount, d.improvement_surcharge, d.total_amount,
        d.congestion_surcharge, d.airport_fee, d.taxi_type, d.extracted_at
    FROM staging_dedup d
    LEFT JOIN payment_lookup p ON d.payment_type = p.payment_type_id
    WHERE d.row_num = 1
)"""


def sql(body: str, extra_ctes: str = "", start: str = ALL_START, end: str = ALL_END) -> str:
    ctes = base_ctes(start, end)
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def avg_sql(x: str, digits: int = 4) -> str:
    """Plain average rounded half away from zero.  The nine-place decimal in
    between undoes the binary error of a mean that is an exact tie."""
    return f"CAST(round(CAST(avg(CAST({x} AS DOUBLE)) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def ratio_sql(num: str, den: str, digits: int = 6) -> str:
    """DuckDB twin of ``exact_ratio`` (integer arithmetic, half away from zero)."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    q = f"((2 * abs({n}) * {10 ** digits} + abs({d})) // (2 * abs({d})))"
    return (f"CASE WHEN {d} IS NULL OR {d} = 0 THEN NULL ELSE "
            f"CAST(sign({n}) * sign({d}) * {q} AS DOUBLE) / {10 ** digits} END")


# The daily report over the staging trips.
REPORT_SQL = f"""
SELECT CAST(pickup_datetime AS DATE) AS trip_date, taxi_type,
       COALESCE(payment_type_name, 'unknown') AS payment_type_name,
       COUNT(*) AS trip_count,
       CAST(COALESCE(SUM(CAST(passenger_count AS BIGINT)), 0) AS BIGINT) AS total_passengers,
       round(COALESCE(SUM(trip_distance), 0), 2) AS total_distance,
       round(COALESCE(SUM(fare_amount), 0), 2) AS total_fare,
       round(COALESCE(SUM(tip_amount), 0), 2) AS total_tips,
       round(COALESCE(SUM(total_amount), 0), 2) AS total_revenue,
       COALESCE({avg_sql("trip_distance")}, 0) AS avg_trip_distance,
       COALESCE({avg_sql("fare_amount")}, 0) AS avg_fare_per_trip
FROM staging_trips {{where}} GROUP BY 1, 2, 3"""
