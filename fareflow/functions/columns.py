"""Scalar column helpers (SCL-*) and the UDF surface (UDF-*).

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage code generation; the base-number UDF of the reference
(UDF-01) is the native expression of SCL-19.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Payment description CASE of the fact model (1..6, everything else 'Other').
PAYMENT_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_OTHER = "Other"
# Vendor-name macro (ids 1, 2, 4; everything else 'Unknown').
VENDOR_NAMES = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
    4: "Unknown Vendor",
}
VENDOR_OTHER = "Unknown"
# Null sentinel and separator of the surrogate-key macro.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
# Numeric scales (S1): dbt track and BigQuery track.
DBT_DECIMAL = "decimal(18,3)"
BQ_DECIMAL = "decimal(38,9)"
# Numbers inside hash keys: three places (prints like DECIMAL(18,3)), wide
# enough that no double in range overflows the cast (S9).
KEY_DECIMAL = "decimal(38,3)"
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# SCL-01 -------------------------------------------------------------------
def to_numeric(c: str | Column, track: str = "dbt") -> Column:
    """``cast(x as numeric)`` with the scale made explicit (S1)."""
    return col(c).cast(DBT_DECIMAL if track == "dbt" else BQ_DECIMAL)


def round_to_int(c: str | Column) -> Column:
    """Float → int the way the SQL engines of the reference do it (S2).

    Plain ``cast`` truncates in Spark; DuckDB rounds half to even.
    """
    return F.bround(col(c)).cast("int")


def floor_div(c: str | Column, n: int) -> Column:
    """``floor(c / n)`` of a long in integer arithmetic, as long."""
    return F.call_function("div", col(c) - F.pmod(col(c), F.lit(n).cast("long")),
                           F.lit(n).cast("long"))


def try_int(c: str | Column) -> Column:
    """Lenient cast for dirty text (S3): NULL instead of an error."""
    return F.expr(f"try_cast({_sql(c)} as int)")


def try_timestamp(c: str | Column) -> Column:
    return F.expr(f"try_cast({_sql(c)} as timestamp_ntz)")


def _sql(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("try_* helpers take a column name")


# SCL-02 / SCL-04 ------------------------------------------------------------
def day_of(c: str | Column) -> Column:
    """``to_date`` / BigQuery ``DATE(ts)``."""
    return F.to_date(col(c))


# SCL-03 ---------------------------------------------------------------------
def month_start(c: str | Column) -> Column:
    """``date_trunc('month', ts)`` kept as a zone-free timestamp (S19).

    Truncating through ``DATE`` avoids the session-time-zone round trip that
    ``date_trunc`` takes on ``TIMESTAMP_NTZ`` input.
    """
    return F.trunc(F.to_date(col(c)), "month").cast("timestamp_ntz")


# SCL-05 / SCL-06 -------------------------------------------------------------
def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated (S5)."""
    return F.timestamp_diff("MINUTE", col(start), col(end))


def hour_of(c: str | Column) -> Column:
    return F.hour(col(c))


# SCL-07 / SCL-08 / SCL-09 / UDF-02 -------------------------------------------
def payment_description(c: str | Column) -> Column:
    """Searched CASE of the fact model: NULL and 0 fall into 'Other' (S13)."""
    out = None
    for k, v in PAYMENT_DESCRIPTIONS.items():
        out = (F.when(col(c) == k, F.lit(v)) if out is None
               else out.when(col(c) == k, F.lit(v)))
    return out.otherwise(F.lit(PAYMENT_OTHER))


def vendor_name(c: str | Column) -> Column:
    """The vendor-name macro as a reusable ``Column`` function."""
    out = None
    for k, v in VENDOR_NAMES.items():
        out = (F.when(col(c) == k, F.lit(v)) if out is None
               else out.when(col(c) == k, F.lit(v)))
    return out.otherwise(F.lit(VENDOR_OTHER))


# SCL-10 ---------------------------------------------------------------------
def round_to(c: str | Column, digits: int = 2) -> Column:
    return F.round(col(c), digits)


# Hash keys (SCL-11/12/13) -----------------------------------------------------
def _key_text(df: DataFrame, name: str, numeric: str) -> Column:
    """Text form of one key column that prints the same in Spark and SQL (S9)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        c = c.cast(numeric)
    return c.cast("string")


def row_id_text(df: DataFrame, cols: Sequence[str], numeric: str = KEY_DECIMAL) -> Column:
    """SCL-11: md5 over the undelimited concatenation, NULL → '' (faithful, S8)."""
    parts = [F.coalesce(_key_text(df, c, numeric), F.lit("")) for c in cols]
    return F.md5(F.concat(*parts))


def row_id_text_delimited(df: DataFrame, cols: Sequence[str],
                          numeric: str = KEY_DECIMAL, sep: str = "\u001f") -> Column:
    """Collision-free variant of SCL-11: a unit separator between fields."""
    parts = [F.coalesce(_key_text(df, c, numeric), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def row_id_binary(df: DataFrame, cols: Sequence[str], numeric: str = BQ_DECIMAL) -> Column:
    """SCL-12: the same digest as 16 raw bytes (BigQuery ``MD5`` returns BYTES)."""
    return F.unhex(row_id_text(df, cols, numeric))


def surrogate_key(df: DataFrame, cols: Sequence[str], numeric: str = KEY_DECIMAL) -> Column:
    """SCL-13: md5 of fields joined by '-', NULL → sentinel (S10)."""
    parts = [F.coalesce(_key_text(df, c, numeric), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


# SCL-14 / SCL-15 / SCL-17 -------------------------------------------------------
def concat_with(sep: str, *cols: str | Column) -> Column:
    return F.concat_ws(sep, *[col(c) for c in cols])


def hash_bucket(n: int, *cols: str | Column) -> Column:
    """Deterministic bucket in ``[0, n)``: retried tasks land rows in the same bucket.

    Used instead of ``rand()`` for salting so that a lost executor's recomputed
    partition produces identical output (SCL-15).
    """
    return F.pmod(F.xxhash64(*[col(c) for c in cols]), F.lit(n)).cast("int")


def split_part(c: str | Column, sep: str, index: int) -> Column:
    """``split(c, sep)[index]`` (0-based)."""
    return F.split(col(c), sep).getItem(index)


# SCL-16 -------------------------------------------------------------------------
def load_stamp(ts: str) -> Column:
    """One literal extraction time per fetched file (S22)."""
    return F.lit(ts).cast("timestamp_ntz")


def source_file_name() -> Column:
    """File name of the row's input file, from the hidden metadata column."""
    return F.col("_metadata.file_name")


def source_file_path() -> Column:
    return F.col("_metadata.file_path")


# SCL-19 / UDF-01 -------------------------------------------------------------------
def base_id(c: str | Column) -> Column:
    """Native form of the notebook's base-number UDF.

    ``B02884`` → number 2884; divisible by 7 → ``s/``, else by 3 → ``a/``,
    else ``e/``; then the number in lower-case hex padded (never truncated)
    to three digits (S18).  NULL or a non-numeric body → NULL (the Python
    original raises, which would fail a whole job on one dirty row).
    """
    num = F.substring(col(c), 2, 1 << 30).try_cast("int")
    hx = F.lower(F.hex(num))
    padded = F.lpad(hx, F.greatest(F.lit(3), F.length(hx)), F.lit("0"))
    prefix = (F.when(num % 7 == 0, F.lit("s/"))
              .when(num % 3 == 0, F.lit("a/"))
              .otherwise(F.lit("e/")))
    return F.when(num.isNull(), F.lit(None).cast("string")).otherwise(F.concat(prefix, padded))


# SCL-20 ------------------------------------------------------------------------------
def json_field(c: str | Column, field: str, default: str | None = "N/A") -> Column:
    """``$.field`` of a JSON text column, ``default`` when absent."""
    v = F.get_json_object(col(c), f"$.{field}")
    return v if default is None else F.coalesce(v, F.lit(default))


# SCL-21 ------------------------------------------------------------------------------
def trip_file_name(taxi: str, year: int, month: int, ext: str = "csv") -> str:
    """``{taxi}_tripdata_{yyyy}-{mm}.{ext}`` for driver-side path lists."""
    return f"{taxi}_tripdata_{year:04d}-{month:02d}.{ext}"


def trip_file_name_col(taxi: str | Column, ts: str | Column, ext: str = "csv") -> Column:
    """Same template as a column, from a type column and a timestamp."""
    return F.format_string(f"%s_tripdata_%04d-%02d.{ext}", col(taxi),
                           F.year(col(ts)), F.month(col(ts)))


def coalesce_all(cols: Iterable[str], default) -> list[Column]:
    """``coalesce(c, default)`` for each name (PRJ-11)."""
    return [F.coalesce(F.col(c), F.lit(default)).alias(c) for c in cols]


# Exact averages -------------------------------------------------------------------------
def exact_avg(c: str | Column, digits: int = 4) -> Column:
    """Average rounded half away from zero to ``digits``, as DOUBLE.

    Values are taken with nine decimals (the widest numeric scale of the
    models); the sum and the one division are exact integers, so the result
    does not depend on the order rows arrive in and is rounded once.
    """
    x = col(c)
    units = (x.cast("decimal(26,9)") * F.lit(10 ** 9).cast("decimal(10,0)")).cast("decimal(36,0)")
    total, n = F.sum(units), F.count(x).cast("decimal(20,0)")
    den = (n * F.lit(10 ** (9 - digits)).cast("decimal(10,0)")).cast("decimal(30,0)")
    # floor(|total| / den + 1/2) without leaving integers.
    q = F.call_function("div", F.abs(total) * 2 + den, den * 2)
    res = F.signum(total) * q.cast("double") / F.lit(float(10 ** digits))
    return F.when(F.count(x) == 0, F.lit(None).cast("double")).otherwise(res)


def money_sum(c: str | Column) -> Column:
    """Sum of money rounded to cents once, as DOUBLE, independent of row order."""
    return F.round(F.sum(col(c).cast("decimal(28,9)")), 2).cast("double")


def exact_ratio(num: str | Column, den: str | Column, digits: int = 6) -> Column:
    """``num / den`` for integer-valued columns, rounded half away from zero
    to ``digits`` in integer arithmetic (no double rounding), as DOUBLE;
    NULL when ``den`` is 0 or NULL."""
    n = col(num).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    scaled = F.abs(n) * F.lit(10 ** digits).cast("decimal(38,0)")
    q = F.floor((scaled * 2 + F.abs(d)) / (F.abs(d) * 2))
    res = F.signum(n) * F.signum(d) * q.cast("double") / F.lit(float(10 ** digits))
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(res)
