"""Spark-vs-DuckDB comparison used by tests and ``check_oracle.py``.

Mirrors the driver's gate: same row count, same column names, same
order-insensitive multiset of rows.  Values are normalised (floats to nine
significant digits, decimals to float, timestamps to ISO text) before
hashing.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

from fareflow.sources.driver import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}") + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows_hash(cols: list[str], rows: list[tuple]) -> tuple[int, str, list]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return len(rows), h, normed


def compare(spark, name: str, fn, oracle: str, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duckdb_connection(sf_dir)
    res = con.execute(oracle)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    n_s, h_s, ns = _rows_hash(s_cols, s_rows)
    n_o, h_o, no = _rows_hash(o_cols, o_rows)
    out = {
        "name": name,
        "rows_spark": n_s, "rows_oracle": n_o,
        "schema_match": sorted(s_cols) == sorted(o_cols),
        "hash_match": h_s == h_o,
    }
    if not out["schema_match"]:
        out["cols_spark"] = sorted(s_cols)
        out["cols_oracle"] = sorted(o_cols)
    if not out["hash_match"] and out["schema_match"]:
        only_s = sorted(set(ns) - set(no))[:3]
        only_o = sorted(set(no) - set(ns))[:3]
        out["sample_spark_only"] = only_s
        out["sample_oracle_only"] = only_o
    out["ok"] = out["schema_match"] and out["hash_match"] and n_s == n_o
    return out
