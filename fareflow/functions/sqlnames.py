"""The column helpers as SQL functions, and views over stored tables (UDF-02, LOAD-17).

For users who write plain SQL: ``create_functions`` defines the mappings of
``functions.columns`` as SQL functions, which the optimizer expands into the
same expressions; ``create_view`` names a query over a folder of Parquet files.
A view keeps its text, not its rows: files that arrive later show through.

Temporary names live in the session; others go to the session's catalog, where
views may use only functions that are there too.  Existing names are replaced.
A name is letters, digits and underscores, optionally with its database.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

from fareflow.functions import columns as C

NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _checked(name: str) -> str:
    if not NAME.fullmatch(name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(arg: str, names: Mapping[int, str], other: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in names.items())
    return f"CASE {arg} {whens} ELSE {_text(other)} END"


def functions() -> dict[str, tuple[str, str, str, str]]:
    """``name -> (arguments, result type, body, comment)``."""
    number = "try_cast(substring(code, 2) AS INT)"
    digits = f"lower(hex({number}))"
    return {
        "payment_description": ("code INT", "STRING",
                                _case("code", C.PAYMENT_DESCRIPTIONS, C.PAYMENT_OTHER),
                                "text of a payment type"),
        "vendor_name": ("id INT", "STRING", _case("id", C.VENDOR_NAMES, C.VENDOR_OTHER),
                        "name of a vendor"),
        "month_start": ("at TIMESTAMP_NTZ", "TIMESTAMP_NTZ",
                        "CAST(trunc(CAST(at AS DATE), 'month') AS TIMESTAMP_NTZ)",
                        "first moment of the month"),
        "minutes_between": ("start_at TIMESTAMP_NTZ, end_at TIMESTAMP_NTZ", "BIGINT",
                            "timestampdiff(MINUTE, start_at, end_at)", "whole minutes, truncated"),
        "base_id": ("code STRING", "STRING",
                    f"CASE WHEN {number} % 7 = 0 THEN 's/' WHEN {number} % 3 = 0 THEN 'a/' "
                    f"WHEN {number} IS NOT NULL THEN 'e/' END "
                    f"|| lpad({digits}, greatest(3, length({digits})), '0')",
                    "short id of a base number"),
    }


def create_functions(spark: SparkSession, database: str | None = None, temporary: bool = True) -> list[str]:
    """Define (or replace) all functions; their names as SQL calls them."""
    if temporary and database:
        raise ValueError("temporary functions have no database")
    made = []
    for name, (arguments, result, body, comment) in functions().items():
        full = _checked(f"{database}.{name}" if database else name)
        kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {full}({arguments}) RETURNS {result} "
                  f"COMMENT {_text(comment)} RETURN {body}")
        made.append(full)
    return made


def create_view(spark: SparkSession, name: str, path: str, select: str = "*", where: str | None = None,
                temporary: bool = True) -> str:
    """Name ``SELECT select FROM the files under path [WHERE where]``."""
    if "`" in path:
        raise ValueError("a path with a back quote cannot be named in SQL")
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {_checked(name)} AS SELECT {select} FROM parquet.`{path}`"
              + (f" WHERE {where}" if where else ""))
    return name
