"""Raw JSON as VARIANT columns (SRC-15, SCL-20, PRJ-11).

Bronze keeps each record parsed once into a VARIANT, whatever its shape; silver
takes typed fields out of it by path.  Records that are no JSON go to the dead
letters with their text; a field that is there but does not fit its type is NULL
in silver and named in ``unfit``, so a type change upstream shows and loses no
row.  Everything is a built-in expression over one row.

Defined results: NULL text has a NULL record and is not malformed; an empty text
is malformed; a JSON null, a missing field and a NULL record give NULL and are
not unfit; of a key repeated inside one object the text is malformed.  Fields may
have any name, input columns that ``silver`` would clash with are refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = "record"
UNFIT = "unfit"


def bronze(df: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(records, dead letters)``: the rows with ``record`` in place of the text,
    and the rows whose text is no JSON, as they came."""
    if RECORD in df.columns:
        raise ValueError(f"the input has a column {RECORD}")
    text = df[f"`{text_col}`"]
    bad = text.isNotNull() & F.try_parse_json(text).isNull()
    kept = [df[f"`{c}`"] for c in df.columns if c != text_col]
    return (df.filter(~bad).select(*kept, F.try_parse_json(text).alias(RECORD)), df.filter(bad))


def _found(path: str, record: Column) -> Column:
    return F.try_variant_get(record, path, "variant")


def silver(records: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns ``name -> (path, type)`` in place of ``record``, and ``unfit``:
    the names of the fields whose value does not fit."""
    kept = [c for c in records.columns if c != RECORD]
    if clash := ({*fields, UNFIT} & set(kept)):
        raise ValueError(f"columns {sorted(clash)} are both in the input and asked for")
    r = F.col(RECORD)
    values, misses = [], []
    for name, (path, kind) in fields.items():
        value, found = F.try_variant_get(r, path, kind), _found(path, r)
        values.append(value.alias(name))
        misses.append(F.when(found.isNotNull() & ~F.is_variant_null(found) & value.isNull(), F.lit(name)))
    unfit = F.array_compact(F.array(*misses)) if misses else F.array().cast("array<string>")
    return records.select(*[F.col(f"`{c}`") for c in kept], *values, unfit.alias(UNFIT))


def merged_schema(records: DataFrame) -> DataFrame:
    """One row: the ``schema`` that all records have in common."""
    return records.agg(F.schema_of_variant_agg(RECORD).alias("schema"))


def shapes(records: DataFrame, path: str) -> DataFrame:
    """``shape, n``: the types a path has had, NULL where it is missing."""
    return (records.groupBy(F.schema_of_variant(_found(path, F.col(RECORD))).alias("shape"))
            .agg(F.count(F.lit(1)).alias("n")))
