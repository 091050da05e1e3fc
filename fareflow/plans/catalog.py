"""Registry of named queries: Spark callable + DuckDB oracle SQL.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables.  ``oracle`` is the same computation in DuckDB SQL over the
pre-registered views, or ``None`` for operators SQL cannot express.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    oracle: str | None
    ids: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}

_MODULES = (
    "fareflow.plans.q_jobs",
    "fareflow.plans.q_relational",
    "fareflow.plans.q_loads",
    "fareflow.plans.q_io",
    "fareflow.plans.q_periods",
    "fareflow.streaming.q_streaming",
)


def query(name: str, oracle: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, oracle, tuple(ids))
        return fn
    return deco


def load() -> dict[str, Entry]:
    for m in _MODULES:
        importlib.import_module(m)
    return REGISTRY
