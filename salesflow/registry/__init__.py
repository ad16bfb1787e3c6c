"""Registered queries: one per operator of the inventory, each with the
SQL text an independent engine runs on the same tables as an oracle.

Every query takes ``(spark, sf_dir)``, reads the whole driver tables
(or what Spark derives from them) and returns a DataFrame whose columns
have the same names as the oracle's.  Money leaves as DOUBLE, counts as
BIGINT, dates as ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}
_MODULES = ("kpis", "quality", "enrich", "reports", "consolidate", "monitoring",
            "sources", "sinks", "functions", "streams", "jobs", "digests", "ledger", "ids")
_loaded = False


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with its oracle ``sql``
    (None when no SQL oracle exists)."""
    def deco(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def _load() -> None:
    global _loaded
    if _loaded:
        return
    for m in _MODULES:
        importlib.import_module(f"salesflow.registry.q_{m}")
    _loaded = True


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
