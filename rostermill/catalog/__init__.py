"""Every operator bound to the benchmark tables, with its oracle SQL.

Each query runs an operator of the library over whole tables; the SQL says
the same thing independently and is run by another engine. Modules register
their queries with :func:`query`; :func:`all_queries` gathers them.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ["sources", "sinks", "reshaping", "joins", "grouping", "expressions", "changes", "loads"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, folder)

        _QUERIES[run.__name__] = in_utc
        if sql is not None:
            _ORACLES[run.__name__] = sql
        return run

    return register


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"rostermill.catalog.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
