"""Registry of queries: a Spark callable and, where SQL can say it, the same result as plain SQL text."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faremeter.plans.sql_views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; `views` lists the logical views its SQL reads."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, views.split())
        return fn

    return register


def load_all() -> None:
    from faremeter.plans import dashboards, dispatching, learning, tables, zones  # noqa: F401
