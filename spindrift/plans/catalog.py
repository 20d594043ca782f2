"""Named queries over the test tables, each with the SQL that states its expected rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "out_degree"
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and, where SQL can state its rows, that SQL."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL
