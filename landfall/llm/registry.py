"""The queries of this subpackage by name, with their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql is not None:
            _SQL[function.__name__] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
