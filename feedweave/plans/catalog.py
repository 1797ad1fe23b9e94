"""Registry of the queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def load() -> None:
    """Import every module that registers queries."""
    from feedweave.plans import (  # noqa: F401
        queries_identity,
        queries_input,
        queries_operations,
        queries_quality,
        queries_reads,
        queries_sources,
    )
