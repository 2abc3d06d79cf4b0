"""Query registry: name -> (spark callable, optional DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent DuckDB statement (omit when
    the operator is not expressible in SQL; it is then unit-tested)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            from .sqlparts import bigint_counts
            ORACLES[name] = bigint_counts(sql.strip())
        return fn
    return deco
