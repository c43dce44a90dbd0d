"""Collects the queries of the catalog and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from drayage.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its DuckDB counterpart."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        QUERIES[fn.__name__] = run
        SQL[fn.__name__] = sql
        return fn

    return register
