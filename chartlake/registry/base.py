"""The register that the query modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register
