"""Names of queries, their callables and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a query, with the SQL that gives the same rows if there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(apply_settings(spark), folder)

        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return function

    return register
