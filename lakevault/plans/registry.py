"""Where the query modules register their queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakevault.plans.checks import check

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, body: str | None = None, **parts: str) -> Callable[[Query], Query]:
    """Register a query; ``body`` is the checking SQL, None where SQL cannot express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if body is not None:
            CHECKS[name] = check(body, **parts)
        return fn

    return register
