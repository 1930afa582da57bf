"""Collects queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *ctes: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``name``; ``ctes`` are put in front of ``sql`` as a WITH clause."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            head = f"WITH {', '.join(c.strip() for c in ctes)} " if ctes else ""
            ORACLES[name] = head + sql.strip()
        return fn

    return add
