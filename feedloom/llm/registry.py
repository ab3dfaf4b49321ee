"""The queries of this subpackage, by name; kept apart from those of ``plans``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.plans.registry import Query, table

__all__ = ["QUERIES", "query", "table"]

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = Query(name, run, sql)
        return run

    return add
