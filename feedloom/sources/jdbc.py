"""Relational tables over JDBC, and other connectors that follow the same reader and writer shape."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class PartitionBounds:
    """How a table scan is cut into parallel range reads."""

    column: str
    lower: str | int
    upper: str | int
    count: int


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    bounds: PartitionBounds | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. Bounded reads need a table, so a bounded query is wrapped as one."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, **(extra or {})}
    if bounds is None:
        options["dbtable" if table else "query"] = table or query
        return options
    options["dbtable"] = table or f"({query}) bounded"
    options |= {
        "partitionColumn": bounds.column,
        "lowerBound": str(bounds.lower),
        "upperBound": str(bounds.upper),
        "numPartitions": str(bounds.count),
    }
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", extra: Mapping[str, str] | None = None) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, extra=extra)).mode(mode).save()


def read_connector(spark: SparkSession, source: str, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format(source).options(**options).load()


def write_connector(df: DataFrame, source: str, options: Mapping[str, str], mode: str = "overwrite") -> None:
    df.write.format(source).options(**options).mode(mode).save()
