"""Ordering operators: newest per group, running totals over long groups, calendar ordinals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.session import written


def newest_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, first by ``order``. Spark trims every map task to one row per key before the shuffle."""
    return nth_per_group(df, keys, order, 1)


def nth_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    return (ranked if n == 1 else ranked.where(F.col("__rn") == n)).drop("__rn")


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str | Column], value: Column, name: str
) -> DataFrame:
    """Exact running sum per key for keys of any length.

    ``bucket`` rises with the order and holds a bounded number of rows. Rows are summed within
    (key, bucket); the sums of earlier buckets, one row each, are added after. No key is ever sorted in
    one task. Keys and bucket must not be null.
    """
    part = [*keys, bucket]
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*part)
        .agg(F.sum(value).alias("__sum"))
        .select(*part, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    )
    return (
        df.withColumn(name, F.sum(value).over(inside))
        .join(offsets, part)
        .withColumn(name, F.col(name) + F.col("__before"))
        .drop("__before")
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str | Column], name: str = "row_number"
) -> DataFrame:
    """Exact row numbers per key, see :func:`running_total`."""
    return running_total(df, keys, bucket, order, F.lit(1).cast("bigint"), name)


def table_numbers(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Exact numbers from 1 over a whole table, by columns whose values together are unique.

    Spark cuts the rows into as many ranges of like size as it has partitions, whatever their values; rows are
    numbered within their range, and all that is added up in one place is a count per range.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    return row_numbers(written(ranged, "ranges"), [], "__range", order, name).drop("__range")


def priority_pick(
    df: DataFrame, keys: Sequence[str], name: Column, ranking: Sequence[Sequence[str]], rest: int = 1000
) -> DataFrame:
    """The row whose name comes first in the ranking (a list of groups of LIKE patterns); ties by name."""
    order = F.lit(rest)
    for place, patterns in reversed(list(enumerate(ranking))):
        hit = F.lit(False)
        for p in patterns:
            hit = hit | name.like(p)
        order = F.when(hit, place).otherwise(order)
    return newest_per_group(df, keys, [order.asc(), name.asc()])


def day_ordinals(calendar: DataFrame, date: str = "calendar_date", is_business: str = "is_business_day") -> DataFrame:
    """Number of each day within its month, over all days (CD) and over business days (BD)."""
    month = F.trunc(F.col(date), "month")
    w = Window.partitionBy(month).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    business = F.sum(F.col(is_business).cast("int")).over(w)
    return calendar.select(
        "*",
        F.count(F.lit(1)).over(w).alias("calendar_day"),
        F.when(F.col(is_business), business).alias("business_day"),
    )


def is_run_day(schedule: dict[str, list[int]]) -> Column:
    """Whether a day of :func:`day_ordinals` is named by a schedule such as ``{'BD': [5, 6], 'CD': [7]}``."""
    hit = F.lit(False)
    for kind, days in schedule.items():
        ordinal = {"BD": "business_day", "CD": "calendar_day"}[kind]
        hit = hit | F.coalesce(F.col(ordinal).isin(*days), F.lit(False))
    return hit


def top_rows(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    return df.orderBy(*order).limit(n)


def latest_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The value that goes with the highest order columns, per key."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))
