"""Joins, aggregates and set operators that ingestion jobs share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.operators.ranking import row_numbers
from feedloom.session import written

MAX_CHILDREN = 100_000


def join_ignoring_case(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on upper-cased keys; columns of the right side that the left has too are dropped."""
    l, r = left.alias("l"), right.alias("r")
    on = reduce(lambda a, b: a & b, [F.upper(F.col(f"l.{k}")) == F.upper(F.col(f"r.{k}")) for k in keys])
    if how in ("left_anti", "left_semi"):
        return l.join(r, on, how)
    extra = [c for c in right.columns if c.lower() not in {x.lower() for x in left.columns}]
    return l.join(r, on, how).select("l.*", *[F.col(f"r.{c}") for c in extra])


def split_matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``left`` with their match, and the rows that have none."""
    return join_ignoring_case(left, right, keys), join_ignoring_case(left, right, keys, "left_anti")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys are not in ``right``; nulls compare equal, copies stay."""
    l, r = left.alias("l"), right.select(*keys).alias("r")
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    return l.join(r, on, "left_anti")


def left_chain(root: DataFrame, steps: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """Left joins one after the other; filters on a step belong into its condition."""
    return reduce(lambda df, step: df.join(step[0], step[1], "left"), steps, root)


def part_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], max_children: int = MAX_CHILDREN
) -> DataFrame:
    """Add ``part_no``: the position of a row within its key, in ``order``, divided by ``max_children``.

    Rows are counted by a hash of the key, which is combined on the map side. Where no hash has more than
    ``max_children`` rows, as is usual, no key has, and 0 is added in the caller's own pass. Else only rows of the
    large hashes are ordered, by ranges of key and order, so no task sorts a key alone; an ordinary key that shares
    its hash with a large one is numbered with it and gets 0 there.
    """
    cell = F.xxhash64(*keys)
    big = df.groupBy(cell.alias("__big")).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > max_children).select("__big")
    big = written(big, "large-keys")
    if big.isEmpty():
        return df.withColumn("part_no", F.lit(0))
    celled = df.withColumn("__cell", cell)
    of_big = F.col("__cell") == F.col("__big")
    small = celled.join(big, of_big, "left_anti").withColumn("part_no", F.lit(0))
    named = celled.join(big, of_big, "left_semi").withColumn("__key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    ranged = named.repartitionByRange("__key", *order).withColumn("__range", F.spark_partition_id())
    numbered = row_numbers(written(ranged, "large-rows"), ["__key"], "__range", order, "__no")
    large = numbered.withColumn("part_no", F.floor((F.col("__no") - 1) / max_children).cast("int"))
    return small.unionByName(large.select(*small.columns)).drop("__cell")


def collect_records(
    df: DataFrame,
    keys: Sequence[str],
    kinds: Mapping[str, Column],
    order: Sequence[str],
    fields: Sequence[str],
    max_children: int = MAX_CHILDREN,
) -> DataFrame:
    """One row per key and ``part_no`` with one sorted array of structs per record kind.

    All kinds are gathered in a single grouping instead of one join per kind. Part p of a key holds its
    rows from position p * ``max_children`` on, in order, at most so many; so no array grows without
    bound, and the parts of a key follow each other.
    """
    item = F.struct(*order, *[f for f in fields if f not in order])
    lists = [F.sort_array(F.collect_list(F.when(rule, item))).alias(name) for name, rule in kinds.items()]
    ties = [F.xxhash64(*fields)] if fields else []
    return part_number(df, keys, [*order, *ties], max_children).groupBy(*keys, "part_no").agg(*lists)


def keys_without(df: DataFrame, group: Sequence[str], flag: Column) -> DataFrame:
    """Groups in which no row has the flag, with their row count."""
    return (
        df.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.when(flag, 1).otherwise(0)).alias("flagged"))
        .where(F.col("flagged") == 0)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def aggregated_count(df: DataFrame, name: str = "row_total") -> DataFrame:
    """Sum of the first column named like a count, else the number of rows."""
    counters = [c for c in df.columns if "count" in c.lower()]
    value = F.coalesce(F.sum(counters[0]).cast("bigint"), F.lit(0)) if counters else F.count(F.lit(1))
    return df.agg(value.alias(name))


def ordered_names(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], sep: str = ",") -> DataFrame:
    """Distinct values of each key as one text in order. Copies are dropped on the map side first."""
    item = F.struct(*order, F.col(value).alias("__v"))
    distinct = df.select(*keys, item.alias("__item")).distinct()
    texts = F.transform(F.sort_array(F.collect_list("__item")), lambda x: x["__v"].cast("string"))
    return distinct.groupBy(*keys).agg(F.array_join(texts, sep).alias(value))


def table_profile(df: DataFrame, table: str, date_columns: Sequence[str], as_of: str, days: int = 40) -> DataFrame:
    """Row total, and the date column with most rows changed in the last days: one pass over the table."""
    stats = [F.count(F.lit(1)).alias("total_rows")]
    for c in date_columns:
        recent = F.col(c) >= F.date_sub(F.lit(as_of).cast("date"), days)
        stats += [F.max(c).cast("string").alias(f"{c}__max"), F.count(F.when(recent, 1)).alias(f"{c}__recent")]
    entries = [
        F.struct(
            F.col(f"{c}__recent").alias("rows_changed"),
            F.lit(-i).alias("place"),
            F.lit(c).alias("column_name"),
            F.col(f"{c}__max").alias("max_value"),
        )
        for i, c in enumerate(date_columns)
    ]
    best = F.array_max(F.array(*entries))
    return df.agg(*stats).select(
        F.lit(table).alias("table_name"),
        "total_rows",
        best["column_name"].alias("column_name"),
        best["max_value"].alias("max_value"),
        best["rows_changed"].alias("rows_changed"),
    )


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union all in the column order of the first frame; columns it lacks are dropped."""
    return reduce(lambda a, b: a.unionByName(b.select(*first.columns)), others, first)


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keys_not_in(left: DataFrame, right: DataFrame, keys: Sequence[str], multiset: bool = False) -> DataFrame:
    """Keys of ``left`` missing in ``right``: as a set, or copy by copy."""
    if multiset:
        return left.select(*keys).exceptAll(right.select(*keys))
    return anti_join(left.select(*keys), right, keys)
