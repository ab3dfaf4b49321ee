"""Nested tables: flattening, sub-tables, document building, keys found in JSON."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _arrays(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]


def expand_structs(df: DataFrame) -> DataFrame:
    """All struct levels to columns at once; a child that starts with ``_`` gets no second underscore."""

    def leaves(c: Column, name: str, kind: T.DataType) -> list[Column]:
        if not isinstance(kind, T.StructType):
            return [c.alias(name)]
        out = []
        for f in kind.fields:
            join = "" if f.name.startswith("_") else "_"
            out += leaves(c.getField(f.name), f"{name}{join}{f.name}", f.dataType)
        return out

    only = len(df.columns) == 1
    columns = []
    for f in df.schema.fields:
        if only and isinstance(f.dataType, T.StructType):
            for g in f.dataType.fields:
                columns += leaves(F.col(f"`{f.name}`").getField(g.name), g.name, g.dataType)
        else:
            columns += leaves(F.col(f"`{f.name}`"), f.name, f.dataType)
    return df.select(*columns)


def flatten(df: DataFrame, outer: bool = False) -> DataFrame:
    """Structs to columns and arrays to rows, as long as at most one array is left on a level.

    Rows with an empty or null array disappear unless ``outer`` is set.
    """
    explode = F.explode_outer if outer else F.explode
    while True:
        df = expand_structs(df)
        arrays = _arrays(df)
        if len(arrays) != 1:
            return df
        df = df.select(*[explode(f"`{c}`").alias(c) if c == arrays[0] else F.col(f"`{c}`") for c in df.columns])


def flatten_and_divide(df: DataFrame, name: str, outer: bool = False) -> dict[str, DataFrame]:
    """Flat tables: one per array that remains side by side, each with the text columns as its key."""
    flat = flatten(df, outer)
    arrays = _arrays(flat)
    if not arrays:
        return {name: flat}
    texts = [f.name for f in flat.schema if isinstance(f.dataType, T.StringType)]
    out: dict[str, DataFrame] = {}
    for a in arrays:
        out |= flatten_and_divide(flat.select(*texts, a), f"{name}_{a}", outer)
    return out


def renamed_items(array: Column, fields: Mapping[str, str]) -> Column:
    """An array of structs with the wanted fields under their target names."""
    return F.transform(array, lambda x: F.struct(*[x[source].alias(target) for source, target in fields.items()]))


def first_where(array: Column, rule: Callable[[Column], Column]) -> Column:
    """The first item that meets the rule, null if none does."""
    return F.get(F.filter(array, rule), 0)


def current_items(array: Column, end: str) -> Column:
    """Items whose end date is open: null or empty."""
    return F.filter(array, lambda x: x[end].isNull() | (x[end] == ""))


def closed_items(array: Column, end: str) -> Column:
    return F.filter(array, lambda x: x[end].isNotNull() & (x[end] != ""))


def joined_codes(array: Column, field: str, sep: str = ", ") -> Column:
    return F.array_join(F.transform(array, lambda x: x[field].cast("string")), sep)


Rule = Callable[[Column], Column]


def _at(item: Column, path: str) -> Column:
    """A field of a struct by its path, such as ``DtRng._toDt``."""
    return reduce(lambda c, name: c[name], path.split("."), item)


def open_ended(path: str) -> Rule:
    """The end date is open: null or empty."""
    return lambda x: _at(x, path).isNull() | (_at(x, path) == "")


def ended(path: str) -> Rule:
    return lambda x: _at(x, path).isNotNull() & (_at(x, path) != "")


def same(path: str, value: str | Column) -> Rule:
    """The field equals a value as text; null does not."""
    return lambda x: F.coalesce(_at(x, path).cast("string") == value, F.lit(False))


def every(*rules: Rule) -> Rule:
    return lambda x: reduce(lambda a, b: a & b, [rule(x) for rule in rules])


@dataclass(frozen=True)
class Part:
    """A struct of the document."""

    fields: Mapping[str, Spec]


@dataclass(frozen=True)
class Items:
    """An array of the source in the document's own fields: all items that meet the rule, or the first of them."""

    source: str
    fields: Mapping[str, Spec]
    where: Rule | None = None
    first: bool = False


@dataclass(frozen=True)
class Codes:
    """One field of all items that meet the rule as a list in one text."""

    source: str
    field: str
    where: Rule | None = None
    sep: str = ", "


Spec = str | Part | Items | Codes


def _built(spec: Spec, get: Callable[[str], Column]) -> Column:
    if isinstance(spec, str):
        return get(spec)
    if isinstance(spec, Part):
        return F.struct(*[_built(s, get).alias(name) for name, s in spec.fields.items()])
    items = get(spec.source)
    if spec.where:
        items = F.filter(items, spec.where)
    if isinstance(spec, Codes):
        return F.array_join(F.transform(items, lambda x: _at(x, spec.field).cast("string")), spec.sep)
    made = F.transform(items, lambda x: F.struct(*[_built(s, lambda path: _at(x, path)).alias(name) for name, s in spec.fields.items()]))
    return F.get(made, 0) if spec.first else made


def build_document(df: DataFrame, spec: Mapping[str, Spec]) -> DataFrame:
    """Documents from nested rows by a specification of their fields.

    A field is a path into the row, a struct, a list with its fields renamed and its items chosen by a rule (in any
    depth, several lists side by side), the first such item, or the items' codes as one text. Nothing is exploded:
    each document is made where its row is. A null list stays null.
    """
    return df.select(*[_built(s, lambda path: _at(F.col(path.split(".")[0]), path.split(".", 1)[1]) if "." in path else F.col(path)).alias(name) for name, s in spec.items()])


def json_keys(df: DataFrame, column: str) -> list[str]:
    """Names of the keys of all objects in a JSON column (an object, or an array of them), in order.

    The names are reduced on the cluster; only they come to the driver, since they are columns to be.
    """
    is_array = F.ltrim(F.col(column)).startswith("[")
    objects = F.when(is_array, F.from_json(column, "array<string>")).otherwise(F.array(F.col(column)))
    keys = df.select(F.explode(objects).alias("o")).select(F.explode(F.json_object_keys("o")).alias("k")).distinct()
    return sorted(r.k for r in keys.collect())


def json_to_columns(df: DataFrame, column: str, keep: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """One text column per key of the JSON objects in a column, one row per object."""
    names = json_keys(df, column) if names is None else names
    is_array = F.ltrim(F.col(column)).startswith("[")
    objects = F.when(is_array, F.from_json(column, "array<string>")).otherwise(F.array(F.col(column)))
    rows = df.select(*keep, F.explode(objects).alias("__o")).withColumn("__v", F.try_parse_json("__o"))
    return rows.select(*keep, *[F.try_variant_get("__v", f"$['{n}']", "string").alias(n) for n in names])
