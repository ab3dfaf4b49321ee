"""JSON and variant expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T


def schema_from_prototype(prototype: Mapping) -> T.StructType:
    """A schema by example: null is text, a dict a struct, a list an array of its first item."""

    def kind(value):
        if value is None:
            return T.StringType()
        if isinstance(value, Mapping):
            return schema_from_prototype(value)
        if isinstance(value, list):
            return T.ArrayType(kind(value[0]), True)
        return value

    return T.StructType([T.StructField(name, kind(value), True) for name, value in prototype.items()])


def variant_columns(variant: Column, names: Sequence[str], type_name: str = "string") -> list[Column]:
    return [F.try_variant_get(variant, f"$.{name}", type_name).alias(name) for name in names]
