"""Words and columns that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: ASCII white space separates words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def carry(docs: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """``keep`` as one struct ``doc``, so that no column of the input can clash with those an operator adds."""
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(None).alias("none"))
    return docs.select(kept.alias("doc"), *[c.alias(n) for n, c in columns.items()])
