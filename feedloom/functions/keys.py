"""Row keys and content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.text import canonical_text
from feedloom.types import CONTENT_HASH, NO_KEY, ROW_KEY


def row_key(df: DataFrame, keys: Sequence[str] | None, source: str, hashed: bool = True) -> Column:
    """Key columns and the source joined by ``_``; without keys every column counts and the key is hashed."""
    if not keys:
        keys, hashed = df.columns, True
    parts = [F.coalesce(canonical_text(df, c), F.lit("")) for c in keys]
    text = F.concat_ws("_", *parts, F.lit(source))
    return F.sha2(text, 256) if hashed else text


def with_row_key(
    df: DataFrame, keys: Sequence[str] | None, source: str, hashed: bool = True, name: str = ROW_KEY
) -> DataFrame:
    return df.withColumn(name, row_key(df, keys, source, hashed))


def with_md5_key(df: DataFrame, keys: Sequence[str] | None = None, name: str = "MD5_KEY") -> DataFrame:
    parts = [F.coalesce(canonical_text(df, c), F.lit("")) for c in keys or df.columns]
    return df.withColumn(name, F.md5(F.concat_ws("_", *parts)))


def content_hash(df: DataFrame, columns: Sequence[str], sep: str = "\x1f") -> Column:
    """Hash of the non-key columns. ``sep=''`` repeats the historical hash, which mixes up column borders."""
    if not columns:
        return F.lit("All columns are Primary Keys")
    return F.sha2(F.concat_ws(sep, *[F.coalesce(canonical_text(df, c), F.lit(NO_KEY)) for c in columns]), 256)


def with_content_hash(
    df: DataFrame, columns: Sequence[str], legacy: bool = False, name: str = CONTENT_HASH
) -> DataFrame:
    return df.withColumn(name, content_hash(df, columns, "" if legacy else "\x1f"))


def history_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Identity of a history row: all file columns, comma separated, null as empty."""
    return F.sha2(F.concat_ws(",", *[F.coalesce(canonical_text(df, c), F.lit("")) for c in columns]), 256)
