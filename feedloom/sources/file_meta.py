"""What a file's name says about it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.dates import parse_timestamp


@dataclass(frozen=True)
class NameDialect:
    """A pattern over the lower-cased name without extension; groups are numbered from 1, 0 is absent.

    Without a date group the time of the file counts. Feeds with names of their own pass their own dialect.
    """

    pattern: str
    date_format: str
    table: int
    date: int
    firm: int = 0
    sequence: int = 0
    full_marker: str | None = None


# The file name shapes of the feeds.
DIALECTS = {
    # <firm>_<table>_<yyyy-MM-dd>
    "firm_table_date": NameDialect(r"^([0-9]+)_([a-z]+)_([0-9]{4}-[0-9]{2}-[0-9]{2})(?:_delta)?$", "yyyy-MM-dd", 2, 3, firm=1),
    # <table>_<yyyyMMdd>
    "table_date": NameDialect(r"^(.+)_([0-9]{8})$", "yyyyMMdd", 1, 2),
    # <a>_<b>_<yyyy>_<MM>_<dd>_<sequence or full>
    "six_parts": NameDialect(r"^([^_]+_[^_]+)_([0-9]{4}_[0-9]{2}_[0-9]{2})_([^_]+)$", "yyyy_MM_dd", 1, 2, sequence=3, full_marker="full"),
    # <type><institution><yyyyMMdd><two digits>
    "type_institution": NameDialect(r"^([a-z][a-z]?)([0-9]{1,4})([0-9]{8})([0-9]{2})$", "yyyyMMdd", 1, 3, firm=2, sequence=4),
    # <three letters of the group>_<table>_<MMddyy>
    # any name at all
    "undated": NameDialect(r"^(.+)$", "", 1, 0),
    "group_prefix": NameDialect(r"^([a-z]{3})_(.+)_([0-9]{6})$", "MMddyy", 2, 3, firm=1),
}


def file_name_meta(
    df: DataFrame, name: Column, dialect: NameDialect, extensions: Sequence[str] = (), modified: Column | None = None
) -> DataFrame:
    """Add table, firm, date, sequence and load type; names that do not fit, or whose date is none, give nulls.

    With ``extensions`` (``csv``, ``.txt``) files of any other do not fit either. ``modified`` is the time of the
    file, for dialects without a date.
    """
    last = F.lower(F.element_at(F.split(name, "/"), -1))
    base = F.regexp_replace(last, r"\.[^.]*$", "")
    fits = base.rlike(dialect.pattern)
    if extensions:
        fits = fits & F.regexp_extract(last, r"\.([^.]*)$", 1).isin([e.strip().lstrip(".").lower() for e in extensions])

    def group(i: int) -> Column:
        return F.when(fits, F.regexp_extract(base, dialect.pattern, i)) if i else F.lit(None).cast("string")

    if dialect.date:
        at = parse_timestamp(group(dialect.date), dialect.date_format)
    else:
        at = F.when(fits, modified if modified is not None else F.lit(None).cast("timestamp"))
    sequence = group(dialect.sequence)
    is_full = sequence == dialect.full_marker if dialect.full_marker else F.lit(None).cast("boolean")
    valid = at.isNotNull()
    return df.select(
        "*",
        F.when(valid, group(dialect.table)).alias("table_name"),
        F.when(valid, group(dialect.firm)).alias("firm"),
        at.alias("key_datetime"),
        F.when(valid, sequence).alias("sequence_number"),
        F.when(valid, is_full).alias("is_full_load"),
    )


def with_file_meta(df: DataFrame, dialect: NameDialect, extensions: Sequence[str] = ()) -> DataFrame:
    """The same for rows just read from files."""
    read = df.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("__modified"))
    return file_name_meta(read, F.col("file_name"), dialect, extensions, F.col("__modified")).drop("__modified")
