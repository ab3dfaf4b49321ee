"""Text expressions: trimming, implied decimals, names, canonical text of any column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Words that may not be column names, and the suffix they get.
RESERVED_WORDS = ["select", "order", "by", "from", "where", "having"]
RESERVED_SUFFIX = "1"


def collapse_blanks(c: Column) -> Column:
    """Trimmed, inner runs of blanks as one; the pattern only runs where there are two in a row."""
    text = F.trim(c)
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " +", " ")).otherwise(text)


def delimiter_safe(c: Column) -> Column:
    """Text that survives a pipe-delimited, line-oriented dump; empty text becomes null."""
    return F.nullif(F.translate(c.cast("string"), "|\n\r", ":  "), F.lit(""))


def cleanse_record(c: Column) -> Column:
    """A record cut at its separator: no line breaks, no double quotes, no pipes but the field marks."""
    flat = F.regexp_replace(c, "\r\n|\r|\n", " ")
    safe = F.translate(flat, "\"|", "':")
    return F.replace(F.replace(safe, F.lit("~:~"), F.lit("|")), F.lit("\0"), F.lit(""))


def implied_decimal(c: Column, scale: int | None) -> Column:
    """Put the decimal point ``scale`` digits from the right; text that is not all digits stays as it is.

    The expression is kept short on purpose: a layout repeats it for every field, and a generated method
    that grows too long is not compiled by the JVM.
    """
    if scale is None or scale < 0:
        return c
    text = c
    if scale:
        digits = F.concat(F.lit("0" * scale), c)
        text = F.concat(F.substr(digits, F.lit(1), F.length(c)), F.lit("."), F.right(digits, F.lit(scale)))
    plain = text.try_cast(T.DecimalType(38, scale)).cast("string")
    return F.when(c.rlike("^[0-9]+$"), F.coalesce(plain, F.regexp_replace(text, "^0+(?=[0-9])", ""))).otherwise(c)


def implied_decimal_value(c: Column, scale: int) -> Column:
    """The same as a DECIMAL; null where the text is not a number."""
    return implied_decimal(c, scale).try_cast(T.DecimalType(38, max(scale, 0)))


# The digits after the point of a picture: nines behind its last V, each alone or with a count in brackets.
PICTURE_DIGITS = r"(?i)V((?:\s*9(?:\s*\(\s*[0-9]+\s*\))?)*)[^A-Z0-9()]*$"
PICTURE_DIGIT = r"9(?:\s*\(\s*([0-9]+)\s*\))?"


def picture_decimals(picture: str) -> int:
    """Decimal places of a picture such as ``9(5)V99``; 0 for one without a point or with other signs behind it."""
    found = re.search(PICTURE_DIGITS, picture)
    return sum(int(n or 1) for n in re.findall(PICTURE_DIGIT, found[1])) if found else 0


def picture_scale(c: Column) -> Column:
    """The same for a column of pictures; 0 for null."""
    digits = F.regexp_extract_all(F.regexp_extract(c, PICTURE_DIGITS, 1), F.lit(PICTURE_DIGIT), F.lit(1))
    places = F.aggregate(digits, F.lit(0), lambda total, n: total + F.coalesce(n.try_cast("int"), F.lit(1)))
    return F.coalesce(places, F.lit(0))


def snake_case(c: Column) -> Column:
    """``orderKey`` to ``ORDER_KEY``; a leading digit gets an underscore, ``#`` becomes one."""
    split = F.regexp_replace(c, "([a-z])([A-Z])", "$1_$2")
    marked = F.when(split.rlike("^[0-9]"), F.concat(F.lit("_"), split)).otherwise(split)
    return F.upper(F.replace(marked, F.lit("#"), F.lit("_")))


def normalize_name(name: str, lower: bool = False) -> str:
    """Blanks and signs become one underscore; the lower-case variant also drops brackets and quotes."""
    if lower:
        name = re.sub(r"[\[\]\"]", "", name.strip().lower())
    return re.sub(r"\W+", "_", name.strip())


def safe_name(name: str) -> str:
    return name + RESERVED_SUFFIX if name.lower() in RESERVED_WORDS else name


def canonical_text(df: DataFrame, name: str) -> Column:
    """Text of a column that hashes alike in other engines: plain decimals, no exponents."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        plain = c.cast("string").try_cast(T.DecimalType(38, 18)).cast("string")
        trimmed = F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")
        return F.coalesce(F.when(trimmed == "", "0").otherwise(trimmed), c.cast("string"))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")
