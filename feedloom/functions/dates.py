"""Dates as feeds write them."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# File name suffix templates and their date patterns.
SUFFIX_FORMATS = {
    "yyyymmdd": "yyyyMMdd",
    "yyyy-mm-dd": "yyyy-MM-dd",
    "yyyymm": "yyyyMM",
    "yyyy-mm": "yyyy-MM",
    "yyyymmddhhmmss": "yyyyMMddHHmmss",
    "yyyy-mm-dd-hhmmss": "yyyy-MM-dd-HHmmss",
}
_STRFTIME = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}


def parse_timestamp(c: Column, pattern: str) -> Column:
    """Text by a date pattern, null if it does not fit. Two-digit years are 1969 to 2068."""
    at = F.try_to_timestamp(c, F.lit(pattern))
    if "yy" in pattern and "yyyy" not in pattern:
        return F.when(F.year(at) >= 2069, at - F.expr("INTERVAL 100 YEARS")).otherwise(at)
    return at


def first_date(c: Column, formats: Sequence[str]) -> Column:
    """The first format that fits, else null."""
    return F.coalesce(*[parse_timestamp(c, f) for f in formats])


# Date layouts of header lines, with the pattern of a date of eight digits and that of any other.
HEADER_LAYOUTS = {
    "MMDDYY": ("MMddyyyy", "MMddyy"),
    "MMDDYYYY": ("MMddyyyy", "MMddyyyy"),
    "MM/DD/YYYY": ("MM/dd/yyyy", "MM/dd/yyyy"),
    "YYMMDD": ("yyyyMMdd", "yyMMdd"),
    "YYYYMMDD": ("yyyyMMdd", "yyyyMMdd"),
}


def header_timestamp(c: Column, layout: str) -> Column:
    """A header date by one of the known layouts; eight digits have a four-digit year whatever the layout says."""
    eight, other = HEADER_LAYOUTS[layout.strip().upper()]
    text = F.trim(c)
    return F.when(F.length(text) == 8, parse_timestamp(text, eight)).otherwise(parse_timestamp(text, other))


def file_suffix(template: str | None, at: dt.datetime) -> str:
    """Date suffix of an outbound file name; an unknown or missing template gives none."""
    pattern = SUFFIX_FORMATS.get((template or "").lower(), "")
    return at.strftime(re.sub("yyyy|MM|dd|HH|mm|ss", lambda m: _STRFTIME[m.group()], pattern))


def parse_schedule(text: str) -> dict[str, list[int]]:
    """``BD=[5,6],CD=[7]`` to ``{'BD': [5, 6], 'CD': [7]}``."""
    found = re.findall(r"(\w+)\s*=\s*\[([^\]]*)\]", text or "")
    return {kind: [int(d) for d in days.split(",") if d.strip()] for kind, days in found}
