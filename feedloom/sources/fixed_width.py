"""Fixed-width records: layouts in three dialects, and the parser they drive."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.text import collapse_blanks, implied_decimal, normalize_name, picture_decimals
from feedloom.session import written
from feedloom.types import FieldSpec

# Names that mark a field as filler.
FILLERS = ("", "filler", "unused", "not_used", "reserved")


def _scale(text: object) -> int | None:
    text = str(text or "").strip()
    return int(text) if text.isdigit() else None


def _keep(name: str) -> bool:
    return name.strip("_") not in FILLERS and not name.startswith("filler")


def layout_from_positions(rows: Iterable[Mapping[str, str]]) -> list[FieldSpec]:
    """Rows with ``position`` such as ``001-018``; a single number is a field of one character."""
    out = []
    for row in rows:
        name = normalize_name(row["field_name"], lower=True)
        if not _keep(name):
            continue
        first, _, last = row["position"].strip().partition("-")
        start, end = int(first), int(last or first)
        out.append(
            FieldSpec(
                name, start, end - start + 1, _scale(row.get("scale")),
                record=row.get("record_name", "").strip().upper(),
                condition=row.get("conditional_changes", "").strip().upper(),
            )
        )
    return check_layout(out)


def layout_from_segments(rows: Iterable[Mapping[str, str]]) -> list[FieldSpec]:
    """Rows with ``position_start`` / ``position_end`` per record number and segment."""
    out = []
    for row in rows:
        name = normalize_name(row["field_name"], lower=True)
        if not _keep(name):
            continue
        start, end = int(row["position_start"]), int(row["position_end"])
        out.append(
            FieldSpec(
                name, start, end - start + 1, _scale(row.get("scale")),
                record=row.get("record_number", "").strip().upper(),
                segment=row.get("record_segment", "").strip().upper(),
                condition=row.get("conditional_changes", "").strip().upper(),
            )
        )
    return check_layout(out)


def layout_from_pictures(rows: Iterable[Mapping[str, str]]) -> list[FieldSpec]:
    """Rows with a COBOL picture; decimals come from the part after its V."""
    out = []
    for row in rows:
        name = normalize_name(row["business_name"], lower=True)
        if not _keep(name):
            continue
        start, end = int(row["source_field_start_pos"]), int(row["source_field_end_pos"])
        decimals = picture_decimals(row.get("source_field_pic", ""))
        out.append(
            FieldSpec(
                name, start, end - start + 1, decimals or None,
                record=row.get("record_number", "").strip().upper(),
                overlap=row.get("overlap", "").strip().upper(),
            )
        )
    return check_layout(out)


def check_layout(fields: Sequence[FieldSpec]) -> list[FieldSpec]:
    """Refuse empty ranges and names that repeat within a record, segment and condition."""
    seen = set()
    for f in fields:
        if f.start < 1 or f.length < 1:
            raise ValueError(f"bad position of field {f.name}: {f.start}-{f.end}")
        place = (f.record, f.segment, f.condition, f.name)
        if place in seen:
            raise ValueError(f"field {f.name} repeats in record {f.record!r} segment {f.segment!r}")
        seen.add(place)
    return list(fields)


def field_column(f: FieldSpec, value: Column | None = None) -> Column:
    """Cut, trim, collapse blanks, place the decimal point."""
    raw = F.substring(F.col("value") if value is None else value, f.start, f.length)
    return implied_decimal(collapse_blanks(raw), f.scale)


def parse_fixed_width(
    lines: DataFrame, layout: Sequence[FieldSpec], record: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One column per field of the record type, all in a single projection."""
    fields = [f for f in layout if record is None or f.record == record]
    return lines.select(*keep, *[field_column(f).alias(f.name) for f in fields])


def parse_conditional(
    lines: DataFrame,
    layout: Sequence[FieldSpec],
    switch: str,
    variants: Mapping[str, Sequence[str]],
    keep: Sequence[str] = (),
    otherwise: str = "",
) -> DataFrame:
    """Fields whose place depends on another field's value.

    ``variants`` names the conditions and the switch values that select them; ``otherwise`` is the
    condition of all other rows. A field without a condition holds for every row, a field with one is
    null in rows of the other conditions. Conditions are compared exactly, in one pass over the lines.
    """
    cut = field_column(next(f for f in layout if f.name == switch and not f.condition))
    known = [v for values in variants.values() for v in values]
    rules = {name.upper(): cut.isin(*values) for name, values in variants.items()}
    rules[otherwise.upper()] = rules.get(otherwise.upper(), ~cut.isin(*known))
    names = list(dict.fromkeys(f.name for f in layout))
    columns = []
    for name in names:
        options = [f for f in layout if f.name == name]
        plain = [f for f in options if not f.condition]
        column = field_column(plain[0]) if plain else F.lit(None).cast("string")
        for f in options:
            if f.condition:
                column = F.when(rules[f.condition], field_column(f)).otherwise(column)
        columns.append(column.alias(name))
    return lines.select(*keep, *columns)


def data_lines(
    lines: DataFrame, position: int, code: str, header: str | None = None, trailer: str | None = None
) -> DataFrame:
    """Lines whose type code stands at ``position``, less header and trailer lines by their prefix."""
    out = lines.where(F.substring("value", position, len(code)) == code)
    for prefix in (header, trailer):
        if prefix:
            out = out.where(~F.col("value").startswith(prefix))
    return out


def attach_header(data: DataFrame, headers: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """File-level columns, cut from each file's header line, on every data row of the file.

    The headers, a row per file, are written at once: Spark sees their size and does not shuffle the data to them.
    """
    return data.join(written(headers.select("file_path", *columns), "headers"), "file_path", "left")
