"""Records made of several lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.sources.fixed_width import field_column
from feedloom.types import FieldSpec

# Prefixes of the name slots in a line, and the type letters that overlapping fields go by.
NAME_SLOTS = ["x1", "x2", "x3"]
BUSINESS, PERSON = "B", "P"
MAX_LINES = 100_000

# Hashes gathered at a time in the lower levels of the hash tree.
FAN_OUT = 4096
_ENTITY = ["file_path", "entity_no"]


def entity_hash(lines: DataFrame, suffix: Column | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """A content id per entity: SHA-256 over its line hashes in order, as a tree of three levels.

    Each line is hashed where it was read. Every ``fan_out`` line hashes in a row are joined and hashed, then every
    ``fan_out`` of those, then the rest, for entities of any length alike; so no task gathers more than that many
    hashes at once in the lower levels. ``suffix`` (a date, for feeds of one line per record) is added to every line.
    """
    text = F.concat(F.col("value"), suffix) if suffix is not None else F.col("value")

    def gather(rows: DataFrame, group: list) -> DataFrame:
        hashes = F.transform(F.sort_array(F.collect_list(F.struct("at", "h"))), lambda x: x["h"])
        return rows.groupBy(*group).agg(F.sum("n").alias("n"), F.sha2(F.array_join(hashes, ""), 256).alias("h"))

    block = F.floor(F.col("at") / fan_out).alias("at")
    at = (F.col("line_no") - F.col("entity_start")).alias("at")
    out = lines.select(*_ENTITY, at, F.lit(1).alias("n"), F.sha2(text, 256).alias("h"))
    for group in ([*_ENTITY, block], [*_ENTITY, block], _ENTITY):
        out = gather(out, group)
    return out.select(*_ENTITY, F.col("n").alias("line_count"), F.col("h").alias("entity_id"))


def with_entity_hash(lines: DataFrame, suffix: Column | None = None) -> DataFrame:
    return lines.join(entity_hash(lines, suffix).select(*_ENTITY, "entity_id"), _ENTITY)


def merge_segments(
    lines: DataFrame, layout: Sequence[FieldSpec], segment: Column, keep: Sequence[str] = _ENTITY, fan_out: int = FAN_OUT
) -> DataFrame:
    """All segment lines of an entity as one flat row.

    Fields are cut where a line was read. Their texts are joined within blocks of ``fan_out`` line numbers and then
    over the blocks, so a task never gathers the lines of a long entity, only one row per block.

    Every segment has its own layout. A name that occurs more than once, in several segments or because a segment
    repeats, is its texts one after the other in line order; a name that no line has is null. Lines of segments
    without a layout are left to :func:`segment_rejects`.
    """
    by_name: dict[str, list[FieldSpec]] = {}
    for f in layout:
        by_name.setdefault(f.name, []).append(f)
    of = F.col("__segment")

    def cut(fields: list[FieldSpec]) -> Column:
        out = F.lit(None).cast("string")
        for f in fields:
            out = F.when(of == f.segment, F.coalesce(field_column(f), F.lit(""))).otherwise(out)
        return out

    def fold(rows: DataFrame, group: list) -> DataFrame:
        rows = rows.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("at", *by_name))).alias("__lines"))
        found = {name: F.array_compact(F.col(f"__lines.{name}")) for name in by_name}
        joined = [F.when(F.size(texts) > 0, F.array_join(texts, "")).alias(name) for name, texts in found.items()]
        return rows.select(*[c for c in rows.columns if c != "__lines"], *joined)

    known = lines.withColumn("__segment", segment).where(of.isin(sorted({f.segment for f in layout})))
    texts = known.select(*keep, F.col("line_no").alias("at"), *[cut(fields).alias(name) for name, fields in by_name.items()])
    blocks = fold(texts, [*keep, F.floor(F.col("at") / fan_out).alias("at")])
    return fold(blocks, [*keep]).select(*keep, *by_name)


def segment_rejects(lines: DataFrame, layout: Sequence[FieldSpec], segment: Column) -> DataFrame:
    """Lines of a segment that no layout describes, null lines among them."""
    known = segment.isin(sorted({f.segment for f in layout}))
    return lines.where(~F.coalesce(known, F.lit(False)))


def match_root(lines: DataFrame, is_root: Column, key: Sequence[Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, children, rejects): children must share the key of their entity's root.

    Rejects are lines without a root and lines whose key is not the root's.
    """
    keyed = lines.withColumn("__key", F.concat_ws("\x1f", *key))
    roots = keyed.where(is_root)
    heads = roots.select(*_ENTITY, F.col("__key").alias("__root_key"))
    others = keyed.where(~is_root).join(heads, _ENTITY, "left")
    ok = F.coalesce(F.col("__key") == F.col("__root_key"), F.lit(False))
    clean = ("__key", "__root_key")
    return roots.drop(*clean), others.where(ok).drop(*clean), others.where(~ok).drop(*clean)


def name_slots(layout: Sequence[FieldSpec], type_field: str, wanted: Sequence[str]) -> Column:
    """The filled name slots of a line as an array of structs.

    Fields come in copies prefixed x1, x2, x3. A field reserved for businesses or for persons is null
    in a slot of the other kind; a slot with none of the wanted fields filled is left out.
    """
    slots = []
    for prefix in NAME_SLOTS:
        fields = {f.name[len(prefix):]: f for f in layout if f.name.startswith(prefix)}
        if not fields:
            continue
        business = F.upper(field_column(fields[type_field])) == BUSINESS
        cells, filled = [], F.lit(False)
        for name, f in fields.items():
            cell = field_column(f)
            if f.overlap == PERSON:
                cell = F.when(~business, cell)
            elif f.overlap == BUSINESS:
                cell = F.when(business, cell)
            if name in wanted:
                filled = filled | F.coalesce(cell != "", F.lit(False))
            cells.append(cell.alias(name.strip("_")))
        slots.append(F.when(filled, F.struct(*cells)))
    return F.array_compact(F.array(*slots))


def assemble(
    roots: DataFrame,
    children: DataFrame,
    root_fields: Sequence[Column],
    lists: Mapping[str, tuple[Column, Column]],
    singles: Mapping[str, tuple[Column, Column]] | None = None,
    sums: Mapping[str, tuple[Column, Column]] | None = None,
    max_lines: int = MAX_LINES,
) -> DataFrame:
    """One document per entity: root fields, child lists in line order, single children, sums over children.

    Every entry maps a name to (which child lines, what of them). The lists of an entity with more than
    ``max_lines`` lines continue in further rows, told apart by ``part_no``, so no task gathers an
    unbounded list; root fields, singles and sums are whole in every part. A row is an entity and a part.
    """
    part = F.floor((F.col("line_no") - F.col("entity_start")) / max_lines).cast("int")
    gathered = [
        F.transform(F.sort_array(F.collect_list(F.when(rule, F.struct("line_no", item.alias("v"))))), lambda x: x["v"]).alias(name)
        for name, (rule, item) in lists.items()
    ]
    arrays = children.withColumn("part_no", part).groupBy(*_ENTITY, "part_no").agg(*gathered)
    wide = [F.min_by(F.when(rule, item), F.when(rule, F.col("line_no"))).alias(n) for n, (rule, item) in (singles or {}).items()]
    wide += [F.sum(F.when(rule, item)).alias(n) for n, (rule, item) in (sums or {}).items()]
    out = roots.select(*_ENTITY, *root_fields)
    if wide:
        out = out.join(children.groupBy(*_ENTITY).agg(*wide), _ENTITY, "left")
    out = out.join(arrays, _ENTITY, "left").withColumn("part_no", F.coalesce("part_no", F.lit(0)))
    for name in lists:
        out = out.withColumn(name, F.coalesce(name, F.array().cast(arrays.schema[name].dataType)))
    return out.fillna(0, subset=list(sums or {})) if sums else out


def route_by_type(df: DataFrame, kind: Column, tables: Mapping[str, str]) -> dict[str, DataFrame]:
    """Rows to named tables by their type code; codes that are not listed go to ``other``."""
    marked = df.withColumn("__kind", kind)
    out = {name: marked.where(F.col("__kind") == code).drop("__kind") for code, name in tables.items()}
    out["other"] = marked.where(~F.coalesce(F.col("__kind").isin(*tables), F.lit(False))).drop("__kind")
    return out


def write_routed(df: DataFrame, kind: Column, path: str) -> None:
    """The same as one partitioned write: every line is read and written once."""
    df.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(path)
