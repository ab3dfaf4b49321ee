"""Line scans with exact line numbers, without sorting a file in one task."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedloom.functions.text import cleanse_record
from feedloom.session import require_pinned_splits, written

#: Lines of a quoted record; what is opened and not closed within so many is a stray quote.
LONGEST = 100_000
_BLOCK = ["file_path", "block_start", "block_length"]


def read_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", record_sep: str | None = None
) -> DataFrame:
    """One ``value`` per line, with the file and the file block it was read from."""
    reader = spark.read
    if record_sep:
        reader = reader.option("lineSep", record_sep)
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        value = F.decode(value.cast("binary"), encoding)
    return reader.text(path if isinstance(path, str) else list(path)).select(
        value.alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_length"),
    )


def _cut_differently() -> Column:
    text = "files were cut differently between two scans; set spark.sql.files.minPartitionNum"
    return F.raise_error(F.lit(text)).cast("bigint")


def with_line_order(lines: DataFrame, is_start: Column | None = None) -> DataFrame:
    """Add ``line_no`` (1-based, per file) and, given a start marker, ``entity_no`` and ``entity_start``.

    ``lines`` comes from :func:`read_lines`; later filters belong after this call. Lines of a file block
    sit together in their scan task, so the position within the block is the distance to the block's
    first row id. What comes before the block is one small row per block, found in a first scan and written
    at once, so that Spark sees its size and sends it to the lines instead of shuffling them to it. The
    row id range is checked: should the two scans ever cut the files differently, the job stops.

    ``entity_no`` counts the start lines up to and including this one, ``entity_start`` is the number of
    the last of them; lines before the first start of a file have entity 0, which starts at line 1. Both
    run within a block and continue from what the earlier blocks left.
    """
    require_pinned_splits(lines.sparkSession)
    starts = F.coalesce(is_start, F.lit(False)) if is_start is not None else F.lit(False)
    marked = lines.withColumns({"__id": F.monotonically_increasing_id(), "__start": starts})
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = marked.groupBy(*_BLOCK).agg(
        F.min("__id").alias("__first"),
        F.count(F.lit(1)).alias("__lines"),
        F.count(F.when(F.col("__start"), 1)).alias("__starts"),
        F.max(F.when(F.col("__start"), F.col("__id"))).alias("__last"),
    )
    blocks = blocks.withColumn("__lines_before", F.coalesce(F.sum("__lines").over(earlier), F.lit(0)))
    last_line = F.col("__lines_before") + F.col("__last") - F.col("__first") + 1
    blocks = blocks.select(
        *_BLOCK, "__first", "__lines", "__lines_before",
        F.coalesce(F.sum("__starts").over(earlier), F.lit(0)).alias("__starts_before"),
        F.coalesce(F.max(last_line).over(earlier), F.lit(1)).alias("__last_before"),
    )
    blocks = written(blocks, "blocks")
    place = F.col("__id") - F.col("__first")
    number = F.when(place.between(0, F.col("__lines") - 1), F.col("__lines_before") + place + 1)
    numbered = marked.join(blocks, _BLOCK, "left").withColumn("line_no", F.coalesce(number, _cut_differently()))
    columns = [*lines.columns, "line_no"]
    if is_start is None:
        return numbered.select(*columns)
    within = Window.partitionBy("__first").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        *columns,
        (F.col("__starts_before") + F.count(F.when(F.col("__start"), 1)).over(within)).alias("entity_no"),
        F.coalesce(F.max(F.when(F.col("__start"), F.col("line_no"))).over(within), F.col("__last_before")).alias("entity_start"),
    )


def _quote_events(value: Column, sep: str, quote: str) -> Column:
    """What a line with an odd number of quotes may do: ``I`` open a record, ``O`` close one, ``F`` either, null neither.

    Doubled quotes are text wherever they stand. Of the others the last one opens a field if it begins one, and the
    first one closes a field if it ends one; quotes elsewhere, as in ``5" pipe``, are text.
    """
    q, s = re.escape(quote), re.escape(sep)
    single = F.replace(value, F.lit(quote * 2), F.lit(""))
    odd = (F.length(single) - F.length(F.replace(single, F.lit(quote), F.lit("")))) % 2 == 1
    opens, closes = single.rlike(rf"(?s)(?:^|{s}){q}[^{q}]*\z"), single.rlike(rf"(?s)^[^{q}]*{q}[ \t\r]*(?:{s}|\z)")
    return F.when(odd & opens & closes, "F").when(odd & opens, "I").when(odd & closes, "O")


def _is_row(value: Column, sep: str, quote: str, width: int) -> Column:
    """Whether a line is a row of ``width`` fields by itself."""
    bare = F.when(F.contains(value, F.lit(quote)), F.regexp_replace(value, f"{re.escape(quote)}[^{re.escape(quote)}]*{re.escape(quote)}", "")).otherwise(value)
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))
    return F.coalesce((separators == (width - 1) * len(sep)) & ~F.contains(bare, F.lit(quote)), F.lit(False))


def with_quoted_records(lines: DataFrame, width: int, sep: str = ",", quote: str = '"', longest: int = LONGEST) -> DataFrame:
    """Add ``line_no``, ``record_start`` (the number of its record's first line), ``is_whole`` and ``is_broken``.

    A record of several lines runs from a line that opens a quoted field to the next one that closes one. An opening
    without such an end (another one opens first, the file ends, or it lies more than ``longest`` lines on) is a stray
    quote: the lines before the next whole row of ``width`` fields are broken, from there on lines count again.
    ``is_whole`` marks lines that are a record of their own.

    Each line is a function from the state before it, in or out of quotes, to the state behind it: it sets, flips or
    keeps the state. Functions are composed within a block and carried over the blocks, a row each, so a file of any
    size is read in splits. The lines are staged once.
    """
    require_pinned_splits(lines.sparkSession)
    marked = lines.withColumns({"__id": F.monotonically_increasing_id(), "__event": _quote_events(F.col("value"), sep, quote)})
    # What follows is what comes before in falling order: frames that end at the last row are summed anew for each row.
    earlier, later = (Window.partitionBy("file_path").orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("block_start", F.desc("block_start")))
    blocks = marked.groupBy(*_BLOCK).agg(
        F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__lines"), F.max(F.when(F.col("__event").isNotNull(), F.col("__id"))).alias("__last")
    )
    blocks = blocks.withColumn("__lines_before", F.coalesce(F.sum("__lines").over(earlier), F.lit(0)))
    last_event = F.col("__lines_before") + F.col("__last") - F.col("__first") + 1
    blocks = blocks.select(*_BLOCK, "__first", "__lines", "__lines_before", F.max(last_event).over(earlier).alias("__event_before"))
    place = F.col("__id") - F.col("__first")
    number = F.when(place.between(0, F.col("__lines") - 1), F.col("__lines_before") + place + 1)
    before, after = (Window.partitionBy(*_BLOCK).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("__id", F.desc("__id")))
    upto = before.rowsBetween(Window.unboundedPreceding, 0)

    at_event = F.when(F.col("__event").isNotNull(), F.col("line_no"))
    numbered = marked.join(blocks, _BLOCK, "left").withColumn("line_no", F.coalesce(number, _cut_differently()))
    numbered = numbered.withColumn("__previous", F.coalesce(F.max(at_event).over(before), "__event_before"))
    # What was opened longer ago is broken, so a quote that may do either opens.
    far = F.col("line_no") - F.col("__previous") > longest
    numbered = numbered.withColumn("__event", F.when((F.col("__event") == "F") & far, "I").otherwise(F.col("__event")))
    sets = F.when(F.col("__event").isin("I", "O"), F.struct("line_no", (F.col("__event") == "I").alias("inside")))
    flips = F.coalesce((F.col("__event") == "F").cast("long"), F.lit(0))
    numbered = numbered.withColumns({"__set": F.max(sets).over(upto), "__set_before": F.max(sets).over(before), "__flips": F.sum(flips).over(upto), "__flip": flips})
    numbered = numbered.withColumn("__flips_at_set", F.coalesce(F.max(F.when(sets.isNotNull(), F.col("__flips"))).over(before), F.lit(0)))
    staged = written(
        numbered.select(
            *lines.columns, "line_no", "__event", "__previous", "__set", "__set_before", "__flip", "__flips", "__flips_at_set",
            F.min(F.when(F.col("__event").isNotNull(), F.struct("line_no", "__event"))).over(after).alias("__next"),
            F.max(F.when(_is_row(F.col("value"), sep, quote, width), F.col("line_no"))).over(upto).alias("__row"),
            F.max(at_event).over(upto).alias("__at"),
        ),
        "quoted-lines",
    )
    # The state at a block's end: what its last setting line says, turned by the flips since, or by all flips without one.
    ends = staged.groupBy(*_BLOCK).agg(
        F.max("__set").alias("__end_set"), F.sum("__flip").alias("__all_flips"),
        F.max(F.when(F.col("__event").isin("I", "O"), F.col("__flips"))).alias("__set_flips"),
        F.min(F.when(F.col("__event").isNotNull(), F.struct("line_no", "__event"))).alias("__first_event"),
        F.max("__row").alias("__last_row"), F.max("__at").alias("__last_event"),
    )
    ends = ends.withColumn("__flips_until", F.coalesce(F.sum("__all_flips").over(earlier), F.lit(0)))
    settled = F.when(F.col("__end_set").isNotNull(), F.struct(F.col("__end_set.line_no").alias("at"), F.col("__end_set.inside").alias("inside"), (F.col("__flips_until") + F.col("__set_flips")).alias("flips")))
    ends = ends.withColumn("__settled", F.max(settled).over(earlier))
    turned = (F.col("__flips_until") - F.coalesce(F.col("__settled.flips"), F.lit(0))) % 2 == 1
    ends = ends.select(
        *_BLOCK, (F.coalesce(F.col("__settled.inside"), F.lit(False)) != turned).alias("__inside_at_start"),
        F.min("__first_event").over(later).alias("__event_after"), F.max("__last_row").over(earlier).alias("__row_before"), F.max("__last_event").over(earlier).alias("__at_before"),
    )
    joined = staged.join(ends, _BLOCK, "left")
    odd = lambda n: n % 2 == 1
    is_set = F.col("__event").isin("I", "O")
    was_inside = F.coalesce(F.col("__set_before.inside"), F.col("__inside_at_start")) != odd(F.col("__flips") - F.col("__flip") - F.col("__flips_at_set"))
    inside = F.when(is_set, F.col("__event") == "I").otherwise(was_inside != odd(F.col("__flip")))
    opened, following = F.coalesce("__at", "__at_before"), F.coalesce("__next", "__event_after")
    ended = F.coalesce((following["__event"] != "I") & (following["line_no"] - opened <= longest), F.lit(False))
    lost = inside & ~ended & (F.coalesce("__row", "__row_before", F.lit(0)) <= opened)
    closing = F.col("__event").isNotNull() & ~inside & was_inside & (F.col("line_no") - F.col("__previous") <= longest)
    start = F.when(inside & (ended | lost), opened).when(closing, F.col("__previous")).otherwise(F.col("line_no"))
    alone = ~F.coalesce((inside & ended) | closing, F.lit(False)) & ~F.coalesce(lost, F.lit(False))
    return joined.select(*lines.columns, "line_no", start.alias("record_start"), alone.alias("is_whole"), F.coalesce(lost, F.lit(False)).alias("is_broken"))


def join_records(numbered: DataFrame) -> DataFrame:
    """One row per unbroken record of :func:`with_quoted_records`; only lines of longer records are grouped."""
    parts = F.sort_array(F.collect_list(F.struct("line_no", "value")))
    longer = (
        numbered.where(~F.col("is_whole") & ~F.col("is_broken"))
        .groupBy("file_path", "record_start")
        .agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value"))
    )
    whole = numbered.where(F.col("is_whole")).select("file_path", "record_start", "value")
    return whole.unionByName(longer)


def head_lines(numbered: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of every file."""
    return numbered.where(F.col("line_no") <= n)


def first_lines(lines: DataFrame) -> DataFrame:
    """The first line of every file: the lowest row of its block 0, without numbering the rest."""
    first = lines.where(F.col("block_start") == 0).withColumn("__id", F.monotonically_increasing_id())
    return first.groupBy("file_path").agg(F.min_by("value", "__id").alias("value"))


def read_records(spark: SparkSession, path: str, record_sep: str = "$#$#", encoding: str = "windows-1252") -> DataFrame:
    """Records that end with a separator of their own, cleansed to one pipe-delimited line each."""
    records = read_lines(spark, path, encoding, record_sep)
    return records.withColumn("value", cleanse_record(F.col("value")))


def split_by_delimiter_count(lines: DataFrame, sep: str, count: int) -> tuple[DataFrame, DataFrame]:
    """(good, bad) lines: those with exactly ``count`` separators, and the rest, a null line among them."""
    found = F.length("value") - F.length(F.replace(F.col("value"), F.lit(sep), F.lit("")))
    good = F.coalesce(found == count * len(sep), F.lit(False))
    return lines.where(good), lines.where(~good)
