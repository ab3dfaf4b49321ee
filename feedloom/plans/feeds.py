"""Feed files written from the shared tables, for the queries that read feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedloom.plans.registry import table
from feedloom.session import scratch_path, written, written_once
from feedloom.sources.fixed_width import layout_from_pictures, layout_from_positions, layout_from_segments
from feedloom.sources.sinks import bounded_lines, write_bounded

# One SQL text serves Spark and DuckDB: the lines are the input, what is checked is how they are read back.
def cents(c: str) -> str:
    return f"cast(cast(round({c} * 100) as bigint) as string)"


def day(c: str) -> str:
    return f"replace(cast(cast({c} as date) as string), '-', '')"


ORDER_LINE = (
    "concat('OR', 'A', lpad(cast(o_orderkey as string), 12, '0'), lpad(cast(o_custkey as string), 12, '0'), o_orderstatus, "
    f"lpad({cents('o_totalprice')}, 13, '0'), {day('o_orderdate')}, rpad(o_orderpriority, 15, ' '), '  two  blanks  ')"
)
ITEM_LINE = (
    "concat('OR', 'B', lpad(cast(l_orderkey as string), 12, '0'), lpad(cast(l_linenumber as string), 3, '0'), "
    "lpad(cast(l_partkey as string), 12, '0'), lpad(cast(l_suppkey as string), 12, '0'), "
    f"lpad({cents('l_quantity')}, 7, '0'), lpad({cents('l_extendedprice')}, 13, '0'), lpad({cents('l_discount')}, 5, ' '), "
    f"lpad({cents('l_tax')}, 5, ' '), l_returnflag, l_linestatus, {day('l_shipdate')})"
)

ORDER_LAYOUT = layout_from_positions(
    [
        {"record_name": r, "field_name": n, "position": p, "scale": s}
        for r, n, p, s in [
            ("A", "transaction code", "001-002", ""), ("A", "record indicator", "003", ""), ("A", "order key", "004-015", "0"),
            ("A", "customer", "016-027", "0"), ("A", "status", "028", ""), ("A", "price", "029-041", "2"), ("A", "order date", "042-049", ""),
            ("A", "priority", "050-064", ""), ("A", "note", "065-080", ""), ("A", "filler", "081-090", ""),
            ("B", "order key", "004-015", "0"), ("B", "line number", "016-018", "0"), ("B", "part", "019-030", "0"), ("B", "supplier", "031-042", "0"),
            ("B", "quantity", "043-049", "2"), ("B", "price", "050-062", "2"), ("B", "discount", "063-067", "2"), ("B", "tax", "068-072", "2"),
            ("B", "return flag", "073", ""), ("B", "line status", "074", ""), ("B", "ship date", "075-082", ""),
        ]
    ]
)
HEADER_LAYOUT = layout_from_positions(
    [
        {"record_name": "HEADER", "field_name": n, "position": p}
        for n, p in [("begin tag", "001-018"), ("form name", "019-036"), ("run date", "047-056"), ("refreshed updated", "058-066"), ("chunk", "068-075")]
    ]
)
HEADER_TAG, TRAILER_TAG = "BOF      FEED", "EOF      FEED"
ORDERS_PER_FILE = 4000


def named_files(df: DataFrame, name: str) -> str:
    """CSV files with a header, one per task, each under the same name in a folder of its own; a path that matches all."""
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, "named")
    df.write.option("header", True).csv(folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, part in enumerate(fs.globStatus(hadoop(f"{folder}/part-*"))):
        fs.mkdirs(hadoop(f"{folder}/{i}"))
        fs.rename(part.getPath(), hadoop(f"{folder}/{i}/{name}"))
    return f"{folder}/*/{name}"


def text_dir(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.text(path)
    return path


def ordered_text(df: DataFrame, line: Column, order: list[str], label: str, split: str, having: Column | None = None) -> str:
    """Lines in order, cut into files by ranges of the first order column; those that meet a condition, which may look
    over all rows of a value of that column."""
    path = scratch_path(df.sparkSession, label)
    ordered = df.repartitionByRange(split).sortWithinPartitions(*order)
    if having is not None:
        ordered = ordered.withColumn("__having", having).where("__having")
    ordered.select(line.alias("value")).write.text(path)
    return path


def item_lines(spark: SparkSession, sf: str) -> str:
    """One line per line item, written once per session."""
    lines = table(spark, sf, "lineitem").select(F.expr(ITEM_LINE).alias("value"))
    return written_once(spark, ("item lines", sf), lambda: text_dir(lines, "items"))


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Record A per order, a record B per line item: (order_key, value); an order's lines sort by their text."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), F.expr(ORDER_LINE).alias("value"))
    known = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    l = table(spark, sf, "lineitem").join(known, "l_orderkey", "left_semi")
    return o.unionByName(l.select(F.col("l_orderkey").alias("order_key"), F.expr(ITEM_LINE).alias("value")))


def order_and_item_rows(spark: SparkSession, sf: str, order_value: Column, item_value: Column) -> DataFrame:
    """Orders and all line items that have a key: (order_key, is_order, value).

    Items without an order are told by a window over the key where the rows have met for another reason: a join before
    that would shuffle all items a second time as soon as the orders are too many to be broadcast.
    """
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), F.lit(True).alias("is_order"), order_value.alias("value"))
    l = table(spark, sf, "lineitem").where("l_orderkey IS NOT NULL")
    return o.unionByName(l.select(F.col("l_orderkey").alias("order_key"), F.lit(False).alias("is_order"), item_value.alias("value")))


def order_feed(spark: SparkSession, sf: str) -> str:
    """The order feed, written once per session."""
    return written_once(spark, ("order feed", sf), lambda: write_order_feed(spark, sf))


def write_order_feed(spark: SparkSession, sf: str) -> str:
    """Fixed-width files of so many orders each, with header, records A and B, and a trailer count."""
    rows = order_and_item_rows(spark, sf, F.expr(ORDER_LINE), F.expr(ITEM_LINE))
    in_chunk = {"chunk": F.floor(F.col("order_key") / ORDERS_PER_FILE), "record_in_chunk": F.lit(1)}
    lines = rows.withColumns(in_chunk)
    # Lines are counted once, by their keys alone; headers and trailers come from these counts.
    per_order = rows.groupBy("order_key").agg(F.count(F.lit(1)).alias("n"), F.max("is_order").alias("known")).where("known")
    counts = written(per_order.withColumns(in_chunk).groupBy("chunk", "record_in_chunk").agg(F.sum("n").alias("n")), "chunks")
    chunk = F.lpad(F.col("chunk").cast("string"), 8, "0")
    header = F.concat(F.rpad(F.lit(HEADER_TAG), 18, " "), F.rpad(F.lit("ORDERS ITEMS"), 18, " "), F.rpad(F.lit("DATA OF"), 10, " "), F.lit("01/31/2024"), F.lit(" "), F.lit("REFRESHED"), F.lit(" "), chunk)
    body = bounded_lines(lines, F.col("value"), ["order_key"], header, None, counted=counts, keep=["is_order"])
    trailer = counts.select(
        "chunk", F.lit(2).alias("place"), F.lit(None).cast(body.schema["at"].dataType).alias("at"),
        F.concat(F.rpad(F.lit(TRAILER_TAG), 18, " "), F.lpad(F.col("n").cast("string"), 10, "0")).alias("value"),
        F.lit(None).cast("boolean").alias("is_order"),
    )
    path = scratch_path(spark, "order-feed")
    known = F.max("is_order").over(Window.partitionBy("chunk", "place", "at"))
    write_bounded(body.unionByName(trailer), path, having=(F.col("place") != 1) | known)
    return path


# Segments: segment 1 is the order, segments 2 to 4 are its lines by number; "remark" occurs in each.
SEGMENT_LAYOUT = layout_from_segments(
    [
        {"record_number": "1", "record_segment": s, "field_name": n, "position_start": a, "position_end": b, "scale": c}
        for s, n, a, b, c in [
            ("1", "order key", "002", "013", "0"), ("1", "price", "014", "026", "2"), ("1", "remark", "027", "028", ""),
            ("2", "part 2", "014", "025", "0"), ("2", "remark", "027", "028", ""),
            ("3", "part 3", "014", "025", "0"), ("3", "remark", "027", "028", ""),
            ("4", "part 4", "014", "025", "0"), ("4", "remark", "027", "028", ""),
        ]
    ]
)

# Hierarchical records: 101 is the root, 102 carries three name slots, 104 a single child, 2x0 an address list.
def picture_rows(record: str, fields: list[tuple]) -> list[dict]:
    return [
        {"record_number": record, "business_name": n, "source_field_start_pos": a, "source_field_end_pos": b, "source_field_pic": p, "overlap": o}
        for n, a, b, p, o in fields
    ]


COMMON = [("record type", 1, 1, "X", ""), ("record number", 2, 4, "9(3)", ""), ("firm", 5, 8, "X(4)", ""), ("branch", 9, 11, "X(3)", ""), ("account number", 12, 17, "X(6)", "")]
SLOT = [("ffr name type", 1, "X"), ("ffr primary acct name", 12, "X(12)"), ("ffr ssn number", 9, "X(9)")]


def slot_fields() -> list[tuple]:
    out, at = [], 20
    for prefix in ("x1", "x2", "x3"):
        for name, width, pic in SLOT:
            overlap = "P" if name == "ffr ssn number" else ""
            out.append((f"{prefix} {name}", at, at + width - 1, pic, overlap))
            at += width
    return out


RECORD_LAYOUT = {
    "101": layout_from_pictures(picture_rows("101", [*COMMON, ("balance", 18, 28, "9(9)V99", ""), ("segment", 29, 40, "X(12)", "")])),
    "102": layout_from_pictures(picture_rows("102", [("ffr name count", 18, 19, "9(2)", ""), *slot_fields()])),
    "104": layout_from_pictures(picture_rows("104", [("nation", 18, 22, "X(5)", "")])),
    "2X0": layout_from_pictures(picture_rows("2X0", [("order key", 18, 29, "9(12)", ""), ("price", 30, 42, "9(11)V99", "")])),
}
