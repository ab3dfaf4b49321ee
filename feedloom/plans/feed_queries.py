"""Feeds written from the shared tables and read back: scans, sinks, multi-line records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from feedloom.operators import quality, ranking, records
from feedloom.operators.relational import collect_records
from feedloom.plans import feeds
from feedloom.plans.registry import query, table
from feedloom.session import scratch_path, written, written_once
from feedloom.sources import delimited, documents, fixed_width as fw, lake, sinks
from feedloom.sources.file_meta import DIALECTS, file_name_meta, with_file_meta
from feedloom.sources.lines import first_lines, head_lines, read_lines, read_records, split_by_delimiter_count, with_line_order
from feedloom.types import ColumnSpec

# Delimited and line scans --------------------------------------------------------------------------

@query("read_delimited", """
SELECT cast(c_custkey AS varchar) AS "Cust_Key", c_name || ', "' || c_mktsegment || '"' || chr(10) || 'x' AS "Full_Name", cast(c_nationkey AS varchar) AS "order1" FROM customer
""")
def read_delimited(spark, sf):
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nx'))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("Cust Key"), F.concat(F.lit(" "), name).alias("Full-Name"), F.col("c_nationkey").alias("order"))
    path = scratch_path(spark, "csv")
    c.write.option("header", True).option("sep", "|").option("escape", '"').csv(path)
    return delimited.read_delimited(spark, path)


@query("read_quoted_records", """
SELECT cast(doc_id AS varchar) AS doc_id, md5(trim(text)) AS digest, lang FROM documents
""")
def read_quoted_records(spark, sf):
    """Documents with their line breaks and quotes as a CSV, read in splits."""
    path = scratch_path(spark, "csv")
    table(spark, sf, "documents").select("doc_id", "text", "lang").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    rows = delimited.read_quoted_records(spark, path)
    return rows.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("quoted_rejects", """
SELECT 'row' AS kind, cast(c_custkey AS varchar) AS id, c_name || chr(10) || '5" ' || c_mktsegment AS text FROM customer
UNION ALL SELECT 'reject', cast(c_nationkey AS varchar), 'S' || c_custkey || ',"never closed' FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'row', 'T' || c_custkey, '6" ' || c_name FROM customer WHERE c_acctbal > 9000
""")
def quoted_rejects(spark, sf):
    """Records of two lines, some behind a quote that opens a field and is never closed, some before one within a field."""
    key = F.col("c_custkey").cast("string")
    value = F.concat(
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("S"), key, F.lit(',"never closed\n'))).otherwise(""),
        key, F.lit(',"'), "c_name", F.lit('\n5"" '), "c_mktsegment", F.lit('"'),
        F.when(F.col("c_acctbal") > 9000, F.concat(F.lit("\nT"), key, F.lit(',6" '), "c_name")).otherwise(""),
    )
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("chunk"), F.lit(1).alias("record_in_chunk"), "c_custkey", value.alias("value"))
    path = scratch_path(spark, "csv")
    sinks.write_bounded(sinks.bounded_lines(rows, F.col("value"), ["c_custkey"], F.lit("id,text"), None), path)
    read, rejects = delimited.read_quoted(spark, path, ",")
    lost = rejects.select(F.lit("reject").alias("kind"), F.regexp_extract("file_path", "chunk=([0-9]+)", 1).alias("id"), F.col("value").alias("text"))
    return read.select(F.lit("row").alias("kind"), "id", "text").unionByName(lost)


@query("read_delimited_multichar", "SELECT cast(s_suppkey AS varchar) AS s_suppkey, s_name, cast(s_nationkey AS varchar) AS s_nationkey FROM supplier")
def read_delimited_multichar(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "supplier").drop("s_acctbal").write.option("header", True).option("sep", "#!#!").csv(path)
    return delimited.read_delimited(spark, path, multi_line=False)


@query("read_lines", f"SELECT {feeds.ITEM_LINE} AS value FROM lineitem")
def read_lines_query(spark, sf):
    return read_lines(spark, feeds.item_lines(spark, sf)).select("value")


@query("read_lines_latin1", """
SELECT c_custkey, md5('Ä' || c_name || 'é') AS digest FROM customer
""")
def read_lines_latin1(spark, sf):
    path = scratch_path(spark, "latin1")
    c = table(spark, sf, "customer").select(F.concat_ws("|", F.col("c_custkey").cast("string"), F.concat(F.lit("Ä"), "c_name", F.lit("é"))).alias("value"))
    c.write.option("encoding", "ISO-8859-1").csv(path, quote="")
    lines = read_lines(spark, path, "ISO-8859-1")
    parts = F.split("value", r"\|")
    return lines.select(F.get(parts, 0).cast("bigint").alias("c_custkey"), F.md5(F.get(parts, 1)).alias("digest"))


@query("record_separator_scan", """
SELECT cast(doc_id AS varchar) || '|' || replace(replace(replace(replace(source || ':' || text, chr(10), ' '), '"', ''''), '|', ':'), '~:~', '|') AS value FROM documents
""")
def record_separator_scan(spark, sf):
    record = F.concat(F.col("doc_id").cast("string"), F.lit("~|~"), "source", F.lit("|"), "text", F.lit("\0"))
    path = scratch_path(spark, "records")
    table(spark, sf, "documents").select(record.alias("value")).write.option("lineSep", "$#$#").text(path)
    return read_records(spark, path, encoding="UTF-8").select("value")


@query("delimiter_count_split", """
SELECT doc_id, CASE WHEN length(text) - length(replace(text, ',', '')) = 3 THEN 'good' ELSE 'bad' END AS outcome FROM documents
""")
def delimiter_count_split(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.col("text").alias("value"))
    good, bad = split_by_delimiter_count(lines, ",", 3)
    return good.withColumn("outcome", F.lit("good")).unionByName(bad.withColumn("outcome", F.lit("bad"))).select("doc_id", "outcome")


@query("ordinal_parse", """
SELECT cast(o_orderkey AS varchar) AS order_key, o_orderstatus AS status, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, 'daily' AS run FROM orders
""")
def ordinal_parse(spark, sf):
    full = F.concat_ws("|", F.lit("D"), F.col("o_orderkey").cast("string"), F.lit("x"), "o_orderstatus", "o_orderpriority")
    ragged = F.concat_ws("|", F.lit("D"), F.col("o_orderkey").cast("string"), F.lit("x"), "o_orderstatus")
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "P", ragged).otherwise(full).alias("value"))
    edges = table(spark, sf, "region").select(F.concat(F.lit("H|"), "r_name").alias("value"))
    path = feeds.text_dir(o.unionByName(edges), "ordinal")
    columns = [ColumnSpec("Order Key", True), ColumnSpec("UNUSED"), ColumnSpec("Status"), ColumnSpec("Priority")]
    return delimited.parse_ordinal(read_lines(spark, path), columns, "|", "D|").withColumn("run", F.lit("daily"))


@query("ordinal_parse_wide_separator", "SELECT p_name AS name, p_type AS kind, cast(p_size AS varchar) AS size FROM part")
def ordinal_parse_wide(spark, sf):
    p = table(spark, sf, "part").select(F.concat_ws("#!#!", "p_name", "p_type", F.col("p_size").cast("string")).alias("value"))
    return delimited.parse_ordinal(read_lines(spark, feeds.text_dir(p, "wide")), [ColumnSpec("name"), ColumnSpec("kind"), ColumnSpec("size")], "#!#!")


@query("quoted_csv_parse", """
SELECT cast(c_custkey AS varchar) AS cust_key, c_name || ', ' || c_mktsegment AS label, '' AS empty, cast(c_nationkey AS varchar) AS nation FROM customer
""")
def quoted_csv_parse(spark, sf):
    line = F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('", "'), "c_name", F.lit(", "), "c_mktsegment", F.lit('",,skip,'), F.col("c_nationkey").cast("string"))
    marks = table(spark, sf, "region").select(F.concat(F.when(F.col("r_regionkey") < 3, '"*BOF*",').otherwise('"*EOF*",'), "r_name").alias("value"))
    path = feeds.text_dir(table(spark, sf, "customer").select(line.alias("value")).unionByName(marks), "quoted")
    columns = [ColumnSpec("Cust Key"), ColumnSpec("Label"), ColumnSpec("Empty"), ColumnSpec("unused"), ColumnSpec("Nation")]
    return delimited.parse_quoted(read_lines(spark, path), columns)


@query("quoted_csv_lines", """
WITH n AS (SELECT row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS place, * FROM customer)
SELECT cast(c_custkey AS varchar) AS cust_key, c_name || ', ' || c_mktsegment AS label, cast(c_nationkey AS varchar) AS nation, place + 1 AS line_no, 'nation-' || c_nationkey AS file FROM n
""")
def quoted_csv_lines(spark, sf):
    """Quoted lines with their line number and file: a file per nation, with a line before and behind the data."""
    c = table(spark, sf, "customer")
    line = F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('","'), "c_name", F.lit(", "), "c_mktsegment", F.lit('",'), F.col("c_nationkey").cast("string"))
    marks = c.select("c_nationkey").distinct().select("c_nationkey", F.explode(F.map_from_arrays(F.array(F.lit(-1), F.lit(2**62)), F.array(F.lit('"*BOF*"'), F.lit('"*EOF*"')))).alias("c_custkey", "value"))
    data = c.select("c_nationkey", F.col("c_custkey").cast("long").alias("c_custkey"), line.alias("value")).unionByName(marks.select("c_nationkey", F.col("c_custkey").cast("long").alias("c_custkey"), "value"))
    path = scratch_path(spark, "quoted-lines")
    data.withColumn("nation", F.col("c_nationkey")).repartition("nation").sortWithinPartitions("nation", "c_custkey").select("nation", "value").write.partitionBy("nation").text(path)
    columns = [ColumnSpec("Cust Key"), ColumnSpec("Label"), ColumnSpec("Nation")]
    rows = delimited.parse_quoted(with_line_order(read_lines(spark, path)), columns, keep=["line_no", "file_path"])
    file = F.concat(F.lit("nation-"), F.regexp_extract("file_path", "/nation=([^/]*)/", 1))
    return rows.select("cust_key", "label", "nation", "line_no", file.alias("file"))


@query("subtable_split", """
SELECT r_name AS source, 'customer' AS kind, count(*) AS n, cast(sum(c_custkey) AS bigint) AS keys FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey GROUP BY 1
UNION ALL SELECT r_name, 'supplier', count(*), cast(sum(s_suppkey) AS bigint) FROM supplier, nation, region WHERE s_nationkey = n_nationkey AND n_regionkey = r_regionkey GROUP BY 1
""")
def subtable_split(spark, sf):
    """One pipe file per region: a header with the region, rows whose first field names the sub-table."""
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_regionkey", "r_name")
    rows = (
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.lit("CU").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
        .unionByName(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.lit("SU").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))
        .join(places, "n_nationkey")
        .select(F.col("r_regionkey").cast("bigint").alias("chunk"), F.lit(1).alias("record_in_chunk"), "r_name", F.concat_ws("|", "kind", F.col("key").cast("string"), "name").alias("value"))
    )
    body = sinks.bounded_lines(rows, F.col("value"), ["value"], None, None)
    heads = rows.groupBy("chunk").agg(F.max("r_name").alias("r")).select(
        "chunk", F.lit(0).alias("place"), F.lit(None).cast(body.schema["at"].dataType).alias("at"), F.concat(F.lit("H|"), "r", F.lit("|20240131|20240201|101500")).alias("value")
    )
    path = scratch_path(spark, "subtables")
    sinks.write_bounded(body.unionByName(heads), path)
    lines = read_lines(spark, path)
    header = delimited.header_fields(lines, ["tag", "source", "eff_date"])
    data = lines.where(~F.col("value").startswith("H|"))
    parts = records.route_by_type(data, F.get(F.split("value", r"\|"), 0), {"CU": "customer", "SU": "supplier"})
    out = None
    for name in ("customer", "supplier"):
        keyed = parts[name].select("file_path", F.get(F.split("value", r"\|"), 1).cast("bigint").alias("key"), F.lit(name).alias("kind"))
        out = keyed if out is None else out.unionByName(keyed)
    return out.join(header, "file_path").groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys"))


# Fixed width ---------------------------------------------------------------------------------------

DEC = "cast(cast({0} AS decimal(18,2)) AS varchar)"


@query("fixed_width_parse", f"""
SELECT cast(l_orderkey AS varchar) AS order_key, cast(l_linenumber AS varchar) AS line_number, cast(l_partkey AS varchar) AS part, cast(l_suppkey AS varchar) AS supplier,
  {DEC.format('l_quantity')} AS quantity, {DEC.format('l_extendedprice')} AS price, {DEC.format('l_discount')} AS discount, {DEC.format('l_tax')} AS tax,
  l_returnflag AS return_flag, l_linestatus AS line_status, strftime(l_shipdate, '%Y%m%d') AS ship_date FROM lineitem
""")
def fixed_width_parse(spark, sf):
    return fw.parse_fixed_width(read_lines(spark, feeds.item_lines(spark, sf)), feeds.ORDER_LAYOUT, "B")


@query("record_type_filter", f"SELECT {feeds.ORDER_LINE} AS value FROM orders")
def record_type_filter(spark, sf):
    lines = read_lines(spark, feeds.order_feed(spark, sf))
    return fw.data_lines(lines, 3, "A", feeds.HEADER_TAG, feeds.TRAILER_TAG).select("value")


@query("header_join", f"""
SELECT 'ORDERS ITEMS' AS form_name, '2024-01-31' AS run_date, 'REFRESHED' AS refreshed_updated, lpad(cast(o_orderkey // {feeds.ORDERS_PER_FILE} AS varchar), 8, '0') AS chunk,
  cast(o_orderkey AS varchar) AS order_key, trim(o_orderpriority) AS priority, 'two blanks' AS note FROM orders
""")
def header_join(spark, sf):
    lines = read_lines(spark, feeds.order_feed(spark, sf))
    heads = first_lines(lines)
    data = fw.parse_fixed_width(fw.data_lines(lines, 3, "A", feeds.HEADER_TAG, feeds.TRAILER_TAG), feeds.ORDER_LAYOUT, "A", keep=["file_path"])
    cut = [fw.field_column(f).alias(f.name) for f in feeds.HEADER_LAYOUT]
    out = fw.attach_header(data, heads, cut)
    return out.select(
        "form_name", F.try_to_timestamp("run_date", F.lit("MM/dd/yyyy")).cast("date").cast("string").alias("run_date"), "refreshed_updated", "chunk", "order_key", "priority", "note"
    )


LINES_SQL = f"""
lines AS (
  SELECT o_orderkey // {feeds.ORDERS_PER_FILE} AS chunk, o_orderkey AS k, 'A' AS kind, '' AS s, {feeds.ORDER_LINE} AS value FROM orders
  UNION ALL SELECT l_orderkey // {feeds.ORDERS_PER_FILE}, l_orderkey, 'B', lpad(cast(l_linenumber AS varchar), 3, '0') || '/' || {feeds.ITEM_LINE}, {feeds.ITEM_LINE}
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
"""


@query("file_line_number", f"""
WITH {LINES_SQL} SELECT lpad(cast(chunk AS varchar), 8, '0') AS chunk, row_number() OVER (PARTITION BY chunk ORDER BY k, kind, s) + 1 AS line_no, md5(value) AS digest FROM lines
""")
def file_line_number(spark, sf):
    lines = read_lines(spark, feeds.order_feed(spark, sf))
    numbered = with_line_order(lines)
    # A row per file, written so that Spark sees how small it is.
    heads = written(numbered.where("line_no = 1").select("file_path", fw.field_column(feeds.HEADER_LAYOUT[-1]).alias("chunk")), "heads")
    data = numbered.where(~F.col("value").startswith(feeds.HEADER_TAG) & ~F.col("value").startswith(feeds.TRAILER_TAG))
    return data.join(heads, "file_path").select("chunk", "line_no", F.md5("value").alias("digest"))


@query("head_per_group", f"""
WITH {LINES_SQL} SELECT value FROM lines QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY k, kind, s) <= 4
UNION ALL SELECT DISTINCT concat(rpad('{feeds.HEADER_TAG}', 18, ' '), rpad('ORDERS ITEMS', 18, ' '), rpad('DATA OF', 10, ' '), '01/31/2024 REFRESHED ', lpad(cast(chunk AS varchar), 8, '0')) FROM lines
""")
def head_per_group(spark, sf):
    return head_lines(with_line_order(read_lines(spark, feeds.order_feed(spark, sf))), 5).select("value")


@query("conditional_layout", """
SELECT cast(o_orderkey AS varchar) AS order_key, o_orderstatus AS country, CASE WHEN o_orderstatus IN ('F', 'O') THEN substr(o_orderpriority, 1, 5) END AS zip,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN trim(substr(o_orderpriority, 1, 10)) END AS foreign_code,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN trim(substr(o_orderpriority, 6)) ELSE trim(substr(o_orderpriority, 11)) END AS rest FROM orders
""")
def conditional_layout(spark, sf):
    line = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), "o_orderstatus", F.rpad("o_orderpriority", 20, " "))
    path = feeds.text_dir(table(spark, sf, "orders").select(line.alias("value")), "conditional")
    home, away = "US or Canada addresses only", "Non-US or Canada addresses only"
    rows = [("order key", "001-012", "", "0"), ("country", "013", "", ""), ("zip", "014-018", home, ""), ("rest", "019-033", home, ""), ("foreign code", "014-023", away, ""), ("rest", "024-033", away, "")]
    layout = fw.layout_from_positions({"field_name": n, "position": p, "conditional_changes": c, "scale": s} for n, p, c, s in rows)
    return fw.parse_conditional(read_lines(spark, path), layout, "country", {home: ["F", "O"]}, otherwise=away)


@query("trailer_control_total", f"""
WITH {LINES_SQL} SELECT count(*) AS trailer_rows, count(*) AS data_rows, true AS is_balanced FROM lines GROUP BY chunk
""")
def trailer_control_total(spark, sf):
    lines = read_lines(spark, feeds.order_feed(spark, sf))
    is_trailer = F.col("value").startswith(feeds.TRAILER_TAG)
    trailers = lines.where(is_trailer).select("file_path", F.substring("value", 19, 10).cast("bigint").alias("trailer_rows"))
    data = lines.where(~is_trailer & ~F.col("value").startswith(feeds.HEADER_TAG))
    return quality.control_totals(data, trailers).drop("file_path")


# Multi-line records --------------------------------------------------------------------------------

def order_entities(spark, sf):
    lines = read_lines(spark, feeds.order_feed(spark, sf))
    numbered = with_line_order(lines, F.substring("value", 1, 3) == "ORA")
    return numbered.where(F.col("value").startswith("OR"))


@query("entity_groups", f"""
WITH {LINES_SQL} SELECT dense_rank() OVER (PARTITION BY chunk ORDER BY k) AS entity_no, k AS order_key, count(*) AS line_count, sha256(sha256(sha256(string_agg(sha256(value), '' ORDER BY kind, s)))) AS entity_id
FROM lines GROUP BY chunk, k
""")
def entity_groups(spark, sf):
    e = written(order_entities(spark, sf), "entity-lines")
    keys = e.where(F.col("line_no") == F.col("entity_start")).select("file_path", "entity_no", F.substring("value", 4, 12).cast("bigint").alias("order_key"))
    return records.entity_hash(e).join(keys, ["file_path", "entity_no"]).select("entity_no", "order_key", "line_count", "entity_id")


CONVERSATION_LINE = "concat(case when turn = 0 then 'S' else 'T' end, ' ', role, ' ', replace(replace(text, chr(10), ' '), chr(13), ' '))"


@query("entity_hash", f"""
SELECT count(*) AS line_count, sha256(sha256(sha256(string_agg(sha256({CONVERSATION_LINE}), '' ORDER BY turn)))) AS entity_id FROM conversations GROUP BY conv_id
""")
def entity_hash(spark, sf):
    path = feeds.ordered_text(table(spark, sf, "conversations"), F.expr(CONVERSATION_LINE), ["conv_id", "turn"], "talk", "conv_id")
    lines = with_line_order(read_lines(spark, path), F.col("value").startswith("S "))
    return records.entity_hash(lines).select("line_count", "entity_id")


@query("entity_hash_tree", f"""
WITH one AS (SELECT conv_id, turn // 2 AS b1, count(*) AS n, sha256(string_agg(sha256({CONVERSATION_LINE}), '' ORDER BY turn)) AS h FROM conversations GROUP BY 1, 2),
two AS (SELECT conv_id, b1 // 2 AS b2, sum(n) AS n, sha256(string_agg(h, '' ORDER BY b1)) AS h FROM one GROUP BY 1, 2)
SELECT cast(sum(n) AS bigint) AS line_count, sha256(string_agg(h, '' ORDER BY b2)) AS entity_id FROM two GROUP BY conv_id
""")
def entity_hash_tree(spark, sf):
    """The same tree with two hashes at a time, so that talks of more than four lines fill its levels."""
    path = feeds.ordered_text(table(spark, sf, "conversations"), F.expr(CONVERSATION_LINE), ["conv_id", "turn"], "talk", "conv_id")
    lines = with_line_order(read_lines(spark, path), F.col("value").startswith("S "))
    return records.entity_hash(lines, fan_out=2).select("line_count", "entity_id")


@query("entity_hash_dated", f"""
SELECT conv_id, turn, sha256(sha256(sha256(sha256({CONVERSATION_LINE} || '2024-01-31 00:00:00')))) AS entity_id FROM conversations
""")
def entity_hash_dated(spark, sf):
    talk = table(spark, sf, "conversations").withColumns({"value": F.expr(CONVERSATION_LINE), "file_path": F.col("conv_id"), "entity_no": F.col("turn"), "line_no": F.lit(1), "entity_start": F.lit(1)})
    out = records.with_entity_hash(talk, F.lit("2024-01-31 00:00:00"))
    return out.select("conv_id", "turn", "entity_id")


def segment_part(n: int) -> str:
    return f"string_agg(cast(l_partkey AS varchar), '' ORDER BY lpad(cast(l_partkey AS varchar), 12, '0')) FILTER (l_linenumber = {n - 1}) AS part_{n}, count(*) FILTER (l_linenumber = {n - 1}) AS n{n}"


@query("segment_merge", f"""
WITH parts AS (SELECT l_orderkey, {segment_part(2)}, {segment_part(3)}, {segment_part(4)} FROM lineitem GROUP BY 1)
SELECT cast(o_orderkey AS varchar) AS order_key, {DEC.format('o_totalprice')} AS price,
  concat(o_orderstatus, '1', repeat('r2', coalesce(n2, 0)), repeat('r3', coalesce(n3, 0)), repeat('r4', coalesce(n4, 0))) AS remark, part_2, part_3, part_4
FROM orders LEFT JOIN parts ON l_orderkey = o_orderkey
""")
def segment_merge(spark, sf):
    return records.merge_segments(segment_lines(spark, sf), feeds.SEGMENT_LAYOUT, F.substring("value", 1, 1)).drop("file_path", "entity_no")


@query("segment_rejects", """
SELECT concat(l_linenumber + 1, lpad(cast(l_orderkey AS varchar), 12, '0'), lpad(cast(l_partkey AS varchar), 12, '0'), ' r', l_linenumber + 1) AS value
FROM lineitem WHERE l_linenumber > 3 AND l_orderkey IN (SELECT o_orderkey FROM orders)
""")
def segment_rejects(spark, sf):
    return records.segment_rejects(segment_lines(spark, sf), feeds.SEGMENT_LAYOUT, F.substring("value", 1, 1)).select("value")


def segment_lines(spark, sf):
    path = written_once(spark, ("segments", sf), lambda: write_segments(spark, sf))
    return with_line_order(read_lines(spark, path), F.col("value").startswith("1"))


def write_segments(spark, sf):
    """Orders with all their lines as segments from 2 on, repeated line numbers included; 5 and above have no layout."""
    key = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    first = F.struct(F.lit("1").alias("seg"), F.concat(F.lit("1"), key("o_orderkey"), F.lpad(F.expr(feeds.cents("o_totalprice")), 13, "0"), "o_orderstatus", F.lit("1")).alias("line"))
    seg, part = (F.col("l_linenumber") + 1).cast("string"), key("l_partkey")
    rest = F.struct(F.concat(seg, part).alias("seg"), F.concat(seg, key("l_orderkey"), part, F.lit(" r"), seg).alias("line"))
    rows = feeds.order_and_item_rows(spark, sf, first, rest).select(F.col("order_key").alias("k"), "is_order", "value.seg", "value.line")
    known = F.max("is_order").over(Window.partitionBy("k"))
    return feeds.ordered_text(rows, F.col("line"), ["k", "seg"], "segments", "k", having=known)


def account_lines(spark, sf):
    path = written_once(spark, ("accounts", sf), lambda: write_accounts(spark, sf))
    lines = with_line_order(read_lines(spark, path), F.col("value").startswith("D101")).where(F.col("value").startswith("D"))
    # Numbered once; roots, children and rejects are read from the staged lines.
    return written(lines, "staged-lines")


def write_accounts(spark, sf):
    """Customers as hierarchical records: root, names in slots, one nation record, one address record per order, and strangers."""
    c = table(spark, sf, "customer")
    common = F.concat(F.lit("F001"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
    person = F.col("c_mktsegment") != "BUILDING"
    slot = F.concat(F.when(person, "P").otherwise("B"), F.rpad("c_mktsegment", 12, " "), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    blank = F.rpad(F.lit(""), 22, " ")
    second = F.concat(F.lit("P"), F.rpad(F.lit("SECOND"), 12, " "), F.rpad(F.lit(""), 9, " "))
    balance = F.lpad(F.expr("cast(cast(round(abs(c_acctbal) * 100) as bigint) as string)"), 11, "0")
    root = c.select("c_custkey", F.lit("0").alias("s"), F.concat(F.lit("D101"), common, balance, F.rpad("c_mktsegment", 12, " ")).alias("value"))
    names = c.select("c_custkey", F.lit("1").alias("s"), F.concat(F.lit("D102"), common, F.when(F.col("c_acctbal") < 0, F.lit("02")).otherwise("01"), slot, F.when(F.col("c_acctbal") < 0, second).otherwise(blank), blank).alias("value"))
    nation = c.select("c_custkey", F.lit("2").alias("s"), F.concat(F.lit("D104"), common, F.rpad(F.col("c_nationkey").cast("string"), 5, " ")).alias("value"))
    strange = c.where("c_acctbal < 0").select("c_custkey", F.lit("3").alias("s"), F.concat(F.lit("D104F999"), F.substring(common, 5, 9), F.lit("xxxxx")).alias("value"))
    o = table(spark, sf, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_custkey", "c_nationkey"), "o_custkey")
    address = o.select("c_custkey", F.concat(F.lit("4"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("s"), F.concat(F.lit("D2"), F.lpad((F.col("o_orderkey") % 10).cast("string"), 1, "0"), F.lit("0"), common, F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lpad(F.expr(feeds.cents("o_totalprice")), 13, "0")).alias("value"))
    lines = root.unionByName(names).unionByName(nation).unionByName(strange).unionByName(address)
    return feeds.ordered_text(lines, F.col("value"), ["c_custkey", "s"], "accounts", "c_custkey")


def account_documents(spark, sf, max_lines=records.MAX_LINES):
    lines = account_lines(spark, sf)
    number = F.substring("value", 2, 3)
    key = [F.substring("value", 5, 4), F.substring("value", 9, 3), F.substring("value", 12, 6)]
    roots, children, rejects = records.match_root(lines, number == "101", key)
    layout = feeds.RECORD_LAYOUT
    address = F.struct(*[fw.field_column(f).alias(f.name) for f in layout["2X0"]])
    slots = records.name_slots(layout["102"], "_ffr_name_type", ["_ffr_primary_acct_name", "_ffr_ssn_number"])
    count = fw.field_column(layout["102"][0]).try_cast("int")
    docs = records.assemble(
        roots, children, [fw.field_column(f).alias(f.name) for f in layout["101"]],
        lists={"names": (number == "102", slots), "addresses": (number.startswith("2"), address)},
        singles={"nation": (number == "104", fw.field_column(layout["104"][0]))},
        sums={"ffr_name_count": (number == "102", count)},
        max_lines=max_lines,
    )
    return docs.withColumn("names", F.flatten("names")), rejects


@query("hierarchical_records", f"""
SELECT lpad(cast(c_custkey AS varchar), 6, '0') AS account_number, 0 AS part_no, {DEC.format('abs(c_acctbal)')} AS balance, c_mktsegment AS segment, cast(c_nationkey AS varchar) AS nation,
  CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS ffr_name_count, c_mktsegment || '/' || CASE WHEN c_mktsegment <> 'BUILDING' THEN lpad(cast(c_custkey AS varchar), 9, '0') ELSE '' END || CASE WHEN c_acctbal < 0 THEN ' SECOND/' ELSE '' END AS names,
  (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS addresses,
  (SELECT string_agg(o_orderkey || '=' || {DEC.format('o_totalprice')}, ' ' ORDER BY o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS address_text FROM customer
""")
def hierarchical_records(spark, sf):
    docs, _ = account_documents(spark, sf)
    names = F.array_join(F.transform("names", lambda x: F.concat_ws("/", x["ffr_primary_acct_name"], F.coalesce(x["ffr_ssn_number"], F.lit("")))), " ")
    text = F.array_join(F.transform("addresses", lambda x: F.concat_ws("=", F.regexp_replace(x["order_key"], "^0+(?=.)", ""), x["price"])), " ")
    return docs.select(
        "account_number", "part_no", "balance", "segment", "nation", F.col("ffr_name_count").cast("int").alias("ffr_name_count"), names.alias("names"),
        F.size("addresses").cast("bigint").alias("addresses"), F.nullif(text, F.lit("")).alias("address_text"),
    )


@query("hierarchical_rejects", "SELECT lpad(cast(c_custkey AS varchar), 6, '0') AS account, 'F999' AS firm FROM customer WHERE c_acctbal < 0")
def hierarchical_rejects(spark, sf):
    _, rejects = account_documents(spark, sf)
    return rejects.select(F.substring("value", 12, 6).alias("account"), F.substring("value", 5, 4).alias("firm"))


@query("root_with_children", f"""
SELECT lpad(cast(c_custkey AS varchar), 6, '0') AS account_number, 'address' AS child, cast(o_orderkey AS varchar) AS detail FROM customer JOIN orders ON o_custkey = c_custkey
UNION ALL SELECT lpad(cast(c_custkey AS varchar), 6, '0'), 'nation', cast(c_nationkey AS varchar) FROM customer
UNION ALL SELECT lpad(cast(c_custkey AS varchar), 6, '0'), 'names', CASE WHEN c_acctbal < 0 THEN '2' ELSE '1' END FROM customer
""")
def root_with_children(spark, sf):
    """The relational form: one table per child type, each row with its root's key."""
    lines = account_lines(spark, sf)
    number = F.substring("value", 2, 3)
    key = [F.substring("value", 5, 4), F.substring("value", 9, 3), F.substring("value", 12, 6)]
    _, children, _ = records.match_root(lines, number == "101", key)
    kind = F.when(number.startswith("2"), "address").when(number == "102", "names").otherwise("nation")
    routed = scratch_path(spark, "children")
    records.write_routed(children, kind, routed)
    children = spark.read.parquet(routed)
    cut = {"address": feeds.RECORD_LAYOUT["2X0"][0], "names": feeds.RECORD_LAYOUT["102"][0], "nation": feeds.RECORD_LAYOUT["104"][0]}
    out = None
    for name, f in cut.items():
        detail = F.regexp_replace(fw.field_column(f), "^0+(?=.)", "")
        rows = children.where(F.col("kind") == name).select(F.substring("value", 12, 6).alias("account_number"), F.col("kind").alias("child"), detail.alias("detail"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("route_by_type", """
SELECT 'A' AS kind, count(*) AS n, cast(sum(o_orderkey) AS bigint) AS keys FROM orders
UNION ALL SELECT 'B', count(*), cast(sum(l_orderkey) AS bigint) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
""")
def route_by_type(spark, sf):
    lines = feeds.order_lines(spark, sf).select("value")
    path = scratch_path(spark, "routed")
    records.write_routed(lines, F.substring("value", 3, 1), path)
    return spark.read.parquet(path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.substring("value", 4, 12).cast("bigint")).alias("keys"))


@query("route_with_headers", f"""
WITH {LINES_SQL} SELECT kind, 'BOF      ORDERS RECORD ' || kind AS header, count(*) AS n, count(*) AS trailer FROM lines GROUP BY chunk, kind
""")
def route_with_headers(spark, sf):
    """Record types to files of their own; each file's header names its type, its trailer counts its lines."""
    kind = F.substring("value", 3, 1)
    lines = feeds.order_lines(spark, sf).select(kind.alias("kind"), F.floor(F.col("order_key") / feeds.ORDERS_PER_FILE).alias("chunk"), F.lit(1).alias("record_in_chunk"), "order_key", "value")
    header = F.concat(F.lit("BOF      ORDERS RECORD "), F.col("kind"))
    # Counted once, for headers and trailers.
    counts = written(lines.groupBy("kind", "chunk", "record_in_chunk").agg(F.count(F.lit(1)).alias("n")), "chunks")
    body = sinks.bounded_lines(lines, F.col("value"), ["order_key"], header, None, keys=["kind"], counted=counts)
    trailer = F.concat(F.lit("EOF      "), F.lpad(F.col("n").cast("string"), 10, "0"))
    ends = counts.select("kind", "chunk", F.lit(2).alias("place"), F.lit(None).cast(body.schema["at"].dataType).alias("at"), trailer.alias("value"))
    path = scratch_path(spark, "routed-files")
    sinks.write_bounded(body.unionByName(ends), path, keys=["kind"])
    back = with_line_order(read_lines(spark, path))
    edge = F.col("value").startswith("BOF") | F.col("value").startswith("EOF")
    return back.groupBy("file_path").agg(
        F.max(F.when(~edge, F.substring("value", 3, 1))).alias("kind"),
        F.max(F.when(F.col("line_no") == 1, F.col("value"))).alias("header"),
        F.count(F.when(~edge, 1)).alias("n"),
        F.max(F.when(F.col("value").startswith("EOF"), F.substring("value", 10, 10))).cast("bigint").alias("trailer"),
    ).drop("file_path")


@query("record_arrays", f"""
WITH {LINES_SQL} SELECT k AS order_key, 0 AS part_no, count(*) FILTER (kind = 'A') AS record_a, count(*) FILTER (kind = 'B') AS record_b FROM lines GROUP BY k
""")
def record_arrays(spark, sf):
    kind = F.substring("value", 3, 1)
    docs = collect_records(written(order_entities(spark, sf), "staged-lines"), ["file_path", "entity_no"], {"record_a": kind == "A", "record_b": kind == "B"}, ["line_no"], ["value"])
    return docs.select(
        F.substring(F.coalesce(F.get("record_a", 0), F.get("record_b", 0))["value"], 4, 12).cast("bigint").alias("order_key"), "part_no", F.size("record_a").cast("bigint").alias("record_a"), F.size("record_b").cast("bigint").alias("record_b")
    )


# Sinks ---------------------------------------------------------------------------------------------

@query("bounded_split", """
WITH e AS (SELECT l_orderkey, count(*) AS n, dense_rank() OVER (ORDER BY l_orderkey) AS no FROM lineitem GROUP BY 1)
SELECT (no - 1) // 1000 AS chunk, count(*) AS entities, cast(sum(n) AS bigint) AS lines, count(*) AS trailer, 'HDR ' || ((no - 1) // 1000) AS header FROM e GROUP BY (no - 1) // 1000
""")
def bounded_split(spark, sf):
    """Files of 1000 orders, an order never cut, entity numbers starting anew in each file."""
    l = table(spark, sf, "lineitem")
    numbered = ranking.table_numbers(l.select("l_orderkey").distinct(), ["l_orderkey"], "entity_no")
    entities = sinks.chunked(numbered, "entity_no", 1000)
    chunks = l.join(entities, "l_orderkey")
    line = F.concat(F.lit("D"), F.lpad(F.col("record_in_chunk").cast("string"), 8, "0"), F.expr(feeds.ITEM_LINE))
    header = F.concat(F.lit("HDR "), F.col("chunk").cast("string"))
    trailer = F.concat(F.lit("TRL "), F.lpad(F.col("records").cast("string"), 10, "0"))
    path = scratch_path(spark, "bounded")
    sinks.write_bounded(sinks.bounded_lines(chunks, line, ["record_in_chunk"], header, trailer, counted=entities), path)
    back = with_line_order(read_lines(spark, path))
    is_line = F.col("value").startswith("D")
    per_file = back.groupBy("file_path").agg(
        F.count_distinct(F.when(is_line, F.substring("value", 2, 8))).alias("entities"),
        F.count(F.when(is_line, 1)).alias("lines"),
        F.max(F.when(F.col("value").startswith("TRL"), F.substring("value", 5, 10))).cast("bigint").alias("trailer"),
        F.max(F.when(F.col("line_no") == 1, F.col("value"))).alias("header"),
    )
    return per_file.select(F.regexp_extract("file_path", "chunk=([0-9]+)", 1).cast("bigint").alias("chunk"), "entities", "lines", "trailer", "header")


@query("bounded_line_split", """
SELECT (row_number() OVER (ORDER BY event_id) - 1) // 700 AS chunk, event_id FROM events
""")
def bounded_line_split(spark, sf):
    """Files of 700 lines, whatever they hold."""
    chunks = sinks.chunked(ranking.table_numbers(table(spark, sf, "events").select("event_id"), ["event_id"], "n"), "n", 700)
    path = scratch_path(spark, "line-split")
    sinks.write_bounded(sinks.bounded_lines(chunks, F.col("event_id").cast("string"), ["event_id"], None, None), path)
    back = read_lines(spark, path)
    return back.select(F.regexp_extract("file_path", "chunk=([0-9]+)", 1).cast("bigint").alias("chunk"), F.col("value").cast("bigint").alias("event_id"))


@query("lake_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_orderdate AS varchar) AS o_orderdate FROM orders
""")
def lake_roundtrip(spark, sf):
    path = scratch_path(spark, "lake")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("O_ORDERKEY"), "o_custkey", "o_orderstatus", "o_orderdate")
    lake.write_lake(o, path, ["o_orderstatus"], rows_per_file=2000)
    back = lake.read_lake(spark, path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("string").alias("o_orderdate"))


@query("latest_partition", """
SELECT event_id, event_type FROM events WHERE cast(ts AS date) = (SELECT max(cast(ts AS date)) FROM events)
""")
def latest_partition(spark, sf):
    path = scratch_path(spark, "days")
    e = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("elt_partition_date"))
    lake.write_lake(e, path)
    return lake.read_latest_partition(spark, path).select("event_id", "event_type")


@query("outbound_extract", """
SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus, cast(cast(o_totalprice AS decimal(18,2)) AS varchar) AS price, 'orders_2024-01-31.csv' AS name FROM orders
""")
def outbound_extract(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    path = sinks.write_extract(o, scratch_path(spark, "out"), "orders", dt.datetime(2024, 1, 31), "yyyy-mm-dd", sep="|", header=True)
    back = spark.read.option("header", True).option("sep", "|").csv(path)
    return back.withColumn("name", F.lit(path.rsplit("/", 1)[1]))


@query("quoted_dump", """
SELECT '"' || doc_id || '","' || lang || '","' || replace(replace(substr(source, 1, 3) || ',"' || source, '"', '""'), chr(10), ' ') || '"' AS value FROM documents
UNION ALL SELECT 'header' FROM region WHERE r_regionkey = 0
""")
def quoted_dump(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("DOC_ID"), F.col("lang").alias("Lang"), F.concat(F.substring("source", 1, 3), F.lit(',"'), "source").alias("ORIGIN"))
    path = scratch_path(spark, "dump")
    sinks.write_quoted(d, path)
    value = F.when(F.col("value") == '"doc_id","lang","origin"', "header").otherwise(F.col("value"))
    lines = read_lines(spark, path).select(value.alias("value"))
    return lines.where("value <> 'header'").unionByName(lines.where("value = 'header'").distinct())


# Documents -----------------------------------------------------------------------------------------

@query("read_json_docs", "SELECT event_id, event_type, cast(json_extract(props, '$.k') AS bigint) AS k FROM events")
def read_json_docs(spark, sf):
    path = scratch_path(spark, "json")
    doc = F.struct("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    table(spark, sf, "events").select(F.to_json(doc).alias("value")).write.text(path)
    schema = "event_id bigint, event_type string, props struct<k: bigint>"
    return documents.read_json_docs(spark, path, schema, multi_line=False).select("event_id", "event_type", "props.k")


@query("json_column_rows", "SELECT event_id, user_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events")
def json_column_rows(spark, sf):
    return documents.json_column_rows(table(spark, sf, "events").select("event_id", "user_id", "props"), "props", "k bigint")


@query("json_payload_rows", "SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, props AS payload FROM events")
def json_payload_rows(spark, sf):
    return documents.payload_rows(table(spark, sf, "events"), "props", {"k": "$.k"}, ["event_id", "event_type"])


@query("json_functions", """
SELECT event_id, json_extract_string(props, '$.k') AS by_path, cast(json_extract(props, '$.k') AS bigint) AS typed, 'k' AS first_key, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS built FROM events
""")
def json_functions(spark, sf):
    v = F.parse_json("props")
    return table(spark, sf, "events").select(
        "event_id", F.variant_get(v, "$.k", "string").alias("by_path"), F.from_json("props", "k bigint")["k"].alias("typed"),
        F.get(F.json_object_keys("props"), 0).alias("first_key"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("built"),
    )


@query("parallel_arrays_to_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, cast(round(l_extendedprice * 100) AS bigint) AS cents FROM lineitem
""")
def parallel_arrays_to_rows(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    docs = collect_records(l, ["l_orderkey"], {"r": F.lit(True)}, ["l_linenumber", "l_partkey", "cents"], [])
    text = F.to_json(F.struct(*[F.col("r").getField(n).alias(n) for n in ("l_linenumber", "l_partkey", "cents")]))
    schema = "l_linenumber array<int>, l_partkey array<bigint>, cents array<bigint>"
    parsed = docs.select("l_orderkey", F.from_json(text, schema).alias("d")).select("l_orderkey", "d.*")
    return documents.parallel_arrays_to_rows(parsed, ["l_linenumber", "l_partkey", "cents"], ["l_orderkey"])


def nation_xml(spark, sf):
    return written_once(spark, ("xml", sf), lambda: write_nation_xml(spark, sf))


def write_nation_xml(spark, sf):
    """One XML file per region: a criteria element, then one element per customer."""
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("r_regionkey").cast("bigint").alias("chunk"), F.lit(1).alias("record_in_chunk"), "c_custkey",
        F.concat(F.lit('<row key="'), F.col("c_custkey").cast("string"), F.lit('"><name> '), "c_name", F.lit(' </name><nation code="'), F.col("c_nationkey").cast("string"), F.lit('"><label>'), "n_name", F.lit("</label></nation></row"), F.when(F.col("c_custkey") % 3 == 0, " >").otherwise(">")).alias("value"),
    )
    header = F.concat(F.lit('<rows><criteria firm="f'), F.col("chunk").cast("string"), F.lit('" as_of="2024-01-31"/>'))
    path = scratch_path(spark, "xml")
    sinks.write_bounded(sinks.bounded_lines(rows, F.col("value"), ["c_custkey"], header, F.lit("</rows>")), path)
    return path


XML_SCHEMA = "_key bigint, name string, nation struct<_code: int, label: string>"


@query("read_xml", "SELECT c_custkey AS key, c_name AS name, c_nationkey AS code, n_name AS label FROM customer JOIN nation ON c_nationkey = n_nationkey")
def read_xml(spark, sf):
    rows = documents.xml_rows(documents.xml_pieces(spark, nation_xml(spark, sf), "row"), "row", XML_SCHEMA)
    return rows.select(F.col("_key").alias("key"), "name", F.col("nation._code").alias("code"), F.col("nation.label").alias("label"))


@query("xml_rejects", """
SELECT 'f' || n_regionkey AS firm, count(*) AS rejects, cast(sum(c_custkey) AS bigint) AS keys FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 = 0 GROUP BY n_regionkey
""")
def xml_rejects(spark, sf):
    """Rows that are never closed are no rows of the table, nor lost: they and what they run into come back as texts."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    whole = F.concat(F.lit('<row key="'), F.col("c_custkey").cast("string"), F.lit('"><name>'), "c_name", F.lit("</name></row>"))
    torn = F.concat(F.lit('<row key="'), F.col("c_custkey").cast("string"), F.lit('"><name>'), "c_name", F.lit('<row key="0"><name>'), "c_name", F.lit("</name></row>"))
    path = scratch_path(spark, "torn")
    c.select(F.col("n_regionkey").alias("region"), F.when(F.col("c_custkey") % 10 == 0, torn).otherwise(whole).alias("value")).write.partitionBy("region").text(path)
    left = documents.xml_rejects(documents.xml_pieces(spark, path, "row"), "row")
    firm = F.concat(F.lit("f"), F.regexp_extract("file_path", "/region=([^/]*)/", 1))
    key = F.regexp_extract("xml", '^<row key="([0-9]+)"', 1).cast("bigint")
    return left.groupBy(firm.alias("firm")).agg(F.count(F.lit(1)).alias("rejects"), F.sum(key).alias("keys"))


@query("xml_header_struct", """
SELECT c_custkey AS key, 'f' || n_regionkey AS firm, '2024-01-31' AS as_of FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def xml_header_struct(spark, sf):
    pieces = documents.xml_pieces(spark, nation_xml(spark, sf), "row")
    rows = documents.xml_rows(pieces, "row", XML_SCHEMA).select("_key", "file_path")
    heads = documents.xml_elements(pieces, "criteria", "_firm string, _as_of string")
    out = documents.attach_header_struct(rows, heads)
    return out.select(F.col("_key").alias("key"), F.col("criteria._firm").alias("firm"), F.col("criteria._as_of").alias("as_of"))


@query("config_select", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def config_select(spark, sf):
    return lake.select_from_config(table(spark, sf, "customer"), "c_custkey, c_name,c_nationkey", "c_mktsegment = 'BUILDING' AND c_acctbal > 0")


# File names ----------------------------------------------------------------------------------------

@query("file_name_meta", """
WITH d AS (SELECT o_orderkey, o_custkey, cast(o_orderdate AS date) AS day, o_orderstatus AS st FROM orders)
SELECT o_orderkey, 'firm_table_date' AS dialect, 'branches' AS table_name, cast(o_custkey AS varchar) AS firm, cast(day AS varchar) AS day, NULL AS sequence_number, NULL::BOOLEAN AS is_full_load FROM d
UNION ALL SELECT o_orderkey, 'table_date', CASE WHEN st <> 'P' THEN 'big_orders' END, NULL, CASE WHEN st <> 'P' THEN cast(day AS varchar) END, NULL, NULL FROM d
UNION ALL SELECT o_orderkey, 'six_parts', 'ab_pos', NULL, cast(day AS varchar), CASE WHEN st = 'F' THEN 'full' ELSE '007' END, st = 'F' FROM d
UNION ALL SELECT o_orderkey, 'type_institution', 'tr', '77', cast(day AS varchar), '03', NULL FROM d
UNION ALL SELECT o_orderkey, 'group_prefix', 'reps', 'abc', cast(day AS varchar), NULL, NULL FROM d
""")
def file_name_meta_query(spark, sf):
    at = F.col("o_orderdate")

    def stamp(f):
        return F.date_format(at, f)

    names = {
        "firm_table_date": F.concat(F.lit("/in/"), F.col("o_custkey").cast("string"), F.lit("_Branches_"), stamp("yyyy-MM-dd"), F.lit(".xml")),
        "table_date": F.concat(F.lit("BIG_ORDERS_"), F.when(F.col("o_orderstatus") == "P", "20011345").otherwise(stamp("yyyyMMdd")), F.lit(".csv")),
        "six_parts": F.concat(F.lit("AB_Pos_"), stamp("yyyy_MM_dd"), F.when(F.col("o_orderstatus") == "F", "_FULL.txt").otherwise("_007.txt")),
        "type_institution": F.concat(F.lit("TR77"), stamp("yyyyMMdd"), F.lit("03.txt")),
        "group_prefix": F.concat(F.lit("ABC_reps_"), stamp("MMddyy"), F.lit(".dat")),
    }
    out = None
    for dialect, name in names.items():
        named = table(spark, sf, "orders").select("o_orderkey", F.lit(dialect).alias("dialect"), name.alias("file"))
        meta = file_name_meta(named, F.col("file"), DIALECTS[dialect]).drop("file")
        meta = meta.withColumn("day", F.col("key_datetime").cast("date").cast("string")).drop("key_datetime")
        out = meta if out is None else out.unionByName(meta)
    return out


@query("file_meta_scan", """
SELECT event_type, count(*) AS n, 'events' AS table_name, '2024-01-31' AS day FROM events WHERE event_type <> (SELECT max(event_type) FROM events) GROUP BY 1
UNION ALL SELECT max(event_type), (SELECT count(*) FROM events WHERE event_type = (SELECT max(event_type) FROM events)), NULL, NULL FROM events
""")
def file_meta_scan(spark, sf):
    """Named files of each event type; those of the last have an extension that the feed does not allow."""
    e, read = table(spark, sf, "events").select("event_id", "event_type"), None
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())
    for kind in kinds:
        path = feeds.named_files(e.where(F.col("event_type") == kind), f"Events_20240131.{'bak' if kind == kinds[-1] else 'CSV'}")
        rows = with_file_meta(spark.read.option("header", True).csv(path), DIALECTS["table_date"], ["csv"])
        read = rows if read is None else read.unionByName(rows)
    day = F.col("key_datetime").cast("date").cast("string").alias("day")
    return read.groupBy("event_type", "table_name", day).agg(F.count(F.lit(1)).alias("n")).select("event_type", "n", "table_name", "day")


# Checks on files -----------------------------------------------------------------------------------

@query("size_guard", """
SELECT l_suppkey AS firm, l_returnflag AS feed, count(*) AS file_size, count(*) >= CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 3 * (SELECT count(*) FROM lineitem) / (8 * (SELECT count(DISTINCT l_suppkey) FROM lineitem)) ELSE 0 END AS is_accepted
FROM lineitem GROUP BY 1, 2
""")
def size_guard(spark, sf):
    l = table(spark, sf, "lineitem")
    files = l.groupBy(F.col("l_suppkey").alias("firm"), F.col("l_returnflag").alias("feed")).agg(F.count(F.lit(1)).alias("file_size"))
    share = l.agg((3 * F.count(F.lit(1)) / (8 * F.count_distinct("l_suppkey"))).alias("min_size"))
    limits = table(spark, sf, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("firm"), share.scalar().alias("min_size"))
    return quality.size_guard(files, limits)


@query("owner_check", """
SELECT c_custkey, CASE WHEN (c_mktsegment = 'BUILDING' AND c_nationkey = 1) OR (c_mktsegment = 'FURNITURE' AND c_nationkey = 2) THEN 'accepted' ELSE 'rejected' END AS outcome FROM customer
""")
def owner_check(spark, sf):
    ok, bad = quality.owner_check(table(spark, sf, "customer"), {"BUILDING": "1", "FURNITURE": "2"}, F.col("c_mktsegment"), F.col("c_nationkey").cast("string"))
    return ok.withColumn("outcome", F.lit("accepted")).unionByName(bad.withColumn("outcome", F.lit("rejected"))).select("c_custkey", "outcome")


@query("prefix_match", """
WITH f AS (SELECT p_partkey, 'in_' || p_brand || '_' || replace(p_name, ' ', '') || '.csv' AS file_name FROM part),
i AS (SELECT DISTINCT lower(p_brand) AS prefix, 'loc_' || p_brand AS location FROM part)
SELECT p_partkey, f.file_name, count(prefix) AS matches, min(prefix) AS prefix, arg_min(location, prefix) AS location,
  CASE WHEN count(prefix) = 0 THEN 'UNKNOWN' WHEN count(prefix) = 1 THEN 'MATCHED' ELSE 'AMBIGUOUS' END AS match_status
FROM f LEFT JOIN i ON contains(upper(f.file_name), upper(i.prefix)) GROUP BY 1, 2
""")
def prefix_match(spark, sf):
    p = table(spark, sf, "part")
    files = p.select("p_partkey", F.concat(F.lit("in_"), "p_brand", F.lit("_"), F.replace(F.col("p_name"), F.lit(" "), F.lit("")), F.lit(".csv")).alias("file_name"))
    inventory = p.select(F.lower("p_brand").alias("prefix"), F.concat(F.lit("loc_"), "p_brand").alias("location")).distinct()
    names = files.select("file_name").distinct()
    return files.join(quality.prefix_match(names, inventory), "file_name")
