"""Nested documents built from orders and line items, flattened and reshaped."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import schema_from_prototype, variant_columns
from feedloom.operators import nested
from feedloom.operators.relational import collect_records
from feedloom.plans.registry import query, table
from feedloom.session import scratch_path
from feedloom.sources.documents import read_json_docs

ITEM = ["l_linenumber", "l_partkey", "l_suppkey"]


def order_documents(spark, sf):
    """One document per order (in parts where an order has very many lines): a struct and an array of structs."""
    l = table(spark, sf, "lineitem").withColumn(
        "ship", F.struct(F.col("l_shipdate").cast("date").cast("string").alias("_date"), F.col("l_returnflag").alias("flag"))
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    lines = collect_records(l, ["o_orderkey"], {"lines": F.lit(True)}, ITEM, ["ship", "l_linestatus"])
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_orderpriority").alias("_text")).alias("priority")).alias("head"), "o_custkey"
    )
    return o.join(lines, "o_orderkey", "left").fillna(0, ["part_no"])


FLAT_SQL = """
SELECT o_orderkey, o_orderstatus AS head_status, o_orderpriority AS head_priority_text, l_linenumber AS lines_l_linenumber, l_partkey AS lines_l_partkey,
  cast(cast(l_shipdate AS date) AS varchar) AS lines_ship_date, l_returnflag AS lines_ship_flag FROM orders {join} lineitem ON l_orderkey = o_orderkey
"""


def flat_columns(df):
    return df.select("o_orderkey", "head_status", "head_priority_text", "lines_l_linenumber", "lines_l_partkey", "lines_ship_date", "lines_ship_flag")


@query("flatten_nested", FLAT_SQL.format(join="JOIN"))
def flatten_nested(spark, sf):
    return flat_columns(nested.flatten(order_documents(spark, sf).drop("part_no")))


@query("flatten_nested_outer", FLAT_SQL.format(join="LEFT JOIN"))
def flatten_nested_outer(spark, sf):
    return flat_columns(nested.flatten(order_documents(spark, sf).drop("part_no"), outer=True))


@query("flatten_divide", """
SELECT 'orders_kept' AS table_name, cast(l_orderkey AS varchar) AS order_key, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'
UNION ALL SELECT 'orders_returned', cast(l_orderkey AS varchar), l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
""")
def flatten_divide(spark, sf):
    returned = F.filter("lines", lambda x: x["ship"]["flag"] == "R")
    kept = F.filter("lines", lambda x: x["ship"]["flag"] != "R")
    docs = order_documents(spark, sf).select(F.col("o_orderkey").cast("string").alias("order_key"), returned.alias("returned"), kept.alias("kept"))
    out = None
    for name, df in nested.flatten_and_divide(docs, "orders").items():
        array = name.removeprefix("orders_")
        rows = df.select(F.lit(name).alias("table_name"), "order_key", F.col(f"{array}_l_linenumber").alias("l_linenumber"), F.col(f"{array}_l_partkey").alias("l_partkey"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("doc_builder_filtered_first", """
SELECT o_orderkey, 0 AS part_no, o_orderstatus AS status, (SELECT string_agg(l_partkey || '@' || cast(l_shipdate AS date), ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS parts,
  (SELECT arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey)) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS first_returned,
  (SELECT string_agg(l_returnflag, ', ' ORDER BY l_linenumber, l_partkey, l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS flags
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def doc_builder_filtered_first(spark, sf):
    docs = order_documents(spark, sf).where(F.size("lines") > 0)
    shipped = F.transform("lines", lambda x: F.struct(x["l_partkey"].alias("l_partkey"), x["ship"]["_date"].alias("day"), x["ship"]["flag"].alias("flag")))
    built = docs.select(
        "o_orderkey", "part_no", F.struct(F.col("head.status").alias("State")).alias("Address"),
        nested.renamed_items(shipped, {"l_partkey": "Part", "day": "Day"}).alias("Items"),
        nested.first_where(shipped, lambda x: x["flag"] == "R").alias("Registration"),
        nested.joined_codes(shipped, "flag").alias("Codes"),
    )
    text = F.array_join(F.transform("Items", lambda x: F.concat_ws("@", x["Part"].cast("string"), x["Day"])), " ")
    return built.select("o_orderkey", "part_no", F.col("Address.State").alias("status"), text.alias("parts"), F.col("Registration.l_partkey").alias("first_returned"), F.col("Codes").alias("flags"))


@query("current_vs_history_arrays", """
SELECT o_orderkey, 0 AS part_no, count(*) FILTER (l_returnflag <> 'R') AS current_items, count(*) FILTER (l_returnflag = 'R') AS history_items,
  min(cast(cast(l_shipdate AS date) AS varchar)) FILTER (l_returnflag = 'R') AS first_end FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def current_vs_history_arrays(spark, sf):
    docs = order_documents(spark, sf).where(F.size("lines") > 0)
    end = lambda x: F.when(x["ship"]["flag"] == "R", x["ship"]["_date"]).when(x["ship"]["flag"] == "A", "")
    dated = docs.select("o_orderkey", "part_no", F.transform("lines", lambda x: F.struct(x["l_partkey"].alias("part"), end(x).alias("to"))).alias("items"))
    past = nested.closed_items(F.col("items"), "to")
    return dated.select(
        "o_orderkey", "part_no", F.size(nested.current_items(F.col("items"), "to")).cast("bigint").alias("current_items"),
        F.size(past).cast("bigint").alias("history_items"), F.array_min(past.getField("to")).alias("first_end"),
    )


def listed(text: str, condition: str = "true") -> str:
    return f"(SELECT string_agg({text}, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey AND {condition})"


def first_part(condition: str) -> str:
    return f"(SELECT arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey)) FROM lineitem WHERE l_orderkey = o_orderkey AND {condition})"


def text_of(array: str, *fields: str):
    """An array of structs as text, to be compared field by field."""
    joined = F.array_join(F.transform(array, lambda x: F.concat_ws("@", *[x[f].cast("string") for f in fields])), " ")
    return F.nullif(joined, F.lit(""))


@query("branch_document", f"""
SELECT o_orderkey AS number, 0 AS part_no, o_orderstatus AS state, o_orderpriority AS level, {listed("l_partkey || '@' || cast(l_shipdate AS date)")} AS items,
  {listed("l_linenumber || '@' || l_suppkey")} AS suppliers, {first_part("l_returnflag = 'R'")} AS registration, {listed("l_returnflag", "l_linestatus = 'F'").replace("' '", "', '")} AS codes
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def branch_document(spark, sf):
    """A struct, lists side by side, the first item of a kind and a list of codes."""
    spec = {
        "Number": "o_orderkey",
        "part_no": "part_no",
        "Address": nested.Part({"State": "head.status", "Detail": nested.Part({"Level": "head.priority._text"})}),
        "Items": nested.Items("lines", {"Part": "l_partkey", "Day": "ship._date"}),
        "Suppliers": nested.Items("lines", {"Sequence_Number": "l_linenumber", "Supplier": "l_suppkey"}),
        "Registration": nested.Items("lines", {"Part": "l_partkey"}, where=nested.same("ship.flag", "R"), first=True),
        "Codes": nested.Codes("lines", "ship.flag", where=nested.same("l_linestatus", "F")),
    }
    d = nested.build_document(order_documents(spark, sf).where(F.size("lines") > 0), spec)
    return d.select(
        F.col("Number").alias("number"), "part_no", F.col("Address.State").alias("state"), F.col("Address.Detail.Level").alias("level"), text_of("Items", "Part", "Day").alias("items"),
        text_of("Suppliers", "Sequence_Number", "Supplier").alias("suppliers"), F.col("Registration.Part").alias("registration"), F.nullif("Codes", F.lit("")).alias("codes"),
    )


@query("individual_document", f"""
SELECT o_orderkey AS number, 0 AS part_no, {listed("l_partkey", "l_returnflag <> 'R'")} AS current_offices, {listed("l_partkey || '@' || cast(l_shipdate AS date)", "l_returnflag = 'R'")} AS previous_offices,
  {first_part("l_returnflag <> 'R' AND l_suppkey % 3 = 1")} AS office_of_firm, {listed("l_partkey || '/' || CASE WHEN l_linenumber > 2 THEN l_linestatus || ',' ELSE '' END || l_returnflag")} AS appointments
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def individual_document(spark, sf):
    """Current and past items, the current one of a firm, and lists within lists."""

    def history(x):
        detail = F.filter(F.array(F.struct(F.when(x["l_linenumber"] > 2, x["l_linestatus"]).alias("code")), F.struct(x["ship"]["flag"].alias("code"))), lambda d: d["code"].isNotNull())
        to = F.when(x["ship"]["flag"] == "R", x["ship"]["_date"]).when(x["ship"]["flag"] == "A", "")
        return F.struct(x["l_partkey"].alias("part"), (x["l_suppkey"] % 3).alias("_orgPK"), F.struct(to.alias("_toDt")).alias("DtRng"), F.struct(detail.alias("Detail")).alias("Details"))

    docs = order_documents(spark, sf).where(F.size("lines") > 0).withColumn("offices", F.transform("lines", history))
    is_open, closed = nested.open_ended("DtRng._toDt"), nested.ended("DtRng._toDt")
    spec = {
        "Number": "o_orderkey",
        "part_no": "part_no",
        "Current": nested.Items("offices", {"Part": "part"}, where=is_open),
        "Previous": nested.Items("offices", {"Part": "part", "To_Date": "DtRng._toDt"}, where=closed),
        "Office": nested.Items("offices", {"Part": "part"}, where=nested.every(is_open, nested.same("_orgPK", "1")), first=True),
        "Education": nested.Items("offices", {"Part": "part", "Appointments": nested.Items("Details.Detail", {"Current_Status": "code"})}),
    }
    d = nested.build_document(docs, spec)
    status = F.transform("Education", lambda x: F.concat_ws("/", x["Part"].cast("string"), F.array_join(x["Appointments"]["Current_Status"], ",")))
    return d.select(
        F.col("Number").alias("number"), "part_no", text_of("Current", "Part").alias("current_offices"), text_of("Previous", "Part", "To_Date").alias("previous_offices"),
        F.col("Office.Part").alias("office_of_firm"), F.array_join(status, " ").alias("appointments"),
    )


@query("prototype_json", """
SELECT o_orderkey AS key, 0 AS part_no, o_orderstatus AS status, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS lines FROM orders
""")
def prototype_json(spark, sf):
    """Documents read with a schema by example: every leaf is text."""
    path = scratch_path(spark, "prototype")
    order_documents(spark, sf).select(F.to_json(F.struct("o_orderkey", "part_no", "head", "lines")).alias("value")).write.text(path)
    schema = schema_from_prototype({"o_orderkey": None, "part_no": None, "head": {"status": None, "priority": {"_text": None}}, "lines": [{"l_partkey": None, "ship": {"flag": None}}]})
    docs = read_json_docs(spark, path, schema, multi_line=False)
    count = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    return docs.select(F.col("o_orderkey").cast("bigint").alias("key"), F.col("part_no").cast("int").alias("part_no"), F.col("head.status").alias("status"), count.cast("bigint").alias("lines"))


@query("variant_projection", "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL AS absent FROM events")
def variant_projection(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.parse_json("props").alias("src"))
    return rows.select("event_id", *variant_columns(F.col("src"), ["k", "absent"]))


@query("json_key_discovery", """
SELECT event_id, CASE WHEN event_type = 'click' THEN user_id::VARCHAR END AS click, CASE WHEN event_type = 'error' THEN user_id::VARCHAR END AS error, json_extract_string(props, '$.k') AS k,
  CASE WHEN event_type = 'purchase' THEN user_id::VARCHAR END AS purchase, CASE WHEN event_type = 'signup' THEN user_id::VARCHAR END AS signup, CASE WHEN event_type = 'view' THEN user_id::VARCHAR END AS view FROM events
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL FROM events
""")
def json_key_discovery(spark, sf):
    doc = F.concat(F.lit("[{}, "), F.rtrim(F.col("props"), F.lit("}")), F.lit(', "'), "event_type", F.lit('": '), F.col("user_id").cast("string"), F.lit("}]"))
    return nested.json_to_columns(table(spark, sf, "events").select("event_id", doc.alias("doc")), "doc", ["event_id"])
