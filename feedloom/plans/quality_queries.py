"""Reconciliation and load validation over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import quality
from feedloom.plans.registry import query, table
from feedloom.plans.relational_queries import CALENDAR_SQL, calendar

KEYS = ["o_orderkey"]


def both_sides(spark, sf):
    """Orders against a copy that lost a year and a priority, with dearer urgent orders and pending ones without status."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderpriority", F.year("o_orderdate").alias("y"))
    source = o.where("y <> 1995").drop("y")
    dear = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    target = o.where("y <> 2001 AND o_orderpriority <> '5-LOW'").withColumns({"price": dear, "o_orderstatus": status}).drop("y")
    return source, target


SIDES_SQL = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS price, o_orderpriority, year(o_orderdate) AS y FROM orders),
s AS (SELECT * FROM o WHERE y <> 1995),
t AS (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN price + 1 ELSE price END AS price, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus) FROM o WHERE y <> 2001 AND o_orderpriority <> '5-LOW')
"""


@query("reconcile_rows", f"""
WITH {SIDES_SQL} SELECT o_orderkey, 'target' AS missing_in, 1 AS row_count FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)
UNION ALL SELECT o_orderkey, 'source', 1 FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
""")
def reconcile_rows(spark, sf):
    return quality.reconcile(*both_sides(spark, sf), KEYS).missing


@query("reconcile_columns", f"""
WITH {SIDES_SQL}, j AS (SELECT s.*, t.price AS tp, t.o_orderstatus AS ts FROM s JOIN t USING (o_orderkey))
SELECT o_orderkey, 'price' AS column_name, cast(price AS varchar) AS source_value, cast(tp AS varchar) AS target_value, 1 AS copies FROM j WHERE price IS DISTINCT FROM tp
UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus, ts, 1 FROM j WHERE o_orderstatus IS DISTINCT FROM ts
""")
def reconcile_columns(spark, sf):
    return quality.reconcile(*both_sides(spark, sf), KEYS).mismatches


@query("reconcile_summary", f"""
WITH {SIDES_SQL} SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count, (SELECT count(*) FROM s ANTI JOIN t USING (o_orderkey)) AS only_in_source,
  (SELECT count(*) FROM t ANTI JOIN s USING (o_orderkey)) AS only_in_target, (SELECT count(*) FROM s JOIN t USING (o_orderkey) WHERE s.price <> t.price OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus) AS mismatched_keys,
  0 AS repeated_keys, 'DIFFERENT' AS status
""")
def reconcile_summary(spark, sf):
    return quality.reconcile(*both_sides(spark, sf), KEYS).summary


@query("reconcile_repeated_keys", """
WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM lineitem),
t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_returnflag END AS l_returnflag, l_partkey FROM lineitem),
cells AS (SELECT l_orderkey, l_linenumber, 'l_returnflag' AS column_name, l_returnflag AS v, 1 AS d FROM s UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', l_returnflag, -1 FROM t),
x AS (SELECT l_orderkey, l_linenumber, column_name, v, sum(d) AS extra FROM cells GROUP BY ALL HAVING sum(d) <> 0),
k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM s GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, column_name, CASE WHEN extra > 0 THEN v END AS source_value, CASE WHEN extra < 0 THEN v END AS target_value, cast(abs(extra) AS bigint) AS copies FROM x JOIN k USING (l_orderkey, l_linenumber) WHERE n > 1
UNION ALL SELECT s.l_orderkey, s.l_linenumber, 'l_returnflag', s.l_returnflag, 'X', 1 FROM s JOIN k USING (l_orderkey, l_linenumber) WHERE n = 1 AND s.l_returnflag = 'R'
""")
def reconcile_repeated_keys(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    changed = l.withColumn("l_returnflag", F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_returnflag")))
    return quality.reconcile(l, changed, ["l_orderkey", "l_linenumber"]).mismatches


@query("reconcile_missing_rows", f"WITH {SIDES_SQL} SELECT o_orderkey, o_custkey, cast(price AS varchar) AS price FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def reconcile_missing_rows(spark, sf):
    s, t = both_sides(spark, sf)
    return quality.rows_missing(s, t, KEYS).select("o_orderkey", "o_custkey", F.col("price").cast("string").alias("price"))


@query("reconcile_counts", """
SELECT count(*) AS source_count, count(*) AS target_count, 'MATCH' AS status, 'Counts match: ' || count(*) || '.' AS message FROM lineitem
""")
def reconcile_counts(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    return quality.reconcile_counts(l, l.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count")))


@query("reconcile_batch", f"""
WITH {SIDES_SQL} SELECT 1 AS config_id, (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count, 'DIFFERENT' AS status
UNION ALL SELECT 2, (SELECT count(*) FROM customer), (SELECT count(*) FROM customer), 'MATCH'
UNION ALL SELECT 3, (SELECT count(*) FROM orders), (SELECT count(*) FROM lineitem), 'DIFFERENT'
UNION ALL SELECT 5, NULL, NULL, 'ERROR'
""")
def reconcile_batch(spark, sf):
    s, t = both_sides(spark, sf)
    c = table(spark, sf, "customer")
    configs = [
        quality.ReconcileConfig(1, s, t, ("O_OrderKey",)),
        quality.ReconcileConfig(2, c, c, ("c_custkey", "c_nationkey")),
        quality.ReconcileConfig(3, table(spark, sf, "orders"), table(spark, sf, "lineitem").select("l_orderkey")),
        quality.ReconcileConfig(4, c, c, ("c_custkey",), active=False),
        quality.ReconcileConfig(5, c, c, ("no_such_key",)),
    ]
    return quality.reconcile_batch(configs).drop("result")


# Load validation -----------------------------------------------------------------------------------

def run_log(spark, sf):
    """One run per supplier nation and shipping day: rows in the file, rows ingested, rows failed."""
    l = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    failed = F.count(F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), 1))
    return l.groupBy(F.col("s_nationkey").alias("table_name"), F.col("l_shipdate").cast("date").alias("business_date")).agg(
        F.count(F.lit(1)).alias("source_rows"), failed.alias("rows_failed"), (F.count(F.lit(1)) - failed).alias("rows_ingested")
    )


RUNS_SQL = """
runs AS (SELECT s_nationkey AS table_name, cast(l_shipdate AS date) AS business_date, count(*) AS source_rows, count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 7) AS rows_failed,
  count(*) FILTER (NOT (l_returnflag = 'R' AND l_linenumber = 7)) AS rows_ingested FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
checked AS (SELECT *, lag(rows_ingested) OVER (PARTITION BY table_name ORDER BY business_date) AS previous_rows FROM runs),
judged AS (SELECT *, previous_rows > 0 AND rows_ingested * 100.0 / previous_rows < 70 AS is_drop FROM checked)
"""


@query("volume_drop", f"""
WITH {RUNS_SQL} SELECT table_name, cast(business_date AS varchar) AS business_date, rows_ingested, previous_rows, coalesce(is_drop, false) AS is_drop FROM judged
""")
def volume_drop(spark, sf):
    out = quality.volume_check(run_log(spark, sf), ["table_name"])
    return out.select("table_name", F.col("business_date").cast("string").alias("business_date"), "rows_ingested", "previous_rows", "is_drop")


def feeds(spark, sf):
    """Every nation is a feed with a frequency."""
    n = F.col("n_nationkey")
    text = F.when(n % 4 == 0, "BD_DAILY").when(n % 4 == 1, "CD_DAILY").when(n % 4 == 2, "WEEKLY_SAT").otherwise("MONTHLY_15_BD")
    return table(spark, sf, "nation").select(n.alias("table_name"), F.col("n_name").alias("file_name"), text.alias("frequency_text"))


TAGS_SQL = f"""
cal AS ({CALENDAR_SQL.format(column='l_shipdate', table='lineitem')}),
tags AS (SELECT calendar_date, 'BD_DAILY' AS tag FROM cal WHERE is_business_day UNION SELECT calendar_date, 'CD_DAILY' FROM cal
  UNION SELECT calendar_date, 'WEEKLY_' || upper(substr(dayname(calendar_date), 1, 3)) FROM cal WHERE is_weekend
  UNION SELECT calendar_date, 'MONTHLY_15_BD' FROM cal WHERE day(calendar_date) = 15),
feeds AS (SELECT n_nationkey AS table_name, n_name AS file_name, CASE n_nationkey % 4 WHEN 0 THEN 'BD_DAILY' WHEN 1 THEN 'CD_DAILY' WHEN 2 THEN 'WEEKLY_SAT' ELSE 'MONTHLY_15_BD' END AS frequency_text FROM nation),
due AS (SELECT table_name, file_name, calendar_date AS business_date FROM feeds JOIN tags ON tag = frequency_text)
"""


def due_feeds(spark, sf):
    days = calendar(table(spark, sf, "lineitem"), "l_shipdate")
    known = feeds(spark, sf)
    tags = quality.schedule_tags(days, known)
    return known.join(tags, F.col("frequency_text") == F.col("tag")).select("table_name", "file_name", F.col("calendar_date").alias("business_date"))


@query("schedule_tags", f"WITH {TAGS_SQL} SELECT cast(calendar_date AS varchar) AS calendar_date, tag FROM tags")
def schedule_tags(spark, sf):
    tags = quality.schedule_tags(calendar(table(spark, sf, "lineitem"), "l_shipdate"), feeds(spark, sf))
    return tags.select(F.col("calendar_date").cast("string").alias("calendar_date"), "tag")


VALIDATION_SQL = f"""
WITH {RUNS_SQL}, {TAGS_SQL},
v AS (SELECT due.table_name, file_name, due.business_date, rows_ingested, CASE WHEN source_rows = rows_ingested THEN 'Y' WHEN rows_failed IS NOT NULL THEN 'N' END AS load_flag,
  CASE WHEN rows_failed <> 0 THEN rows_failed || ' are not processed from source file' WHEN is_drop THEN 'Huge data surge is there' WHEN rows_ingested IS NOT NULL THEN 'NO Error' END AS error_message
  FROM due LEFT JOIN judged ON due.table_name = judged.table_name AND due.business_date = judged.business_date)
"""


@query("load_validation", VALIDATION_SQL + "SELECT table_name, cast(business_date AS varchar) AS business_date, rows_ingested, load_flag, error_message FROM v")
def load_validation(spark, sf):
    v = quality.load_validation(due_feeds(spark, sf), run_log(spark, sf), ["table_name"])
    return v.select("table_name", F.col("business_date").cast("string").alias("business_date"), "rows_ingested", "load_flag", "error_message")


@query("missing_feeds", VALIDATION_SQL + """
SELECT file_name, cast(business_date AS varchar) AS business_date, coalesce(error_message, 'This file is not  processed today') AS error_message FROM v WHERE error_message IS DISTINCT FROM 'NO Error'
""")
def missing_feeds(spark, sf):
    v = quality.load_validation(due_feeds(spark, sf), run_log(spark, sf), ["table_name"])
    return quality.missing_feeds(v).select("file_name", F.col("business_date").cast("string").alias("business_date"), "error_message")


@query("latest_runs", f"WITH {RUNS_SQL} SELECT table_name, cast(max(business_date) AS varchar) AS business_date, arg_max(rows_ingested, business_date) AS rows_ingested FROM runs GROUP BY 1")
def latest_runs(spark, sf):
    return quality.latest_runs(run_log(spark, sf), ["table_name"]).select("table_name", F.col("business_date").cast("string").alias("business_date"), "rows_ingested")


@query("preload_validation", """
SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN 'FILE_DETAILS_NOT_AVAILABLE,' ELSE '' END || CASE WHEN o_orderstatus = 'P' THEN 'LOAD_TYPE_NOT_FOUND,' ELSE '' END
  || CASE WHEN c_acctbal >= 0 AND o_orderstatus = 'F' AND c_mktsegment = 'BUILDING' THEN 'PRIMARY_KEY_COLUMNS_NOT_FOUND,' ELSE '' END
  || CASE WHEN c_acctbal >= 0 AND length(o_orderpriority) <> 8 THEN 'FIXED_LINE_LENGTH_NOT_MATCHING,' ELSE '' END AS violations
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def preload_validation(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal >= 0")
    known = c.select(
        F.col("c_custkey").alias("feed_id"), F.when(F.col("c_mktsegment") != "BUILDING", "k1,k2").alias("key_columns"),
        F.lit("FIXED_LENGTH").alias("file_format"), F.lit(8).alias("line_length"),
    )
    kind = F.when(F.col("o_orderstatus") == "F", "INCREMENTAL").when(F.col("o_orderstatus") == "O", "FULL_LOAD").otherwise("SOME")
    requests = table(spark, sf, "orders").select(F.col("o_custkey").alias("feed_id"), "o_orderkey", kind.alias("load_type"), F.length("o_orderpriority").alias("record_length"))
    out = quality.preload_violations(requests, known)
    return out.select("o_orderkey", F.array_join(F.transform("violations", lambda v: F.concat(v, F.lit(","))), "").alias("violations"))
