"""Joins, aggregates, rankings and set operators over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.dates import parse_schedule
from feedloom.operators import ranking, relational as rel
from feedloom.plans.registry import query, table

DAY = "cast(cast({0} AS date) AS varchar)"


def day(c):
    return F.col(c).cast("date").cast("string")


# Joins ---------------------------------------------------------------------------------------------

@query("inner_ci_join", """
SELECT DISTINCT n_name, n_nationkey, s_nationkey, s_name FROM nation JOIN
  (SELECT s_name, s_nationkey, lower('NATION_' || s_nationkey) AS nname FROM supplier) s ON upper(n_name) = upper(nname)
""")
def inner_ci_join(spark, sf):
    s = table(spark, sf, "supplier").select("s_name", "s_nationkey", F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("n_name"))
    return rel.join_ignoring_case(table(spark, sf, "nation"), s, ["n_name"]).select("n_name", "n_nationkey", "s_nationkey", "s_name").distinct()


@query("left_join_unmatched", """
SELECT c_custkey, 'matched' AS outcome FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
UNION ALL
SELECT c_custkey, 'unmatched' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
""")
def left_join_unmatched(spark, sf):
    wanted = table(spark, sf, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    c = table(spark, sf, "customer").select("c_custkey")
    matched, unmatched = rel.split_matched(c, wanted, ["c_custkey"])
    return matched.withColumn("outcome", F.lit("matched")).unionByName(unmatched.withColumn("outcome", F.lit("unmatched")))


@query("full_outer_records", """
SELECT coalesce(o_orderkey, l_orderkey) AS order_key, o_orderstatus, lines, returned FROM orders FULL JOIN
  (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey FULL JOIN
  (SELECT l_orderkey AS r_key, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON coalesce(o_orderkey, l_orderkey) = r_key
""")
def full_outer_records(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), F.lit("A").alias("kind"), "o_orderstatus", F.lit(None).cast("string").alias("flag"))
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.lit("B").alias("kind"), F.lit(None).cast("string").alias("o_orderstatus"), F.col("l_returnflag").alias("flag"))
    is_line, is_returned = F.col("kind") == "B", F.col("flag") == "R"
    # One grouping over all record kinds gives what a chain of full joins would.
    return o.unionByName(l).groupBy("order_key").agg(
        F.max("o_orderstatus").alias("o_orderstatus"),
        F.nullif(F.count(F.when(is_line, 1)), F.lit(0)).alias("lines"),
        F.nullif(F.count(F.when(is_returned, 1)), F.lit(0)).alias("returned"),
    )


@query("anti_join_new", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def anti_join_new(spark, sf):
    known = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return rel.anti_join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), known, ["o_orderkey"])


@query("expression_join", """
SELECT s.c_custkey, n.n_name, r.r_name FROM customer s, nation n, region r
WHERE n.n_regionkey = r.r_regionkey AND 'STG_' || upper(r.r_name || '_' || n.n_name) = (
  SELECT 'STG_' || upper(r2.r_name || '_nation_' || s.c_nationkey) FROM nation n2, region r2
  WHERE n2.n_nationkey = s.c_nationkey AND n2.n_regionkey = r2.r_regionkey)
""")
def expression_join(spark, sf):
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = places.select("n_nationkey", F.col("r_name").alias("c_region"))
    stage = F.concat(F.lit("STG_"), F.upper(F.concat_ws("_", "c_region", F.lit("nation"), F.col("c_nationkey").cast("string"))))
    customers = table(spark, sf, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", stage.alias("stage_name"))
    name = F.concat(F.lit("STG_"), F.upper(F.concat_ws("_", "r_name", "n_name")))
    return customers.join(places, F.col("stage_name") == name).select("c_custkey", "n_name", "r_name")


# Aggregates ----------------------------------------------------------------------------------------

@query("conditional_sum", """
SELECT o_custkey, count(*) AS row_count, 0 AS flagged FROM orders GROUP BY o_custkey HAVING sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 0
""")
def conditional_sum(spark, sf):
    out = rel.keys_without(table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderstatus") == "P")
    return out.select("o_custkey", "row_count", F.col("flagged").cast("int").alias("flagged"))


@query("max_per_group", f"""
SELECT event_type, user_id, cast(max(ts) AS varchar) AS last_ts FROM events GROUP BY event_type, user_id
""")
def max_per_group(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.max("ts").cast("string").alias("last_ts"))


@query("aggregated_count", """
SELECT 'summed' AS kind, (SELECT count(*) FROM lineitem) AS row_total UNION ALL SELECT 'rows', (SELECT count(*) FROM orders)
""")
def aggregated_count(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("Row_Count"))
    summed = rel.aggregated_count(counted).withColumn("kind", F.lit("summed"))
    return summed.unionByName(rel.aggregated_count(table(spark, sf, "orders")).withColumn("kind", F.lit("rows")))


@query("ordered_listagg", """
SELECT p_type, string_agg(p_brand, ',' ORDER BY p_brand DESC) AS p_brand FROM (
  SELECT DISTINCT p_type, p_brand FROM part JOIN lineitem ON p_partkey = l_partkey) GROUP BY p_type
""")
def ordered_listagg(spark, sf):
    sold = table(spark, sf, "lineitem").select("l_partkey").distinct()
    p = table(spark, sf, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    names = rel.ordered_names(p, ["p_type"], "p_brand", ["p_brand"])
    return names.withColumn("p_brand", F.array_join(F.reverse(F.split("p_brand", ",")), ","))


@query("array_agg_struct", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
""")
def array_agg_struct(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    docs = rel.collect_records(l, ["l_orderkey"], {"lines": F.lit(True)}, ["l_linenumber", "l_partkey"], ["l_suppkey"])
    return docs.select("l_orderkey", F.inline("lines"))


@query("collect_records", """
SELECT o_orderkey AS order_key, 0 AS part_no, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS returned,
  (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag <> 'R') AS kept,
  (SELECT string_agg(l_linenumber || ':' || l_partkey, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate)
   FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS returned_parts
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def collect_records(spark, sf):
    l = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "order_key")
    returned = F.col("l_returnflag") == "R"
    docs = rel.collect_records(l, ["order_key"], {"r": returned, "k": ~returned}, ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], [])
    text = F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), " ")
    return docs.select("order_key", "part_no", F.size("r").cast("bigint").alias("returned"), F.size("k").cast("bigint").alias("kept"), F.nullif(text, F.lit("")).alias("returned_parts"))


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark, sf):
    return rel.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("group_count", "SELECT event_type, cast(cast(ts AS date) AS varchar) AS day, count(*) AS n FROM events GROUP BY 1, 2")
def group_count(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", day("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("distinct_values", """
SELECT l_suppkey, string_agg(v, ',' ORDER BY v) AS flags FROM (SELECT DISTINCT l_suppkey, l_returnflag || l_linestatus AS v FROM lineitem) GROUP BY 1
""")
def distinct_values(spark, sf):
    value = F.concat("l_returnflag", "l_linestatus")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_set(value)), ",").alias("flags"))


@query("table_profile", """
WITH p AS (
  SELECT 'orders' AS table_name, count(*) AS total_rows, 'o_orderdate' AS column_name, cast(max(o_orderdate) AS varchar) AS max_value,
    count(*) FILTER (o_orderdate >= DATE '2001-08-01' - 40) AS rows_changed FROM orders
  UNION ALL SELECT 'lineitem', count(*), 'l_shipdate', cast(max(l_shipdate) AS varchar), count(*) FILTER (l_shipdate >= DATE '2001-08-01' - 40) FROM lineitem
  UNION ALL SELECT 'events', count(*), 'ts', cast(max(ts) AS varchar), count(*) FILTER (ts >= DATE '2001-08-01' - 40) FROM events)
SELECT * FROM p
""")
def table_profile(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_loaddate", F.col("o_orderdate") - F.expr("INTERVAL 400 DAYS"))
    return rel.union_by_name(
        rel.table_profile(o, "orders", ["o_loaddate", "o_orderdate"], "2001-08-01"),
        rel.table_profile(table(spark, sf, "lineitem"), "lineitem", ["l_shipdate"], "2001-08-01"),
        rel.table_profile(table(spark, sf, "events"), "events", ["ts"], "2001-08-01"),
    )


@query("run_summary", """
SELECT user_id AS run_id, cast(round(epoch(max(ts) - min(ts)) / 60) AS bigint) AS minutes, count(DISTINCT event_type) AS tables,
  cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS kb, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS failures,
  sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)::BIGINT AS successes,
  CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
FROM events GROUP BY user_id
""")
def run_summary(spark, sf):
    failed = F.col("event_type") == "error"
    micros = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    failures = F.count(F.when(failed, 1))
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("run_id")).agg(
        F.round(micros / 60e6).cast("bigint").alias("minutes"),
        F.count_distinct("event_type").alias("tables"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("kb"),
        failures.alias("failures"),
        F.count(F.when(~failed, 1)).alias("successes"),
        F.when(failures > 0, "FAILED").otherwise("SUCCEEDED").alias("status"),
    )


# Rankings ------------------------------------------------------------------------------------------

@query("latest_full_load", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus <> 'P'
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_full_load(spark, sf):
    full = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return ranking.newest_per_group(full, ["o_custkey", "o_orderpriority"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderpriority", "o_orderkey")


@query("ordinal_position", """
SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS ordinal FROM orders
""")
def ordinal_position(spark, sf):
    # Three statuses hold all orders; ranges of keys keep every window bounded.
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.floor(F.col("o_orderkey") / 100_000).alias("key_range"))
    return ranking.row_numbers(o, ["o_orderstatus"], "key_range", ["o_orderkey"], "ordinal").drop("key_range")


@query("running_rows", """
SELECT event_type, event_id, sum(cast(round(value * 100) AS bigint)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS cents_so_far FROM events
""")
def running_rows(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    return ranking.running_total(e, ["event_type"], "day", ["ts", "event_id"], cents, "cents_so_far").select("event_type", "event_id", "cents_so_far")


@query("nth_row", """
SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 2
""")
def nth_row(spark, sf):
    return ranking.nth_per_group(table(spark, sf, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 2).select("user_id", "event_id", "event_type")


@query("priority_pick", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
  CASE WHEN o_orderpriority LIKE '3-%' THEN 0 WHEN o_orderpriority LIKE '1-URGENT' OR o_orderpriority LIKE '2-%' THEN 1 WHEN o_orderpriority LIKE '%LOW' THEN 2 ELSE 1000 END, o_orderpriority, o_orderkey) AS rn
  FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2)) WHERE rn = 1
""")
def priority_pick(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey"))
    return ranking.priority_pick(o, ["o_custkey"], F.col("o_orderpriority"), [["3-%"], ["1-URGENT", "2-%"], ["%LOW"]])


def calendar(df, column):
    """Days that occur in a table; weekends and three fixed dates are not business days."""
    at = F.col("calendar_date")
    weekend = F.weekday(at) >= 5
    holiday = F.date_format(at, "MM-dd").isin("01-01", "07-04", "12-25")
    days = df.select(F.col(column).cast("date").alias("calendar_date")).distinct()
    return days.select("calendar_date", (~weekend & ~holiday).alias("is_business_day"), weekend.alias("is_weekend"))


CALENDAR_SQL = """
SELECT DISTINCT cast({column} AS date) AS calendar_date, isodow(cast({column} AS date)) >= 6 AS is_weekend,
  isodow(cast({column} AS date)) < 6 AND strftime({column}, '%m-%d') NOT IN ('01-01', '07-04', '12-25') AS is_business_day FROM {table}
"""


@query("business_day_ordinal", f"""
WITH c AS ({CALENDAR_SQL.format(column='o_orderdate', table='orders')}),
n AS (SELECT *, count(*) OVER m AS calendar_day, CASE WHEN is_business_day THEN count(*) FILTER (is_business_day) OVER m END AS business_day
  FROM c WINDOW m AS (PARTITION BY date_trunc('month', calendar_date) ORDER BY calendar_date))
SELECT cast(calendar_date AS varchar) AS calendar_date, calendar_day, business_day, coalesce(business_day IN (5, 6), false) OR calendar_day = 7 AS is_due FROM n
""")
def business_day_ordinal(spark, sf):
    days = ranking.day_ordinals(calendar(table(spark, sf, "orders"), "o_orderdate"))
    due = ranking.is_run_day(parse_schedule("BD=[5,6],CD=[7]"))
    return days.select(F.col("calendar_date").cast("string").alias("calendar_date"), "calendar_day", "business_day", due.alias("is_due"))


@query("top_one", "SELECT event_id, event_type FROM events ORDER BY ts DESC LIMIT 1")
def top_one(spark, sf):
    return ranking.top_rows(table(spark, sf, "events"), [F.col("ts").desc()]).select("event_id", "event_type")


@query("top_one_tiebreak", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def top_one_tiebreak(spark, sf):
    return ranking.top_rows(table(spark, sf, "orders"), [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_orderkey", "o_custkey")


@query("work_order", """
SELECT o_orderkey, o_custkey, o_orderpriority, cast(o_orderdate AS varchar) AS o_orderdate FROM orders ORDER BY o_custkey DESC, o_orderpriority DESC, o_orderdate
""")
def work_order(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("string").alias("o_orderdate")).orderBy(
        F.col("o_custkey").desc(), F.col("o_orderpriority").desc(), "o_orderdate"
    )


@query("latest_per_group", """
SELECT o_orderpriority, o_orderstatus, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2
""")
def latest_per_group(spark, sf):
    return ranking.latest_by(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "o_orderkey", ["o_orderdate", "o_orderkey"])


# Sets ----------------------------------------------------------------------------------------------

@query("union_aligned", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
""")
def union_aligned(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit(1).alias("extra"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return rel.union_aligned(c, s)


@query("union_by_name", """
SELECT c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS size, c_nationkey AS nation FROM customer
UNION ALL SELECT s_name, NULL, NULL, s_nationkey FROM supplier UNION ALL SELECT p_name, NULL, p_size, NULL FROM part
""")
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    p = table(spark, sf, "part").select(F.col("p_size").cast("bigint").alias("size"), F.col("p_name").alias("name"))
    return rel.union_by_name(c, s, p)


@query("except_all_keys", """
(SELECT l_orderkey AS order_key, 'multiset' AS kind FROM lineitem EXCEPT ALL SELECT o_orderkey, 'multiset' FROM orders)
UNION ALL SELECT l_orderkey, 'set' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def except_all_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderstatus")
    multi = rel.keys_not_in(lines, orders, ["order_key"], multiset=True).withColumn("kind", F.lit("multiset"))
    single = rel.keys_not_in(lines, orders.where("o_orderstatus <> 'P'"), ["order_key"]).withColumn("kind", F.lit("set"))
    return multi.unionByName(single)


@query("array_set_ops", """
SELECT l_suppkey, string_agg(v, ',' ORDER BY v) FILTER (kind = 'O' AND v NOT IN (SELECT l_returnflag FROM lineitem x WHERE x.l_suppkey = s.l_suppkey AND x.l_linestatus = 'F')) AS only_open,
  count(*) AS joined_size FROM (SELECT DISTINCT l_suppkey, l_linestatus AS kind, l_returnflag AS v FROM lineitem) s GROUP BY l_suppkey
""")
def array_set_ops(spark, sf):
    flags = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.collect_set(F.when(F.col("l_linestatus") == "O", F.col("l_returnflag"))).alias("open"),
        F.collect_set(F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))).alias("done"),
    )
    only = F.array_join(F.sort_array(F.array_except("open", "done")), ",")
    return flags.select("l_suppkey", F.nullif(only, F.lit("")).alias("only_open"), F.size(F.concat("open", "done")).cast("bigint").alias("joined_size"))


@query("array_functions", """
SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS first, len(embedding) AS size, len(list_filter(embedding, lambda x: x > 0)) AS positive,
  round(list_filter(embedding, lambda x: x > 0.2::FLOAT)[1]::DOUBLE, 6) AS first_large FROM embeddings
""")
def array_functions(spark, sf):
    v = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.round(F.get(v, 0).cast("double"), 6).alias("first"),
        F.size(v).cast("bigint").alias("size"),
        F.size(F.filter(v, lambda x: x > 0)).cast("bigint").alias("positive"),
        F.round(F.get(F.filter(v, lambda x: x > F.lit(0.2).cast("float")), 0).cast("double"), 6).alias("first_large"),
    )
