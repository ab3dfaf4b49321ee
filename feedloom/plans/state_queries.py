"""Table state over the shared tables: orders, customers and events play targets and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.keys import with_content_hash, with_row_key
from feedloom.operators import ledger, state
from feedloom.operators.columns import with_history_meta
from feedloom.operators.relational import union_by_name
from feedloom.plans.registry import query, table
from feedloom.session import scratch_path
from feedloom.sources import coerce
from feedloom.sources.coerce import load_with_rejects
from feedloom.sources.lake import write_bucketed
from feedloom.types import ACTION, CONTENT_HASH, INTEGRATION_ID

DATA = ["custkey", "status", "price", "priority"]


def money(c):
    return F.col(c).cast("decimal(18,2)").cast("string") if isinstance(c, str) else c.cast("decimal(18,2)").cast("string")


def order_rows(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias(INTEGRATION_ID),
        F.col("o_custkey").cast("string").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("price"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.year("o_orderdate").alias("year"),
    )


def order_target(spark, sf):
    """Orders up to 1999; pending ones were deleted."""
    t = with_content_hash(order_rows(spark, sf).where("year < 2000"), DATA)
    return t.withColumns(
        {"elt_execution_date": F.lit("2024-01-01"), "elt_load_type": F.lit("FULL"), "elt_delete_ind": F.when(F.col("status") == "P", 1).otherwise(0)}
    ).drop("year")


def order_changes(spark, sf, load_type="INCREMENTAL"):
    """Orders from 1998 on, twice: an early copy, and the present one with dearer urgent orders.

    Some have no key, some are deletions.
    """
    o = order_rows(spark, sf).where("year >= 1998")
    early = o.withColumns({"price": F.lit("1.00"), "elt_execution_date": F.lit("2024-01-02")})
    dearer = (F.col("price").cast("decimal(18,2)") + 10).cast("decimal(18,2)").cast("string")
    late = o.withColumns(
        {"price": F.when(F.col("priority") == "1-URGENT", dearer).otherwise(F.col("price")), "elt_execution_date": F.lit("2024-01-03")}
    )
    both = early.unionByName(late).withColumns(
        {
            INTEGRATION_ID: F.when((F.col("year") == 2001) & (F.col("priority") == "4-NOT SPECIFIED"), F.lit(None)).otherwise(F.col(INTEGRATION_ID)),
            ACTION: F.when((F.col("year") == 2000) & (F.col("priority") == "3-MEDIUM"), "DELETE").otherwise("INSERT"),
            "elt_load_type": F.lit(load_type),
            "elt_delete_ind": F.lit(0),
        }
    )
    return with_content_hash(both, DATA).drop("year")


ORDERS_SQL = """
o AS (SELECT cast(o_orderkey AS varchar) AS id, cast(o_custkey AS varchar) AS custkey, o_orderstatus AS status,
  cast(cast(o_totalprice AS decimal(18,2)) AS varchar) AS price, nullif(o_orderpriority, '5-LOW') AS priority, year(o_orderdate) AS y FROM orders),
target AS (SELECT *, sha256(concat_ws(chr(31), custkey, status, price, coalesce(priority, 'N/A'))) AS h, '2024-01-01' AS exec,
  CASE WHEN status = 'P' THEN 1 ELSE 0 END AS del FROM o WHERE y < 2000),
late AS (SELECT * REPLACE (CASE WHEN priority = '1-URGENT' THEN cast(cast(price AS decimal(18,2)) + 10 AS varchar) ELSE price END AS price) FROM o WHERE y >= 1998
  AND NOT (y = 2001 AND coalesce(priority, '') = '4-NOT SPECIFIED') AND NOT (y = 2000 AND coalesce(priority, '') = '3-MEDIUM')),
changes AS (SELECT *, sha256(concat_ws(chr(31), custkey, status, price, coalesce(priority, 'N/A'))) AS h, '2024-01-03' AS exec, 0 AS del FROM late),
merged AS (
  SELECT t.id, CASE WHEN c.h <> t.h OR t.del = 1 THEN c.custkey ELSE t.custkey END AS custkey, CASE WHEN c.h <> t.h OR t.del = 1 THEN c.status ELSE t.status END AS status,
    CASE WHEN c.h <> t.h OR t.del = 1 THEN c.price ELSE t.price END AS price, CASE WHEN c.h <> t.h OR t.del = 1 THEN coalesce(c.priority, '') ELSE t.priority END AS priority,
    CASE WHEN c.h <> t.h OR t.del = 1 THEN c.h ELSE t.h END AS h, CASE WHEN c.h <> t.h OR t.del = 1 THEN c.exec ELSE t.exec END AS exec,
    CASE WHEN c.h <> t.h OR t.del = 1 THEN 0 ELSE t.del END AS del
  FROM target t JOIN changes c USING (id)
  UNION ALL SELECT id, custkey, status, price, priority, h, exec, del FROM target WHERE id NOT IN (SELECT id FROM changes)
  UNION ALL SELECT id, custkey, status, price, coalesce(priority, ''), h, exec, del FROM changes WHERE id NOT IN (SELECT id FROM target))
"""

# Applied as two batches every changed row is touched twice: the early copy differs, the late one differs from it.
STANDING_SQL = ORDERS_SQL.rstrip() + """,
standing AS (
  SELECT id, custkey, status, price, priority, h, exec, del FROM target WHERE id NOT IN (SELECT id FROM changes)
  UNION ALL SELECT id, custkey, status, price, coalesce(priority, ''), h, exec, del FROM changes)
"""


@query("upsert_hash", f"""
WITH {ORDERS_SQL} SELECT id AS elt_integration_id, custkey, status, price, priority, h AS elt_columns_hash, exec AS elt_execution_date, del AS elt_delete_ind FROM merged
""")
def upsert_hash(spark, sf):
    return state.upsert(order_target(spark, sf), order_changes(spark, sf)).drop("elt_load_type")


@query("upsert_bucketed", f"""
WITH {ORDERS_SQL} SELECT id AS elt_integration_id, custkey, status, price, priority, h AS elt_columns_hash, exec AS elt_execution_date, del AS elt_delete_ind FROM merged
""")
def upsert_bucketed(spark, sf):
    """The same upsert on a target that is bucketed by its key."""
    path = scratch_path(spark, "orders_bucketed")
    target = write_bucketed(order_target(spark, sf), path.rsplit("/", 1)[1].replace("-", "_"), path, INTEGRATION_ID, 16)
    return state.upsert(target, order_changes(spark, sf), keys_are_clean=True).drop("elt_load_type")


@query("dedupe_changes", f"""
WITH {ORDERS_SQL}
SELECT id AS elt_integration_id, CASE WHEN y = 2000 AND priority = '3-MEDIUM' THEN 'DELETE' ELSE 'INSERT' END AS elt_stream_action, '2024-01-03' AS elt_execution_date,
  CASE WHEN priority = '1-URGENT' THEN cast(cast(price AS decimal(18,2)) + 10 AS varchar) ELSE price END AS price
FROM o WHERE y >= 1998 AND NOT (y = 2001 AND coalesce(priority, '') = '4-NOT SPECIFIED')
UNION ALL SELECT NULL, 'INSERT', '2024-01-03', arg_max(price, sha256(concat_ws(chr(31), custkey, status, price, priority))) FROM o WHERE y = 2001 AND priority = '4-NOT SPECIFIED' HAVING count(*) > 0
""")
def dedupe_changes(spark, sf):
    """Inserts, deletes and, as one key, the changes without a key."""
    newest = state.dedupe_changes(order_changes(spark, sf), INTEGRATION_ID)
    return newest.select(INTEGRATION_ID, ACTION, "elt_execution_date", "price")


@query("soft_delete", f"""
WITH {ORDERS_SQL} SELECT id AS elt_integration_id, 'guarded' AS kind, del AS elt_delete_ind FROM target
UNION ALL SELECT id, 'full', CASE WHEN id NOT IN (SELECT id FROM changes) AND (id NOT IN (SELECT id FROM o WHERE y = 2000 AND priority = '3-MEDIUM')) THEN 1 ELSE del END FROM target
""")
def soft_delete(spark, sf):
    t = order_target(spark, sf)
    incremental = state.soft_delete(t, order_changes(spark, sf), INTEGRATION_ID).withColumn("kind", F.lit("guarded"))
    full = state.soft_delete(t, order_changes(spark, sf, "FULL"), INTEGRATION_ID).withColumn("kind", F.lit("full"))
    return incremental.unionByName(full).select(INTEGRATION_ID, "kind", "elt_delete_ind")


@query("fold_changes", f"""
WITH {STANDING_SQL} SELECT id AS elt_integration_id, status, price, exec AS elt_execution_date, del AS elt_delete_ind FROM standing
""")
def fold_changes(spark, sf):
    """The changes as a log of two batches, folded into one: the same as applying one after the other."""
    c = order_changes(spark, sf)
    log = c.withColumn("batch_no", F.when(F.col("elt_execution_date") == "2024-01-02", 0).otherwise(1))
    current = state.upsert(order_target(spark, sf), state.fold_changes(log))
    return current.select(INTEGRATION_ID, "status", "price", "elt_execution_date", "elt_delete_ind")


# History -------------------------------------------------------------------------------------------

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def customer_history(spark, sf):
    """All customers current since 2023; those in debt also have a closed earlier row under another segment."""
    c = table(spark, sf, "customer")
    now = with_history_meta(c.select(*CUSTOMER), "old", True, "2023-06-01", "2023-05-31", "2023-06-01")
    debt = c.where("c_acctbal < 0").withColumn("c_mktsegment", F.lit("UNKNOWN")).select(*CUSTOMER)
    past = with_history_meta(debt, "older", True, "2022-06-01", "2022-05-31", "2022-06-01")
    return now.unionByName(past.withColumns({"meta_is_current": F.lit(0), "meta_end_date": F.lit("2023-06-01")}))


def customer_batch(spark, sf, full):
    """Builders became constructors, customers in debt left; one row per customer comes with two dates."""
    c = table(spark, sf, "customer").where("c_acctbal >= 0")
    renamed = c.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("c_mktsegment")))
    days = F.explode(F.array(F.lit("2024-01-30"), F.lit("2024-01-31")))
    rows = renamed.select(*CUSTOMER)
    return with_history_meta(rows, "new", full, "2024-02-01", F.lit("x"), "2024-02-01").withColumn("meta_date_of_data", days)


HISTORY_SQL = """
WITH c AS (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS seg2 FROM customer),
rows_ AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal >= 0 AND c_mktsegment <> 'BUILDING' AS hit FROM c),
out_ AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CASE WHEN hit THEN 'new' ELSE 'old' END AS meta_pipeline_key, CASE WHEN hit THEN {full} ELSE 1 END AS meta_is_full_load,
    CASE WHEN hit THEN '2024-02-01' ELSE '2023-06-01' END AS meta_run_date, CASE WHEN hit THEN '2024-01-31' ELSE '2023-05-31' END AS meta_date_of_data, '2023-06-01' AS meta_start_date,
    CASE WHEN hit OR {full} = 0 THEN '9999-12-31' ELSE '2024-02-01' END AS meta_end_date, CASE WHEN hit OR {full} = 0 THEN 1 ELSE 0 END AS meta_is_current FROM rows_
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'UNKNOWN', 'older', 1, '2022-06-01', '2022-05-31', '2022-06-01', '2023-06-01', 0 FROM c WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'CONSTRUCTION', 'new', {full}, '2024-02-01', '2024-01-31', '2024-02-01', '9999-12-31', 1 FROM c WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING')
SELECT *, sha256(concat_ws(',', cast(c_custkey AS varchar), c_name, cast(c_nationkey AS varchar), c_mktsegment)) AS meta_hash_key FROM out_
"""


@query("scd2_full", HISTORY_SQL.format(full=1))
def scd2_full(spark, sf):
    return state.scd2_merge(customer_history(spark, sf), customer_batch(spark, sf, True), "2024-02-01", full=True)


@query("scd2_incremental", HISTORY_SQL.format(full=0))
def scd2_incremental(spark, sf):
    return state.scd2_merge(customer_history(spark, sf), customer_batch(spark, sf, False), "2024-02-01", full=False)


@query("purge_history", """
SELECT c_custkey, c_mktsegment, meta_start_date FROM (
  SELECT c_custkey, c_mktsegment, '2023-06-01' AS meta_start_date FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
  UNION ALL SELECT c_custkey, 'CONSTRUCTION', '2024-02-01' FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING')
""")
def purge_history(spark, sf):
    merged = state.scd2_merge(customer_history(spark, sf), customer_batch(spark, sf, True), "2024-02-01", full=True)
    return state.purge_history(merged).select("c_custkey", "c_mktsegment", "meta_start_date")


@query("mirror_merge", """
WITH s AS (SELECT CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_name END AS k, c_nationkey + 1 AS n FROM customer WHERE c_acctbal >= 0),
t AS (SELECT CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN NULL ELSE c_name END AS k, c_nationkey AS n FROM customer WHERE c_acctbal < 5000)
SELECT s.k AS name, s.n AS nation, CASE WHEN t.k IS NULL THEN 'insert' ELSE 'update' END AS change FROM s LEFT JOIN t ON s.k = t.k WHERE s.k IS NOT NULL
UNION ALL SELECT k, n, 'delete' FROM t WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM s WHERE k IS NOT NULL)
UNION ALL SELECT k, n, CASE WHEN (SELECT count(*) FROM s WHERE k IS NULL) > 0 THEN 'keep' ELSE 'delete' END FROM t WHERE k IS NULL
""")
def mirror_merge(spark, sf):
    c = table(spark, sf, "customer")
    padded = F.concat(F.lit(" "), "c_name", F.lit("  "))
    source = c.where("c_acctbal >= 0").select(F.when(F.col("c_mktsegment") != "FURNITURE", padded).alias("name"), (F.col("c_nationkey") + 1).alias("nation"))
    gone = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)
    target = c.where("c_acctbal < 5000").select(F.when(~gone, F.col("c_name")).alias("name"), F.col("c_nationkey").alias("nation"))
    return state.mirror_merge(target, source, ["name"]).withColumn("name", F.trim("name"))


@query("insert_only_retention", """
SELECT event_id, event_type, cast(ts AS varchar) AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-26 00:00:00'
""")
def insert_only_retention(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    old = e.where(F.col("ts") < F.lit("2024-01-28").cast("timestamp"))
    batch = e.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    merged = state.insert_only_merge(old, batch.unionByName(batch), "event_id", "ts", "2024-01-26 00:00:00")
    return merged.select("event_id", "event_type", F.col("ts").cast("string").alias("ts"))


@query("keep_latest_batches", """
SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, year(l_shipdate) AS batch_no FROM lineitem
QUALIFY rank() OVER (PARTITION BY l_partkey ORDER BY year(l_shipdate) DESC) = 1
""")
def keep_latest_batches(spark, sf):
    l = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", F.year("l_shipdate").alias("batch_no"))
    return state.keep_latest_batches(l, ["l_partkey"])


@query("schema_evolution", """
SELECT c_custkey, c_name, c_nationkey, NULL AS region, 'region' AS added FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, r_name, 'region' FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def schema_evolution(spark, sf):
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    incoming = table(spark, sf, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("C_CUSTKEY"), F.col("s_name").alias("C_Name"), F.col("r_name").alias("region")
    )
    wide, shaped, added = state.align_schema(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), incoming)
    return wide.unionByName(shaped).withColumn("added", F.lit(",".join(added)))


@query("config_history", """
SELECT s_suppkey, s_name, s_nationkey, 'current' AS kind FROM (SELECT * REPLACE (CASE WHEN s_acctbal < 0 THEN 'CLOSED' ELSE s_name END AS s_name) FROM supplier)
UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'history' FROM supplier WHERE s_acctbal < 0
""")
def config_history(spark, sf):
    s = table(spark, sf, "supplier")
    after, before = state.replace_rows(s, F.col("s_acctbal") < 0, {"s_name": F.lit("CLOSED")})
    return after.withColumn("kind", F.lit("current")).unionByName(before.withColumn("kind", F.lit("history"))).drop("s_acctbal")


# Loading -------------------------------------------------------------------------------------------

@query("bronze_append", """
SELECT l_orderkey, l_linenumber, l_partkey, sha256(concat_ws('_', cast(l_orderkey AS varchar), cast(l_linenumber AS varchar))) AS elt_key_hash,
  sha256(concat_ws(chr(31), cast(l_partkey AS varchar), l_returnflag)) AS elt_columns_hash, 'run_R' AS elt_run_id, 'lineitem' AS elt_table FROM lineitem WHERE l_returnflag = 'R'
""")
def bronze_append(spark, sf):
    stage = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.concat(F.lit("run_"), "l_returnflag").alias("run_id"))
    return state.bronze_rows(stage, ["l_orderkey", "l_linenumber"], "run_R", {"elt_table": "lineitem"}).drop("l_returnflag")


REJECT_SQL = """
WITH raw AS (SELECT cast(l_orderkey AS varchar) AS file_key, CASE WHEN l_quantity > 45 THEN 'many' ELSE cast(cast(l_quantity AS bigint) AS varchar) END AS quantity,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '2001-13-01' ELSE cast(cast(l_shipdate AS date) AS varchar) END AS shipdate FROM lineitem)
"""


def raw_lines(spark, sf):
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_key"),
        F.when(F.col("l_quantity") > 45, "many").otherwise(quantity).alias("quantity"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), "2001-13-01").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("shipdate"),
    )


@query("load_with_rejects", REJECT_SQL + """
SELECT file_key, quantity, shipdate, 'good' AS outcome, NULL AS column_name, NULL AS column_text FROM raw WHERE quantity <> 'many' AND shipdate <> '2001-13-01'
UNION ALL SELECT file_key, NULL, NULL, 'not a ' || CASE WHEN quantity = 'many' THEN 'int' ELSE 'date' END, CASE WHEN quantity = 'many' THEN 'quantity' ELSE 'shipdate' END,
  CASE WHEN quantity = 'many' THEN quantity ELSE shipdate END FROM raw WHERE quantity = 'many' OR shipdate = '2001-13-01'
""")
def load_with_rejects_query(spark, sf):
    good, bad = load_with_rejects(raw_lines(spark, sf), {"quantity": "int", "shipdate": "date"})
    good = good.select("file_key", F.col("quantity").cast("string").alias("quantity"), F.col("shipdate").cast("string").alias("shipdate"), F.lit("good").alias("outcome"))
    return union_by_name(good, bad.select("file_key", F.col("error").alias("outcome"), "column_name", "column_text"))


@query("stage_load", REJECT_SQL + """
SELECT 'whole' AS request, 'loaded' AS status, count(*) FILTER (quantity <> 'many' AND shipdate <> '2001-13-01') AS rows_loaded, count(*) FILTER (quantity = 'many' OR shipdate = '2001-13-01') AS rows_rejected,
  count(*) FILTER (quantity <> 'many' AND shipdate <> '2001-13-01') AS rows_staged FROM raw
UNION ALL SELECT 'wrong', 'failed', NULL, NULL, count(*) FILTER (quantity <> 'many' AND shipdate <> '2001-13-01') FROM raw
""")
def stage_load(spark, sf):
    """One request replaces staging by its good rows; the next one lacks a column, fails and leaves staging alone."""
    path, raw = scratch_path(spark, "stage"), raw_lines(spark, sf)
    first = coerce.stage_load(raw, {"quantity": "int", "shipdate": "date"}, path, "whole")
    second = coerce.stage_load(raw.drop("shipdate"), {"quantity": "int", "shipdate": "date"}, path, "wrong")
    staged = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    return first.unionByName(second).drop("message").withColumn("rows_staged", staged.scalar())


# Files and windows ---------------------------------------------------------------------------------

def order_files(spark, sf):
    """One file per priority and day; pending orders make a file a full load."""
    return table(spark, sf, "orders").groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.max(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("is_full"), F.count(F.lit(1)).alias("n")
    ).select(
        F.col("o_orderpriority").alias("table_name"),
        F.concat_ws("/", F.lit("in"), "o_orderpriority", F.col("day").cast("string")).alias("file_path"),
        F.concat(F.lit("zip/"), F.date_format("day", "yyyy-MM")).alias("zip_file_path"),
        (F.col("is_full") == 1).alias("is_full_load"),
        F.col("day"),
        F.col("n"),
    )


FILES_SQL = """
f AS (SELECT o_orderpriority AS table_name, 'in/' || o_orderpriority || '/' || cast(o_orderdate AS date) AS file_path, 'zip/' || strftime(o_orderdate, '%Y-%m') AS zip_file_path,
  max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 1 AS is_full_load, cast(o_orderdate AS date) AS day, count(*) AS n FROM orders GROUP BY ALL)
"""
FILES_SQL = FILES_SQL.replace("GROUP BY ALL", "GROUP BY o_orderpriority, o_orderdate")


@query("ledger_select", f"""
WITH {FILES_SQL} SELECT table_name, file_path, 'by key' AS how FROM f WHERE day >= DATE '2000-01-01' OR is_full_load
UNION ALL SELECT table_name, file_path, 'by path' FROM f WHERE day >= DATE '2000-01-01' OR is_full_load
""")
def ledger_select(spark, sf):
    files = order_files(spark, sf)
    known = files.where("day < DATE '2000-01-01'").select(
        "table_name", "file_path", "zip_file_path", F.when(F.col("is_full_load"), 1).otherwise(0).alias("reingest_file"), F.lit(0).alias("zip_file_fully_ingested")
    )
    by_key = ledger.unseen_files(files, known, ["table_name", "file_path"]).withColumn("how", F.lit("by key"))
    by_path = ledger.unseen_paths(files, known).withColumn("how", F.lit("by path"))
    return by_key.unionByName(by_path).select("table_name", "file_path", "how")


@query("ledger_append", f"""
WITH {FILES_SQL} SELECT file_path, 0 AS reingest_file, CASE WHEN zip_file_path = 'zip/1999-03' THEN 1 ELSE 0 END AS zip_done FROM f WHERE day < DATE '2000-01-01'
UNION ALL SELECT file_path, 0, CASE WHEN zip_file_path = 'zip/1999-03' THEN 1 ELSE 0 END FROM f WHERE day >= DATE '2000-01-01' OR is_full_load
""")
def ledger_append(spark, sf):
    files = order_files(spark, sf)
    known = files.where("day < DATE '2000-01-01'").select(
        "table_name", "file_path", "zip_file_path", F.when(F.col("is_full_load"), 1).otherwise(0).alias("reingest_file"), F.lit(0).alias("zip_file_fully_ingested")
    )
    todo = ledger.unseen_files(files, known, ["table_name", "file_path"]).select("table_name", "file_path", "zip_file_path", F.lit(0).alias("zip_file_fully_ingested"))
    done = ledger.complete_archive(ledger.record_loaded(known, todo, ["table_name", "file_path"]), F.lit("zip/1999-03"))
    return done.select("file_path", "reingest_file", F.col("zip_file_fully_ingested").alias("zip_done"))


@query("file_selection", f"""
WITH {FILES_SQL},
a AS (SELECT f.*, day < DATE '1996-01-01' AS is_old, m.full_day FROM f LEFT JOIN (SELECT table_name, max(day) AS full_day FROM f WHERE is_full_load GROUP BY 1) m USING (table_name))
SELECT table_name, file_path, is_full_load, coalesce(day >= full_day, true) AS is_ingested, cast(full_day AS varchar) AS full_load_date FROM a WHERE NOT is_old
""")
def file_selection(spark, sf):
    files = order_files(spark, sf).select(
        "table_name", "file_path", "is_full_load", "day", F.lit(True).alias("is_ingested"),
        F.lit(None).cast("date").alias("full_load_date"), F.md5("file_path").alias("md5_key"),
    )
    blank = F.lit(None).cast("timestamp").alias("ingestion_date")
    history = files.where("day < DATE '1996-01-01'").withColumn("ingestion_date", F.col("day").cast("timestamp"))
    new, _ = ledger.select_files(files.select("*", blank), history, ["table_name"], "md5_key", "day", "2024-01-01")
    return new.select("table_name", "file_path", "is_full_load", "is_ingested", F.col("full_load_date").cast("string").alias("full_load_date"))


@query("file_work_list", f"""
WITH {FILES_SQL},
a AS (SELECT f.*, m.full_day FROM f LEFT JOIN (SELECT table_name, max(day) AS full_day FROM f WHERE is_full_load GROUP BY 1) m USING (table_name))
SELECT table_name, file_path FROM a WHERE day >= DATE '1996-01-01' AND coalesce(day >= full_day, true)
""")
def file_work_list(spark, sf):
    files = order_files(spark, sf).select(
        "table_name", "file_path", "is_full_load", "day", F.lit(True).alias("is_ingested"),
        F.lit(None).cast("date").alias("full_load_date"), F.md5("file_path").alias("md5_key"), F.lit(None).cast("timestamp").alias("ingestion_date"),
    )
    history = files.where("day < DATE '1996-01-01'").withColumn("ingestion_date", F.col("day").cast("timestamp"))
    _, work = ledger.select_files(files, history, ["table_name"], "md5_key", "day", "2024-01-01")
    return work.select("table_name", "file_path")


def order_windows(spark, sf):
    """One window per priority and year; years before 1998 are loaded."""
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("table_name"), F.year("o_orderdate").alias("y")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("start_date"), F.max(F.col("o_orderdate").cast("date")).alias("end_date")
    ).select("table_name", "start_date", "end_date", F.when(F.col("y") < 1998, ledger.COMPLETE).otherwise(ledger.NOT_YET_LOADED).alias("status"))


@query("backfill_windows", "SELECT o_orderkey, o_orderpriority FROM orders WHERE year(o_orderdate) = 1998")
def backfill_windows(spark, sf):
    chosen = ledger.next_windows(order_windows(spark, sf))
    rows = ledger.rows_in_windows(table(spark, sf, "orders"), F.col("o_orderpriority"), F.col("o_orderdate").cast("date"), chosen)
    return rows.select("o_orderkey", "o_orderpriority")


@query("window_rows", """
WITH w AS (
  SELECT o_orderpriority AS t, year(o_orderdate) AS y, min(cast(o_orderdate AS date)) AS a, max(cast(o_orderdate AS date)) + 45 AS z FROM orders GROUP BY 1, 2
), open AS (SELECT t, y, CASE WHEN y > 1993 THEN a END AS a, CASE WHEN y < 1997 THEN z END AS z FROM w)
SELECT o_orderkey, o_orderpriority FROM orders JOIN open ON o_orderpriority = t AND (a IS NULL OR cast(o_orderdate AS date) >= a) AND (z IS NULL OR cast(o_orderdate AS date) <= z)
""")
def window_rows(spark, sf):
    """Orders in windows of a year that overlap by 45 days; the first ones have no start, the last ones no end."""
    year = F.year("start_date")
    windows = order_windows(spark, sf).select(
        "table_name", F.when(year > 1993, F.col("start_date")).alias("start_date"), F.when(year < 1997, F.date_add("end_date", 45)).alias("end_date")
    )
    rows = ledger.rows_in_windows(table(spark, sf, "orders"), F.col("o_orderpriority"), F.col("o_orderdate").cast("date"), windows)
    return rows.select("o_orderkey", "o_orderpriority")


@query("backfill_states", """
SELECT o_orderpriority AS table_name, cast(min(cast(o_orderdate AS date)) AS varchar) AS start_date,
  CASE WHEN year(o_orderdate) < 1998 THEN 'COMPLETE' WHEN year(o_orderdate) = 1998 THEN 'IN_PROGRESS' ELSE 'NOT_YET_LOADED' END AS status FROM orders GROUP BY o_orderpriority, year(o_orderdate)
""")
def backfill_states(spark, sf):
    windows = order_windows(spark, sf)
    marked = ledger.mark_windows(windows, ledger.next_windows(windows), ledger.IN_PROGRESS)
    return marked.select("table_name", F.col("start_date").cast("string").alias("start_date"), "status")


@query("change_view", """
SELECT sha256(cast(o_orderkey AS varchar) || '_shop') AS elt_integration_id, sha256(concat_ws(chr(31), cast(o_orderkey AS varchar), o_orderstatus)) AS elt_columns_hash, o_orderkey FROM orders
""")
def change_view(spark, sf):
    batch = with_row_key(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "shop").withColumn("elt_execution_date", F.lit("2024-01-01"))
    return state.change_view(batch.unionByName(batch)).select(INTEGRATION_ID, CONTENT_HASH, "o_orderkey")
