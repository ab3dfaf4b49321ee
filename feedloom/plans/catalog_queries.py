"""The catalog, from information-schema rows that are measured on the shared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from feedloom.operators import catalog
from feedloom.operators.relational import union_by_name
from feedloom.plans.registry import query, table
from feedloom.session import written

# Columns of the shared tables that the catalog queries describe: (name, information-schema type).
TABLES = {
    "customer": [("c_custkey", "bigint"), ("c_name", "varchar"), ("c_nationkey", "int"), ("c_acctbal", "float"), ("c_mktsegment", "varchar")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "varchar"), ("o_totalprice", "float"), ("o_orderdate", "datetime"), ("o_orderpriority", "varchar")],
    "part": [("p_partkey", "bigint"), ("p_name", "varchar"), ("p_brand", "varchar"), ("p_type", "varchar"), ("p_size", "int"), ("p_retailprice", "float")],
    "events": [("event_id", "bigint"), ("ts", "datetime"), ("user_id", "bigint"), ("event_type", "varchar"), ("value", "float"), ("props", "varchar")],
}


def measured_sql(tables=TABLES):
    parts = []
    for name, columns in tables.items():
        for i, (c, kind) in enumerate(columns, 1):
            length = f"max(length({c}))" if kind == "varchar" else "0"
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, cast({length} AS int) AS len, {i} AS ord, "
                f"CASE WHEN count({c}) < count(*) THEN 'YES' ELSE 'NO' END AS is_nullable, count(*) AS table_rows FROM {name}"
            )
    return "cols AS (" + " UNION ALL ".join(parts) + ")"


def measured(spark, sf, tables=TABLES):
    """Measured once and kept as a small table, since the catalog joins it many times."""
    return written(reduce(lambda a, b: a.unionByName(b), [catalog.profile_columns(table(spark, sf, t), t) for t in tables]), "columns")


def table_rows(columns):
    """Information-schema rows of the tables themselves."""
    kind = F.when(F.col("table_name") == "events", "VIEW").otherwise("BASE TABLE")
    return columns.select(*catalog.TABLE).distinct().select("*", kind.alias("table_type"))


def ingest_list(columns):
    """All tables in another spelling, and one that does not exist."""
    names = columns.select(F.upper("table_name").alias("table_name"), F.lit("DBO").alias("table_schema")).distinct()
    return written(names.unionByName(names.where("table_name = 'PART'").withColumn("table_name", F.lit("NOT_THERE"))), "ingest-list")


def declared_keys(columns):
    """Key lists as they are kept: one text per table, comma separated; part has none."""
    first = columns.where("ordinal_position <= 2 AND table_name <> 'part'").groupBy("table_name").agg(
        F.concat_ws(" , ", F.max(F.when(F.col("ordinal_position") == 1, F.upper("column_name"))), F.max(F.when((F.col("ordinal_position") == 2) & (F.col("table_name") == "orders"), F.col("column_name")))).alias("key_list")
    )
    return first.select(F.lit("dbo").alias("asset_schema"), F.col("table_name").alias("asset_name"), "key_list")


KEY_SQL = "keyed AS (SELECT *, (ord = 1 AND table_name <> 'part') OR (ord = 2 AND table_name = 'orders') AS is_key FROM cols)"
TARGET_SQL = "CASE data_type WHEN 'varchar' THEN 'varchar(' || len || ')' WHEN 'char' THEN 'varchar' ELSE data_type END"


@query("column_profile", f"WITH {measured_sql()} SELECT table_name, column_name, data_type, len AS character_maximum_length, ord AS ordinal_position, is_nullable, table_rows FROM cols")
def column_profile(spark, sf):
    return measured(spark, sf).drop("table_catalog", "table_schema")


@query("catalog_build", f"""
WITH {measured_sql()}, {KEY_SQL}
SELECT 'feeds' AS source_database, 'dbo' AS source_schema, table_name, column_name AS source_column, data_type AS source_type, column_name AS target_column, {TARGET_SQL} AS target_type,
  ord AS ordinal_position, CASE WHEN is_nullable = 'YES' THEN 1 ELSE 0 END AS is_nullable, CASE WHEN is_key THEN 1 ELSE 0 END AS key_indicator, 1 AS is_active FROM keyed WHERE table_name <> 'events'
UNION ALL SELECT 'feeds', 'dbo', 'part', 'MD5_KEY', 'char', 'MD5_KEY', 'varchar', 7, 1, 1, 1
""")
def catalog_build(spark, sf):
    columns = measured(spark, sf)
    keys = catalog.key_columns(declared_keys(columns))
    forward = catalog.translation_table(spark).where("direction = 'forward'")
    return catalog.build_catalog(ingest_list(columns), table_rows(columns), columns.drop("table_rows"), keys, forward)


@query("catalog_unlisted", "SELECT 'NOT_THERE' AS table_name, 'DBO' AS table_schema UNION ALL SELECT 'EVENTS', 'DBO'")
def catalog_unlisted(spark, sf):
    columns = measured(spark, sf)
    return catalog.unlisted_tables(ingest_list(columns), table_rows(columns))


@query("catalog_constraints", f"""
WITH {measured_sql()}, {KEY_SQL} SELECT table_name, column_name, CASE WHEN is_key THEN column_name END AS key_column_name FROM keyed
""")
def catalog_constraints(spark, sf):
    """Keys from the constraints of the source and their columns."""
    columns = measured(spark, sf)
    name = F.concat(F.lit("PK_"), "table_name").alias("constraint_name")
    constraints = columns.select(*catalog.TABLE, name, F.lit("primary key").alias("constraint_type")).distinct()
    is_key = ((F.col("ordinal_position") == 1) & (F.col("table_name") != "part")) | ((F.col("ordinal_position") == 2) & (F.col("table_name") == "orders"))
    usage = columns.where(is_key).select(*[F.upper(c).alias(c) for c in catalog.TABLE], F.upper("column_name").alias("column_name"), name)
    return catalog.mark_keys(columns, catalog.primary_keys(constraints, usage)).select("table_name", "column_name", "key_column_name")


@query("catalog_key_inference", f"""
WITH {measured_sql()}, {KEY_SQL} SELECT table_name, column_name, CASE WHEN is_key THEN column_name END AS key_column_name, ord AS ordinal_position FROM keyed
UNION ALL SELECT 'part', 'MD5_KEY', 'MD5_KEY', 7
""")
def catalog_key_inference(spark, sf):
    columns = measured(spark, sf)
    marked = catalog.mark_keys(columns, catalog.key_columns(declared_keys(columns)))
    return catalog.infer_missing_keys(marked).select("table_name", "column_name", "key_column_name", "ordinal_position")


@query("key_list_explode", """
SELECT DISTINCT upper(p_brand) AS table_schema, upper(p_type) AS table_name, upper(trim(k)) AS column_name FROM (
  SELECT p_brand, p_type, unnest(string_split(replace(p_name, ' ', ' , ') || ',' || p_size || ',, ', ',')) AS k FROM part) WHERE trim(k) <> ''
""")
def key_list_explode(spark, sf):
    text = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ")), F.lit(","), F.col("p_size").cast("string"), F.lit(",, "))
    declared = table(spark, sf, "part").select(F.col("p_brand").alias("asset_schema"), F.col("p_type").alias("asset_name"), text.alias("key_list"))
    return catalog.key_columns(declared)


@query("type_translation", f"WITH {measured_sql()} SELECT table_name, column_name, {TARGET_SQL} AS target_type FROM cols")
def type_translation(spark, sf):
    forward = catalog.translation_table(spark).where("direction = 'forward'")
    spelled = measured(spark, sf).withColumn("data_type", F.upper("data_type"))
    return catalog.translate_types(spelled, forward).select("table_name", "column_name", "target_type")


@query("frame_catalog", """
SELECT 'documents' AS table_name, c AS column_name, i AS ordinal_position, t AS target_type, k AS key_indicator, (SELECT count(*) FROM documents) AS table_rows
FROM (VALUES ('doc_id', 1, 'varchar', 1), ('meta', 2, 'variant', 0), ('words', 3, 'varchar', 0), ('parts', 4, 'variant', 0)) v(c, i, t, k)
""")
def frame_catalog(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.struct("lang", "source").alias("meta"), F.split("text", " ").alias("words"), F.array(F.struct("lang", "n_chars")).alias("parts")
    )
    rows = d.agg(F.count(F.lit(1)).alias("table_rows"))
    return catalog.frame_catalog(d, "documents", ["DOC_ID"]).select("*", rows.scalar().alias("table_rows"))


@query("catalog_drift", """
SELECT 'customer' AS table_name, 'c_acctbal,c_mktsegment' AS column_name UNION ALL SELECT 'part', 'p_brand,p_name,p_partkey,p_retailprice,p_size,p_type'
""")
def catalog_drift(spark, sf):
    source = measured(spark, sf)
    smaller = catalog.profile_columns(table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment"), "CUSTOMER")
    others = union_by_name(*[catalog.profile_columns(table(spark, sf, t), t) for t in ("orders", "events")])
    return catalog.new_columns(source, smaller.unionByName(others))


@query("catalog_integrity", f"""
WITH {measured_sql()} SELECT 'DUPLICATE_COLUMN' AS rule, 'orders.O_ORDERKEY' AS subject, 2 AS amount
UNION ALL SELECT 'DUPLICATE_ORDINAL', 'orders.1', 2 UNION ALL SELECT 'NO_KEY', 'part', 6
UNION ALL SELECT 'SEVERAL_ACTIVE_ROWS', cast(o_custkey AS varchar), count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey HAVING count(*) > 1
""")
def catalog_integrity(spark, sf):
    columns = measured(spark, sf)
    marked = columns.select("table_name", "column_name", "ordinal_position", F.when((F.col("ordinal_position") == 1) & (F.col("table_name") != "part"), 1).otherwise(0).alias("key_indicator"))
    again = marked.where("column_name = 'o_orderkey'").withColumn("column_name", F.upper("column_name"))
    feeds = table(spark, sf, "orders").select(F.col("o_custkey").alias("feed_id"), F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("is_active"))
    return catalog.integrity_report(marked.unionByName(again), feeds)


@query("lookup_active", """
SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN ' yes ' ELSE 'no' END AS flag, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS is_active, '2024-02-01' AS created_at, '2024-02-01' AS modified_at FROM customer
""")
def lookup_active(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, " yes ").otherwise("no").alias("flag"))
    return catalog.lookup_rows(c, "flag", "2024-02-01")


@query("replace_feed_schema", f"""
WITH {measured_sql()} SELECT CASE table_name WHEN 'customer' THEN 1 WHEN 'events' THEN 2 ELSE 3 END AS feed_id, table_name,
  CASE WHEN table_name = 'part' THEN replace(column_name, 'p_', 'p_') ELSE column_name END AS column_name, ord AS ordinal_position FROM cols WHERE table_name <> 'orders'
""")
def replace_feed_schema(spark, sf):
    columns = measured(spark, sf)
    number = F.when(F.col("table_name") == "customer", 1).when(F.col("table_name") == "events", 2).otherwise(3)
    schema = columns.where("table_name <> 'part'").select(number.alias("feed_id"), "table_name", "column_name", "ordinal_position")
    new = columns.where("table_name = 'part'").select("table_name", F.replace(F.col("column_name"), F.lit("_"), F.lit("#")).alias("column_name"), "ordinal_position")
    existing = columns.select(F.concat(F.lit("stg_"), "table_name").alias("table_name")).distinct()
    return catalog.replace_feed_schema(schema, 3, new, existing)
