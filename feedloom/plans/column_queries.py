"""Column operators over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.keys import row_key, with_content_hash, with_md5_key, with_row_key
from feedloom.functions.text import collapse_blanks, delimiter_safe, implied_decimal, picture_scale, snake_case
from feedloom.operators.columns import (
    add_missing_columns, like_any, match_column_case, normalize_columns, project_mapping, since_watermark,
    to_string_columns, trim_strings, watermark_of, with_audit,
)
from feedloom.plans.registry import query, table
from feedloom.sources.coerce import coerce
from feedloom.types import RunContext

RUN = RunContext(
    execution_date="2024-02-01 00:00:00", source="orders_feed", reception_date="2024-01-31 00:00:00",
    is_full_load=True, pipeline_key="pk1", process_id="proc1", firm="f1", partition_value="20240131",
)

# A double with two decimals as plain text without trailing zeros.
PLAIN = "regexp_replace(cast(cast({0} as decimal(18,2)) as varchar), '\\.?0+$', '')"


@query("normalize_names", """
SELECT c_custkey AS "Cust_Key", c_name AS "Full_Name", c_nationkey AS order1, c_mktsegment AS "Market_Segment_" FROM customer
""")
def normalize_names(spark, sf):
    c = table(spark, sf, "customer").drop("c_acctbal")
    return normalize_columns(c.toDF("Cust Key ", "Full-Name", "order", "Market (Segment)"))


@query("snake_case_names", """
SELECT p_partkey, upper(replace(CASE WHEN regexp_matches(n, '^[0-9]') THEN '_' || n ELSE n END, '#', '_')) AS snake_name FROM (
  SELECT p_partkey, regexp_replace(CASE WHEN p_size < 10 THEN p_size || 'b' ELSE '' END || split_part(p_name, ' ', 1)
    || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) || p_brand,
    '([a-z])([A-Z])', '\\1_\\2', 'g') AS n FROM part)
""")
def snake_case_names(spark, sf):
    word = F.split("p_name", " ")
    camel = F.concat(F.get(word, 0), F.initcap(F.get(word, 1)), "p_brand")
    name = F.concat(F.when(F.col("p_size") < 10, F.concat(F.col("p_size").cast("string"), F.lit("b"))).otherwise(""), camel)
    return table(spark, sf, "part").select("p_partkey", snake_case(name).alias("snake_name"))


@query("to_string_cols", """
SELECT event_id, cast(ts AS varchar) AS ts, event_type, user_id FROM events
""")
def to_string_cols(spark, sf):
    return to_string_columns(table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id"))


@query("trim_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trim_strings_query(spark, sf):
    c = table(spark, sf, "customer")
    padded = c.select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), F.rpad("c_mktsegment", 20, " ").alias("c_mktsegment")
    )
    return trim_strings(padded)


@query("audit_columns", """
SELECT o_orderkey, o_orderstatus, '2024-01-31 00:00:00' AS elt_reception_date, '2024-02-01 00:00:00' AS elt_execution_date,
  'orders_feed' AS elt_source, 'pk1' AS elt_pipelinekey, 'FULL' AS elt_load_type, 0 AS elt_delete_ind, 'proc1' AS elt_process_id,
  'f1' AS elt_firm, 'I' AS elt_dml_type, '20240131' AS elt_partition_date FROM orders
""")
def audit_columns(spark, sf):
    return with_audit(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), RUN)


@query("row_key_sha256", """
SELECT o_orderkey, sha256(concat_ws('_', cast(o_custkey AS varchar), cast(o_orderkey AS varchar), 'src7')) AS elt_primary_key,
  concat_ws('_', cast(o_custkey AS varchar), cast(o_orderkey AS varchar), 'src7') AS plain_key FROM orders
""")
def row_key_sha256(spark, sf):
    o = table(spark, sf, "orders")
    keys = ["o_custkey", "o_orderkey"]
    return with_row_key(o, keys, "src7").select("o_orderkey", "elt_primary_key", row_key(o, keys, "src7", hashed=False).alias("plain_key"))


@query("row_key_md5", f"""
SELECT c_custkey, md5(concat_ws('_', cast(c_custkey AS varchar), c_name, cast(c_nationkey AS varchar),
  {PLAIN.format('c_acctbal')}, c_mktsegment)) AS "MD5_KEY" FROM customer
""")
def row_key_md5(spark, sf):
    return with_md5_key(table(spark, sf, "customer")).select("c_custkey", "MD5_KEY")


@query("content_hash", f"""
SELECT o_orderkey, sha256(concat_ws(chr(31), cast(o_custkey AS varchar), o_orderstatus, {PLAIN.format('o_totalprice')},
    cast(o_orderdate AS varchar), coalesce(o_orderpriority, 'N/A'))) AS elt_columns_hash,
  sha256(concat(cast(o_custkey AS varchar), o_orderstatus, {PLAIN.format('o_totalprice')}, cast(o_orderdate AS varchar),
    coalesce(o_orderpriority, 'N/A'))) AS legacy_hash
FROM (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)
""")
def content_hash_query(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    columns = o.columns[1:]
    both = with_content_hash(with_content_hash(o, columns), columns, legacy=True, name="legacy_hash")
    return both.select("o_orderkey", "elt_columns_hash", "legacy_hash")


@query("add_missing_columns", """
SELECT s_suppkey, s_name, s_nationkey, 'n/a' AS s_phone, 0 AS s_rank FROM supplier
""")
def add_missing(spark, sf):
    s = table(spark, sf, "supplier").drop("s_acctbal")
    return add_missing_columns(s, {"S_NAME": F.lit("unused"), "s_phone": F.lit("n/a"), "s_rank": F.lit(0)})


@query("match_column_case", 'SELECT s_suppkey AS "S_SuppKey", s_name AS "S_NAME", s_nationkey FROM supplier')
def match_case(spark, sf):
    return match_column_case(table(spark, sf, "supplier").drop("s_acctbal"), ["S_SuppKey", "S_NAME", "S_Phone"])


@query("mapping_projection", """
SELECT cast(p_partkey AS varchar) AS part_id, cast(p_size AS bigint) AS size_cm, p_type AS kind,
  cast(cast(p_retailprice AS decimal(12,2)) AS varchar) AS price FROM part
""")
def mapping_projection(spark, sf):
    p = table(spark, sf, "part").withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)"))
    mapping = [(4, "p_retailprice", "price", "string"), (1, "p_partkey", "part_id", "string"), (2, "p_size", "size_cm", "bigint"), (3, "p_type", "kind", "string")]
    return project_mapping(p, mapping)


@query("implied_decimal", """
SELECT l_orderkey, l_linenumber, cast(cast(l_extendedprice AS decimal(18,2)) AS varchar) AS price,
  cast(cast(l_discount AS decimal(18,2)) AS varchar) AS discount, cast(cast(l_quantity AS bigint) AS varchar) AS quantity,
  cast(cast(l_tax AS decimal(18,2)) / 1000 AS decimal(18,5))::varchar AS tax_5, l_returnflag AS flag FROM lineitem
""")
def implied_decimal_query(spark, sf):
    def cents(name):
        return F.round(F.col(name) * 100).cast("bigint").cast("string")

    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        implied_decimal(F.lpad(cents("l_extendedprice"), 13, "0"), 2).alias("price"),
        implied_decimal(cents("l_discount"), 2).alias("discount"),
        implied_decimal(F.lpad(F.col("l_quantity").cast("bigint").cast("string"), 7, "0"), 0).alias("quantity"),
        implied_decimal(cents("l_tax"), 5).alias("tax_5"),
        implied_decimal(F.col("l_returnflag"), 2).alias("flag"),
    )


@query("picture_scale", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN p_size % 6 + 1 WHEN 2 THEN p_size % 6 + 1 ELSE 0 END AS decimals FROM part
""")
def picture_scale_query(spark, sf):
    places = F.col("p_size") % 6 + 1
    whole = F.concat(F.lit("9("), F.col("p_size").cast("string"), F.lit(")"))
    picture = (
        F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("X("), F.col("p_size").cast("string"), F.lit(")")))
        .when(F.col("p_partkey") % 4 == 1, F.concat(whole, F.lit(" V"), F.repeat(F.lit("9"), places)))
        .when(F.col("p_partkey") % 4 == 2, F.concat(F.lower(F.concat(whole, F.lit("v9("))), places.cast("string"), F.lit(")")))
        .otherwise(F.concat(F.lit("S"), whole))
    )
    return table(spark, sf, "part").select("p_partkey", picture_scale(picture).cast("int").alias("decimals"))


@query("collapse_blanks", """
SELECT doc_id, md5(regexp_replace(trim(replace(text, 'e', '  ')), ' +', ' ', 'g')) AS digest FROM documents
""")
def collapse_blanks_query(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(collapse_blanks(F.replace(F.col("text"), F.lit("e"), F.lit("  ")))).alias("digest"))


@query("delimiter_safe", """
SELECT doc_id, md5(nullif(replace(replace(replace(text, '|', ':'), chr(10), ' '), chr(13), ' '), '')) AS digest,
  nullif(replace(CASE WHEN doc_id % 5 = 0 THEN '' ELSE source || '|' || lang END, '|', ':'), '') AS origin FROM documents
""")
def delimiter_safe_query(spark, sf):
    origin = F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat("source", F.lit("|"), "lang"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(delimiter_safe(F.col("text"))).alias("digest"), delimiter_safe(origin).alias("origin")
    )


@query("incremental_watermark", """
SELECT event_id, event_type, cast(ts AS varchar) AS ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')
""")
def incremental_watermark(spark, sf):
    e = table(spark, sf, "events")
    history = watermark_of(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp")), "ts")
    return since_watermark(e, history, "ts").select("event_id", "event_type", F.col("ts").cast("string").alias("ts"))


@query("watermark_emit", """
SELECT event_type, cast(max(ts) AS varchar) AS max_timestamp, count(*) AS rows_ingested FROM events GROUP BY event_type
""")
def watermark_emit(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(F.max("ts").cast("string").alias("max_timestamp"), F.count(F.lit(1)).alias("rows_ingested"))


@query("like_any", """
SELECT p_partkey, p_type, p_name FROM part WHERE p_type ILIKE 'promo%' OR p_type ILIKE '%ard' OR p_type ILIKE 'SM_LL'
""")
def like_any_query(spark, sf):
    return table(spark, sf, "part").where(like_any(F.col("p_type"), "promo*, %ard,SM_LL")).select("p_partkey", "p_type", "p_name")


@query("case_status", """
SELECT o_orderkey, CASE WHEN coalesce(o_orderpriority, '') = '' THEN 'ACTIVE' ELSE 'INACTIVE' END AS account_status,
  CASE WHEN upper(o_orderstatus) = 'F' THEN 1 ELSE 0 END AS is_active
FROM (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN '' ELSE o_orderpriority END AS o_orderpriority) FROM orders)
""")
def case_status(spark, sf):
    ended = F.when(F.col("o_orderpriority") == "2-HIGH", "").when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
    o = table(spark, sf, "orders").withColumn("ended", ended)
    return o.select(
        "o_orderkey",
        F.when(F.coalesce("ended", F.lit("")) == "", "ACTIVE").otherwise("INACTIVE").alias("account_status"),
        F.when(F.upper("o_orderstatus") == "F", 1).otherwise(0).alias("is_active"),
    )


@query("typed_coerce", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS custkey,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE cast(cast(o_orderdate AS date) AS varchar) END AS orderdate,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_done,
  cast(cast(o_totalprice AS decimal(18,2)) AS varchar) AS price, cast(o_orderdate AS varchar) AS at FROM orders
""")
def typed_coerce(spark, sf):
    day = F.col("o_orderdate").cast("date").cast("string")
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("O_ORDERKEY"),
        F.when(F.col("o_orderkey") % 7 == 0, "none").when(F.col("o_orderkey") % 7 == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(F.col("o_custkey").cast("string")).alias("CUSTKEY"),
        F.when(F.col("o_orderkey") % 3 == 0, F.replace(day, F.lit("-"), F.lit(""))).when(F.col("o_orderkey") % 3 == 1, day).otherwise(F.lit("31/31/1999")).alias("ORDERDATE"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0").otherwise("?").alias("IS_DONE"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("PRICE"),
        F.col("o_orderdate").cast("string").alias("AT"),
    )
    types = {"O_ORDERKEY": "bigint", "CUSTKEY": "bigint", "ORDERDATE": "date", "IS_DONE": "bit", "PRICE": "decimal", "AT": "timestamp"}
    typed = coerce(raw, types)
    return typed.select(
        "o_orderkey", "custkey", F.col("orderdate").cast("string").alias("orderdate"), "is_done",
        F.col("price").cast("decimal(18,2)").cast("string").alias("price"), F.col("at").cast("string").alias("at"),
    )


@query("string_functions", """
SELECT c_custkey, upper(trim(c_name)) AS a, substr(c_name, 1, 2) AS b, split_part(c_name, '#', 2) AS c,
  regexp_extract(replace(c_name, '#', '_'), '[^_]+$') AS d, rpad(c_mktsegment, 12, '*') AS e, length(c_mktsegment) AS f,
  rtrim(c_name, '0123456789') AS g, strpos(c_name, '#') AS h, substr(c_name, strpos(c_name, '#') + 1) AS i,
  regexp_matches(c_mktsegment, '^[A-M]') AS j, replace(c_name, 'Customer', 'Client') AS k, nullif(c_mktsegment, 'BUILDING') AS l FROM customer
""")
def string_functions(spark, sf):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey", F.upper(F.trim(name)).alias("a"), F.substring(name, 0, 2).alias("b"), F.get(F.split(name, "#"), 1).alias("c"),
        F.regexp_extract(F.replace(name, F.lit("#"), F.lit("_")), "[^_]+$", 0).alias("d"), F.rpad(segment, 12, "*").alias("e"),
        F.length(segment).alias("f"), F.rtrim(name, F.lit("0123456789")).alias("g"), F.locate("#", name).alias("h"),
        F.substr(name, F.locate("#", name) + 1).alias("i"), segment.rlike("^[A-M]").alias("j"),
        F.replace(name, F.lit("Customer"), F.lit("Client")).alias("k"), F.nullif(segment, F.lit("BUILDING")).alias("l"),
    )


@query("date_functions", """
SELECT o_orderkey, cast(cast(o_orderdate AS date) - 1 AS varchar) AS day_before, dayofmonth(o_orderdate) AS day_no,
  upper(substr(dayname(o_orderdate), 1, 3)) AS day_name, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%m%d%y') AS short_us,
  cast(cast(o_orderdate AS date) AS varchar) AS parsed, cast(epoch(o_orderdate) AS bigint) AS epoch_s,
  cast(cast(o_orderdate AS date) AS varchar) AS from_epoch, o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 40 DAY AS is_recent FROM orders
""")
def date_functions(spark, sf):
    from feedloom.functions.dates import first_date, header_timestamp

    at = F.col("o_orderdate")
    o = table(spark, sf, "orders").select(
        "*", F.date_format(at, "yyyyMMdd").alias("compact"), F.date_format(at, "MMddyy").alias("short_us"), F.date_format(at, "MM/dd/yyyy").alias("us")
    )
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.col("compact")).otherwise(F.col("us"))
    parsed = F.when(F.col("o_orderkey") % 5 == 0, header_timestamp(F.col("compact"), "YYMMDD")).otherwise(first_date(mixed, ["yyyyMMdd", "MM/dd/yyyy"]))
    return o.select(
        "o_orderkey", F.date_sub(at.cast("date"), 1).cast("string").alias("day_before"), F.dayofmonth(at).alias("day_no"),
        F.upper(F.date_format(at, "EEE")).alias("day_name"), "compact", "short_us",
        parsed.cast("date").cast("string").alias("parsed"), F.unix_timestamp(at).alias("epoch_s"),
        F.timestamp_seconds(F.unix_timestamp(at)).cast("date").cast("string").alias("from_epoch"),
        (at >= F.date_sub(F.lit("2001-08-01").cast("date"), 40)).alias("is_recent"),
    )
