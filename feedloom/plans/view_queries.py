"""The business views, over the shared tables in the roles of users, products, links and descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.ranking import newest_per_group
from feedloom.operators.relational import left_chain, union_by_name
from feedloom.plans.registry import query, table


@query("hierarchy_left_chain", """
SELECT r_name AS enterprise, n_name AS firm, c_name AS branch, o_orderkey AS advisor, l_partkey AS contact, p_type AS entitlement, s_name AS owner,
  CASE WHEN coalesce(l_returnflag, '') = '' THEN 'ACTIVE' ELSE 'INACTIVE' END AS account_status
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal >= 0
  LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus <> 'P' LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linestatus = 'F'
  LEFT JOIN part ON p_partkey = l_partkey AND p_size > 10 LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0
WHERE r_name <> 'ASIA' AND n_nationkey NOT IN (3, 7) AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
""")
def hierarchy_left_chain(spark, sf):
    t = {n: table(spark, sf, n) for n in ("region", "nation", "customer", "orders", "lineitem", "part", "supplier")}
    c = F.col
    joined = left_chain(
        t["region"],
        [
            (t["nation"], c("n_regionkey") == c("r_regionkey")),
            (t["customer"], (c("c_nationkey") == c("n_nationkey")) & (c("c_acctbal") >= 0)),
            (t["orders"], (c("o_custkey") == c("c_custkey")) & (c("o_orderstatus") != "P")),
            (t["lineitem"], (c("l_orderkey") == c("o_orderkey")) & (c("l_linestatus") == "F")),
            (t["part"], (c("p_partkey") == c("l_partkey")) & (c("p_size") > 10)),
            (t["supplier"], (c("s_suppkey") == c("l_suppkey")) & (c("s_acctbal") > 0)),
        ],
    )
    kept = joined.where((c("r_name") != "ASIA") & ~c("n_nationkey").isin(3, 7) & c("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"))
    return kept.select(
        c("r_name").alias("enterprise"), c("n_name").alias("firm"), c("c_name").alias("branch"), c("o_orderkey").alias("advisor"), c("l_partkey").alias("contact"),
        c("p_type").alias("entitlement"), c("s_name").alias("owner"), F.when(F.coalesce("l_returnflag", F.lit("")) == "", "ACTIVE").otherwise("INACTIVE").alias("account_status"),
    )


@query("union_current", """
SELECT 'customer' AS firm, c_custkey AS user_id, c_name AS user_name FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0
UNION ALL SELECT 'events', user_id, event_type FROM events WHERE event_type <> 'error'
""")
def union_current(spark, sf):
    def current(name, key, label, is_current):
        df = table(spark, sf, name).withColumn("meta_is_current", F.when(is_current, 1).otherwise(0))
        return df.where("meta_is_current = 1").select(F.lit(name).alias("firm"), F.col(key).alias("user_id"), F.col(label).alias("user_name"))

    return union_by_name(
        current("customer", "c_custkey", "c_name", F.col("c_acctbal") >= 0),
        current("supplier", "s_suppkey", "s_name", F.col("s_acctbal") >= 0),
        current("events", "user_id", "event_type", F.col("event_type") != "error"),
    )


@query("profile_join", """
SELECT o_orderkey AS user_id, o_custkey AS template_key, n.c_name AS job_function, o_orderpriority AS entitlement FROM orders JOIN customer n ON o_custkey = c_custkey AND o_custkey % 25 = c_nationkey
WHERE o_orderpriority = '1-URGENT'
""")
def profile_join(spark, sf):
    """Users and job templates meet on template key and firm."""
    users = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("user_id"), F.col("o_custkey").alias("template_key"), (F.col("o_custkey") % 25).cast("int").alias("firm"), F.col("o_orderpriority").alias("entitlement")
    )
    jobs = table(spark, sf, "customer").select(F.col("c_custkey").alias("template_key"), F.col("c_nationkey").alias("firm"), F.col("c_name").alias("job_function"))
    return users.join(jobs, ["template_key", "firm"]).where("entitlement = '1-URGENT'").drop("firm")


@query("entitlement_view", """
WITH d AS (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY trim(upper(p_name)) ORDER BY p_type, p_brand, p_partkey) = 1)
SELECT DISTINCT o_custkey AS portal_user, o_orderstatus AS status, p.p_name AS group_name, d.p_type AS category, d.p_brand AS sub_category, l_returnflag AS super_user
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part p ON p.p_partkey = l_partkey LEFT JOIN d ON trim(upper(p.p_name)) = trim(upper(d.p_name)) AND d.p_size > 10
WHERE o_orderstatus <> 'P' AND upper(trim(l_returnflag)) = 'R'
""")
def entitlement_view(spark, sf):
    """Current users with their groups, the first description of each group, super users only."""
    p = table(spark, sf, "part")
    key = F.trim(F.upper("p_name"))
    first = newest_per_group(p, [key], [F.col("p_type"), F.col("p_brand"), F.col("p_partkey")])
    described = first.where("p_size > 10").select(key.alias("entitlement"), F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"))
    users = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    links = table(spark, sf, "lineitem").where(F.upper(F.trim("l_returnflag")) == "R")
    groups = p.select("p_partkey", F.lower("p_name").alias("p_name")).withColumn("entitlement", key)
    joined = users.join(links, F.col("o_orderkey") == F.col("l_orderkey")).join(groups, F.col("p_partkey") == F.col("l_partkey")).join(described, "entitlement", "left")
    return joined.select(
        F.col("o_custkey").alias("portal_user"), F.col("o_orderstatus").alias("status"), F.col("p_name").alias("group_name"), "category", "sub_category", F.col("l_returnflag").alias("super_user")
    ).distinct()


@query("label_rewrite", """
SELECT concat(c_mktsegment, ' on ', n_name) AS label, replace(upper(c_name) || '@OLDNAME.COM', '@OLDNAME.COM', '@NEWNAME.COM') AS mail, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
""")
def label_rewrite(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal >= 0 AND c_mktsegment = 'BUILDING'").withColumn("mail", F.concat(F.upper("c_name"), F.lit("@OLDNAME.COM")))
    joined = c.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.concat("c_mktsegment", F.lit(" on "), "n_name").alias("label"), F.replace(F.col("mail"), F.lit("@OLDNAME.COM"), F.lit("@NEWNAME.COM")).alias("mail"), "c_custkey"
    )
