"""From a fixed-width feed to the current table: parse, key, audit, upsert, query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.functions.keys import with_row_key
from feedloom.operators import state
from feedloom.operators.columns import with_audit
from feedloom.plans import feeds
from feedloom.plans.registry import query
from feedloom.session import scratch_path, written
from feedloom.sources import fixed_width as fw
from feedloom.sources.lake import TableVersions
from feedloom.sources.lines import read_lines
from feedloom.types import Feed, FeedTable, RunContext


def order_table(lines: DataFrame) -> dict[str, FeedTable]:
    data = fw.data_lines(lines, 3, "A", feeds.HEADER_TAG, feeds.TRAILER_TAG)
    parsed = fw.parse_fixed_width(data, feeds.ORDER_LAYOUT, "A").drop("transaction_code", "record_indicator")
    return {"orders": FeedTable("orders", parsed, ["order_key"])}


ORDERS = Feed("orders", read_lines, order_table)


def run(day: str) -> RunContext:
    return RunContext(day, "orders_feed", day, False, "pk1", "proc1", "f1", day.replace("-", ""))


def loaded(feed: FeedTable, day: str) -> DataFrame:
    return state.change_view(with_audit(with_row_key(feed.df, feed.keys, "orders_feed"), run(day)))


@query("feed_to_current", """
SELECT sha256(cast(o_orderkey AS varchar) || '_orders_feed') AS elt_integration_id, cast(o_orderkey AS varchar) AS order_key, cast(o_custkey AS varchar) AS customer,
  CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS status, cast(cast(o_totalprice AS decimal(18,2)) AS varchar) AS price, strftime(o_orderdate, '%Y%m%d') AS order_date, o_orderpriority AS priority,
  'two blanks' AS note, CASE WHEN o_orderstatus = 'P' THEN '2024-02-02' ELSE '2024-02-01' END AS elt_execution_date, 0 AS elt_delete_ind FROM orders
""")
def feed_to_current(spark: SparkSession, sf: str) -> DataFrame:
    """The feed of the first day is the table; on the second day pending orders come back as finished.

    As in a daily run the parsed feed and each batch are lake tables, the target is a snapshot.
    """
    feed = ORDERS.tables(spark, feeds.order_feed(spark, sf))["orders"]
    parsed = FeedTable(feed.name, written(feed.df, "parsed"), feed.keys)
    target = TableVersions(spark, scratch_path(spark, "orders-table"))
    first = target.replace(loaded(parsed, "2024-02-01").drop("elt_stream_action"))
    pending = parsed.df.where("status = 'P'").withColumn("status", F.lit("F"))
    second = written(loaded(FeedTable(feed.name, pending, feed.keys), "2024-02-02"), "batch")
    current = state.upsert(first, second)
    return current.select(
        "elt_integration_id", "order_key", "customer", "status", "price", "order_date", "priority", "note", "elt_execution_date", "elt_delete_ind"
    )
