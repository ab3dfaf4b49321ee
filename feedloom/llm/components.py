"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.session import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node of ``links`` (``a``, ``b``); both long.

    Alternating stars: every node hangs its larger neighbours, then its smaller ones, on the smallest of them, until
    only stars are left. Neighbours are never gathered: each half round is an aggregate and a join back, and each
    round is written to the shared folder. The driver sees a count and a checksum.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges, state = written(edges, "edges"), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = written(hung.select("e.*").where("u != v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
