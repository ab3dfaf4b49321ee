"""Exact length histogram: documents per encoded length, and sums from each length upwards."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from feedloom.llm.token_ids import encoder_of, send_vocabulary

BLOCK = 4096


def length_counts(docs: DataFrame, vocabulary: str, text: str = "text", end: int = 1) -> DataFrame:
    """``n_tokens`` and ``n_docs``: how many documents have each encoded length, with ``end`` ids added to each.

    Each task counts on its own, so the shuffle carries one row per task and length. Null and blank texts have
    length ``end``, repeated rows count each, no rows give no rows, other columns are not read. The vocabulary's file
    is read on the driver.
    """
    sent = send_vocabulary(docs.sparkSession, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = encoder_of(sent), Counter()
        for batch in batches:
            lengths.update((np.diff(encoder.encode(batch.column(0))[1]) + end).tolist())
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(lengths.keys(), pa.int64()), "n_docs": pa.array(lengths.values(), pa.int64())})

    counted = docs.select(text).mapInArrow(count, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For every length that occurs: ``docs_at_least``, ``tokens_at_least`` and ``truncated_total``.

    The last is the sum of min(length, n_tokens) over all documents: what is left if every document is cut there.
    Sums run within blocks of lengths; the blocks, one row each, are summed apart.
    """
    c = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = c.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    total = W.partitionBy()
    blocks = blocks.select(
        F.col("block").alias("b"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("t").over(total).alias("all_tokens"),
    )
    down = W.partitionBy("block").orderBy(F.col("n_tokens").desc())
    docs_ge = F.sum("n_docs").over(down) + F.col("docs_above")
    tokens_ge = F.sum("tokens").over(down) + F.col("tokens_above")
    sums = c.join(blocks, F.col("block") == F.col("b")).select("n_tokens", "n_docs", docs_ge.alias("docs_at_least"), tokens_ge.alias("tokens_at_least"), "all_tokens")
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return sums.withColumn("truncated_total", cut).drop("all_tokens")


def truncated_totals(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """``limits`` (``context``) with the documents below each context limit, and the tokens it keeps and cuts off.

    The shortest length that reaches a limit answers for it; a limit above all lengths keeps everything. Limits are
    few: they are sorted in among the lengths, and each takes the next length above from its block or, if there is
    none, from the first block above that has one.
    """
    all_tokens, all_docs = sums.agg(F.sum(F.col("n_tokens") * F.col("n_docs")), F.sum("n_docs")).first()
    found = F.struct("docs_at_least", "tokens_at_least")
    lengths = sums.select(F.col("n_tokens").alias("at"), found.alias("r"), F.lit(False).alias("asked"))
    asked = limits.select(F.col("context").cast("long").alias("at"), F.lit(None).cast(lengths.schema["r"].dataType).alias("r"), F.lit(True).alias("asked"))
    both = lengths.union(asked).withColumn("block", F.floor(F.col("at") / BLOCK))
    firsts = both.groupBy("block").agg(F.min_by("r", F.when(F.col("r").isNotNull(), F.col("at"))).alias("f"))
    above = W.orderBy("block").rowsBetween(1, W.unboundedFollowing)
    later = firsts.select(F.col("block").alias("b"), F.first("f", ignorenulls=True).over(above).alias("next"))
    up = W.partitionBy("block").orderBy("at", "asked").rowsBetween(0, W.unboundedFollowing)
    equal = W.partitionBy("block", "at")
    here = F.coalesce(F.max("r").over(equal), F.first("r", ignorenulls=True).over(up))
    answered = both.withColumn("here", here).where("asked").join(later, F.col("block") == F.col("b"))
    r = F.coalesce("here", "next")
    docs, tokens = F.coalesce(r["docs_at_least"], F.lit(0)), F.coalesce(r["tokens_at_least"], F.lit(0))
    cut = tokens - F.col("at") * docs
    return answered.select(F.col("at").alias("context"), (F.lit(all_docs or 0) - docs).alias("docs_below"), (F.lit(all_tokens or 0) - cut).alias("kept_tokens"), cut.alias("cut_tokens"))


def length_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share`` and ``n_tokens``: the smallest length that at least this share of the documents does not exceed."""
    all_docs = sums.agg(F.sum("n_docs")).first()[0] or 0
    up_to = F.lit(all_docs) - F.col("docs_at_least") + F.col("n_docs")
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    return sums.select("n_tokens", up_to.alias("up_to"), wanted).where(F.col("up_to") >= F.col("share") * all_docs).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
