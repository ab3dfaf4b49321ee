"""Mixing sources to target weights: whole copies plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from feedloom.session import written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix"


def source_rates(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """``source``, ``source_size``, ``target`` and ``rate`` of every source; ``sized`` has ``source`` and ``size``.

    Sources in code point order, null last, take the weights in turn. Together they get the size of all documents.
    A source above ``most_repeats`` times its own size stops there, and the others share its excess by weight. That is
    one level L with target = min(weight * L, cap): in the order of cap / weight, the level that is left after the
    first sources have stopped rises up to the first one that does not stop and falls from there on, so L is its
    largest value. The windows see one row per source. A source without any words has target and rate 0.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumn("weight", turn[((F.col("rank") - 1) % len(weights)).cast("int")]).withColumn(
        "cap", F.col("source_size") * most_repeats
    )
    everything = W.partitionBy()
    at = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = at.rowsBetween(W.unboundedPreceding, -1), at.rowsBetween(0, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = weighed.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    target = F.least(F.col("weight") * F.max("level").over(everything), F.col("cap").cast("double"))
    return levels.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def coin(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(sized: DataFrame, rates: DataFrame, doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Every row of ``sized`` with its source's sizes and ``copies``: floor(rate), plus one where the coin says so.

    Rows that share an id share their coin; a null id is tossed like an empty one.
    """
    r = rates.select(F.col("source").alias("__source"), "source_size", "target", "rate")
    whole = F.floor("rate")
    extra = (coin(F.col(doc_id), seed) < F.col("rate") - whole).cast("long")
    joined = sized.join(r, sized["source"].eqNullSafe(r["__source"]), "left")
    return joined.withColumn("copies", (whole + extra).cast("long")).drop("__source", "rate")


def mix(
    docs: DataFrame, size: Column, weights: Sequence[float] = WEIGHTS, most_repeats: int = MOST_REPEATS, seed: str = SEED
) -> DataFrame:
    """The rows of ``docs`` (``doc_id`` and ``source``), each as often as the mix takes it; same columns.

    ``size`` is computed once for the totals and not again: the rates alone decide. The rates are written to the
    shared folder, so that Spark knows their size when it plans the join. Null sources are a source of their own,
    documents without words go with the others of their source, no rows give no rows, extra columns pass through.
    """
    rates = written(source_rates(docs.select("source", size.alias("size")), weights, most_repeats), "rates")
    named = docs.select(F.col("doc_id").alias("id"), F.col("source"), F.struct("*").alias("doc"))
    counted = with_copies(named, rates, "id", seed)
    taken = counted.where(F.col("copies") > 0)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
