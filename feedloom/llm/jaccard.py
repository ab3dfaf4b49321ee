"""Exact Jaccard join of word n-gram sets through a matrix of tokens and groups.

Similar documents form groups around one of them, the hub; the matrix holds each group's union of tokens. A document's
overlap with the union bounds its overlap with every member, so only groups that may hold a partner are opened. Within
a group the hub stands for what all have in common: members are told by the tokens in which they differ from it, and
compared only if they share enough of those.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.llm.components import components
from feedloom.llm.word_hashes import WordHasher, grams
from feedloom.session import released, tidy, written

SHINGLE = 5
PERCENT = 75
#: Cells in which token frequencies are counted to find a cheap order of tokens; any order gives the same links.
CELLS = 1 << 22
#: Cells that are added up together, and groups of tasks whose counts are added up before those of all.
CHUNK = 1 << 16
TASK_GROUPS = 256
#: Width of a row of the matrix: tokens share columns, which can only raise a bound.
COLUMNS = 4096
#: Documents in a group; larger ones are several rows of the matrix.
GROUP = 64
#: Similarity to a hub, in per cent, from which on a document belongs to its group.
NEAR = 40
#: Bits of the filters that tell in a scan which sets or tokens a join may need; what passes by chance the join drops.
FILTER_BITS = 1 << 25


class Shingler:
    """Token sets (sorted, distinct, 64-bit) of the rows of a text column, and a 64-bit name for equal sets."""

    def __init__(self, size: int = SHINGLE):
        self.hasher, self.size = WordHasher(), size

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        words, bounds = self.hasher.words(column)
        tokens = grams(words, self.size)
        for start, end in zip(bounds, bounds[1:], strict=False):
            if end - start >= self.size:
                yield np.unique(tokens[start : end - self.size + 1])
            else:
                yield grams(words[start:end], end - start)[: int(end > start)]


def _named(tokens: np.ndarray) -> int | None:
    return int(np.array(xxhash.xxh3_64_intdigest(tokens.tobytes()), np.uint64).view(np.int64)) if len(tokens) else None


def _need(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def token_frequencies(docs: DataFrame, size: int = SHINGLE, cells: int = CELLS) -> np.ndarray:
    """How many token occurrences in sets fall into each of ``cells`` cells, over all documents.

    Every task packs its counts in chunks. They are added up chunk by chunk, first for some tasks, then for all.
    """
    shift, chunk = np.uint64(64 - cells.bit_length() + 1), min(cells, CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(size), np.zeros(cells, np.uint32)
        for batch in batches:
            tokens = np.concatenate([np.empty(0, np.uint64), *shingler.sets(batch.column(0))])
            counts += np.bincount((tokens >> shift).astype(np.int64), minlength=cells).astype(np.uint32)
        if counts.any():
            packed = [zlib.compress(counts[i : i + chunk].tobytes(), 1) for i in range(0, cells, chunk)]
            group = np.full(len(packed), TaskContext.get().partitionId() % TASK_GROUPS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(packed)), pa.int32()), pa.array(group, pa.int32()), pa.array(packed, pa.binary())], ["chunk", "tasks", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.uint32)
        for packed in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(packed), np.uint32)
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    made = docs.select("text").mapInArrow(count, "chunk int, tasks int, counts binary")
    some = made.groupBy("chunk", "tasks").applyInArrow(add, "chunk int, counts binary")
    found = some.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").toArrow()
    total = np.zeros(cells, np.uint32)
    for i, packed in zip(found.column("chunk").to_pylist(), found.column("counts").to_pylist(), strict=True):
        total[i * chunk : (i + 1) * chunk] = np.frombuffer(zlib.decompress(packed), np.uint32)
    return total


def _graded(counts: np.ndarray) -> np.ndarray:
    """Frequencies in steps of an eighth of a power of two, a byte each: as good an order, at a quarter of the size."""
    return np.minimum(np.rint(8 * np.log2(counts + np.float32(1), dtype=np.float32)), 255).astype(np.uint8)


def _frequency(cells: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return cells[(tokens >> np.uint64(64 - len(cells).bit_length() + 1)).astype(np.int64)]


def signatures(docs: DataFrame, order: Broadcast, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: ``n``, ``node`` (equal sets share it; null for the empty set), ``prefix`` and ``bits``.

    Tokens are ordered by the frequency of their cell, rare first, then by value. Two sets that are similar enough share a token
    among the first n - ceil(n * percent / 100) + 1 of each: their prefix. ``bits`` is the set's row of the matrix.
    ``order`` holds :func:`token_frequencies`, graded or not.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            n, node, prefix, bits = [], [], [], []
            for tokens in shingler.sets(batch.column("text")):
                n.append(len(tokens))
                node.append(_named(tokens))
                first = len(tokens) - -(-len(tokens) * percent // 100) + 1
                rare = np.argsort(_frequency(order.value, tokens), kind="stable")[:first]
                prefix.append(tokens[rare].view(np.int64))
                row = np.zeros(COLUMNS, np.uint8)
                row[(tokens % np.uint64(COLUMNS)).astype(np.int64)] = 1
                bits.append(np.packbits(row).tobytes())
            ends = np.cumsum([0, *map(len, prefix)])
            flat = np.concatenate(prefix) if prefix else np.empty(0, np.int64)
            columns = [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_hash", "n", "node", "prefix", "bits"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return read.mapInArrow(sign, "doc_id long, text_hash long, n long, node long, prefix array<long>, bits binary")


def _within(rows: DataFrame) -> DataFrame:
    """Rows whose ``bits`` can have ``need`` of its ``n`` tokens in ``others``: each bit missing there is a token missing."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, others = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COLUMNS // 8) for c in ("bits", "others")
            )
            missing = np.bitwise_count(own & ~others).sum(axis=1, dtype=np.int64)
            fits = batch.column("n").to_numpy() - missing >= batch.column("need").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return rows.select("a", "b", "n", "need", "bits", "others").mapInArrow(bound, "a long, b long")


@contextmanager
def _sent(spark: SparkSession, value: np.ndarray) -> Iterator[Broadcast]:
    """A value that tasks can read; what they make of it must be written before it is given back."""
    sent = spark.sparkContext.broadcast(value)
    try:
        yield sent
    finally:
        sent.destroy()


def _bit_filter(keys: DataFrame, column: str) -> AbstractContextManager[Broadcast]:
    """A broadcast array with the bit of every key set: FILTER_BITS of them, whatever the number of keys."""
    bit = F.pmod(column, F.lit(FILTER_BITS))
    words = keys.select(F.floor(bit / 32).cast("int").alias("word"), F.pow(F.lit(2.0), bit % 32).cast("long").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    asked = np.zeros(FILTER_BITS // 32, np.uint32)
    asked[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return _sent(keys.sparkSession, asked)


def _passes(filter_bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys % FILTER_BITS
    return (filter_bits[at // 32] >> (at % 32).astype(np.uint32) & 1).astype(bool)


def _rows_of(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``n`` and ``bits`` of the sets in ``nodes``, as a table; only what passes a filter leaves the scan."""

    with _bit_filter(nodes, "node") as asked:

        def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_passes(asked.value, batch.column("node").to_numpy())))

        found = sets.select("node", "n", "bits").mapInArrow(passing, "node long, n long, bits binary")
        return written(found.join(nodes, "node", "left_semi"), "rows")


def _sets_of(docs: DataFrame, nodes: DataFrame, copied: DataFrame, size: int) -> DataFrame:
    """``node`` and ``tokens`` of the sets in ``nodes`` as a table, built again from the texts; of copies from the smallest id."""
    chosen = written(nodes.join(copied.withColumn("several", F.lit(True)), "node", "left"), "chosen")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    with _bit_filter(nodes, "node") as asked:

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingler = Shingler(size)
            for batch in batches:
                sets = list(shingler.sets(batch.column("text")))
                named = [_named(tokens) for tokens in sets]
                passed = _passes(asked.value, np.array([n or 0 for n in named], np.int64)) & np.array([n is not None for n in named], bool)
                rows = np.flatnonzero(passed)
                lists = [sets[i].view(np.int64) for i in rows]
                ends = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
                tokens = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *lists])))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), pa.array([named[i] for i in rows], pa.int64()), tokens], ["doc_id", "node", "tokens"])

        built = read.mapInArrow(build, "doc_id long, node long, tokens array<long>")
        found = built.join(chosen, "node").where(F.col("several").isNull() | F.col("doc_id").eqNullSafe(F.col("smallest")))
        return written(found.select("node", "tokens"), "sets")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "needed")


def _with_sets(pairs: DataFrame, docs: DataFrame, copied: DataFrame, size: int) -> DataFrame:
    """``pairs`` with the whole sets of both sides."""
    sets = _sets_of(docs, _nodes_of(pairs), copied, size)
    left, right = (sets.select(F.col("node").alias(c), F.col("tokens").alias(f"tokens_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b")


def _linked(pairs: DataFrame, docs: DataFrame, copied: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose whole sets are similar enough."""
    both = _with_sets(pairs, docs, copied, size)
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - shared
    return both.where(shared * 100 >= union * percent).select("a", "b").distinct()


def _compared(both: DataFrame, percent: int) -> DataFrame:
    """Pairs with their sets, ``b`` being a pivot: ``linked``, both sizes and, near its hub, the tokens in which ``a`` differs."""
    extra, missing = F.array_except("tokens_a", "tokens_b"), F.array_except("tokens_b", "tokens_a")
    found = both.select("a", "b", "hub", F.size("tokens_a").alias("n"), F.size("tokens_b").alias("n_b"), extra.alias("extra"), missing.alias("missing"))
    shared, union = F.col("n") - F.size("extra"), F.col("n_b") + F.size("extra")
    near = F.col("hub") & (shared * 100 >= union * NEAR)
    return found.select("a", "b", (shared * 100 >= union * percent).alias("linked"), "n", "n_b", F.when(near, F.concat("extra", "missing")).alias("differs"))


def _members(compared: DataFrame, roots: DataFrame) -> DataFrame:
    """Every member of a group, the hub included: ``node``, ``hub``, ``n``, ``n_hub``, ``differs`` and ``root``."""
    near = compared.where("differs is not null")
    own = near.select(F.col("a").alias("node"), F.col("b").alias("hub"), "n", F.col("n_b").alias("n_hub"), "differs")
    hubs = near.select("b", "n_b").distinct().select(F.col("b").alias("node"), F.col("b").alias("hub"), F.col("n_b").alias("n"), F.col("n_b").alias("n_hub"), F.array().cast("array<long>").alias("differs"))
    return own.union(hubs).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _centred(members: DataFrame, percent: int) -> DataFrame:
    """Members of groups with several components, told by what they differ in from most others instead of from the hub.

    Adds ``score``, (100 - percent) times the size less (100 + percent) times the number of differing tokens, ``best``,
    the member with the highest score, ``top``, and a ``bucket`` of scores. Two members whose scores add up to 0 or
    more are linked, whatever they differ in; then both are linked to the best one too, so their ``root`` is its own.
    ``differs`` has first the tokens that few members differ in, but only those of several; ``own`` is the number of
    the others, which go before them.
    """
    several = members.groupBy("hub").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    opened = written(members.join(several.select("hub", "m"), "hub"), "opened")
    often = opened.select("hub", "m", F.explode("differs").alias("token")).groupBy("hub", "m", "token").agg(F.count(F.lit(1)).alias("c")).where("2 * c > m")
    # Fewer than twice as many tokens as a member differs in on average.
    usual = often.groupBy("hub").agg(F.sort_array(F.collect_list("token")).alias("usual"))
    told = opened.join(usual, "hub", "left")
    differs = F.concat(F.array_except("differs", "usual"), F.array_except("usual", "differs"))
    told = told.withColumn("differs", F.when(F.col("usual").isNull(), F.col("differs")).otherwise(differs))
    told = told.withColumn("score", F.col("n") * (100 - percent) - F.size("differs") * (100 + percent))
    step = F.greatest(F.lit(1), F.floor(F.col("n_hub") * (100 - percent) / 2))
    told = told.withColumn("bucket", F.floor((F.col("n_hub") * (100 - percent) - F.col("score")) / step))
    told = written(told.select("node", "hub", "root", "score", "bucket", "differs"), "told")
    tokens = told.select("hub", "node", F.explode("differs").alias("token"))
    counts = tokens.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    lists = tokens.join(counts, ["hub", "token"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("several"))
    several = F.coalesce(F.col("several.token"), F.array().cast("array<long>"))
    centred = told.join(lists, "node", "left").withColumn("own", F.size("differs") - F.size(several)).withColumn("differs", several).drop("several")
    centred = written(centred, "centred")
    best = centred.groupBy("hub").agg(F.max(F.struct("score", "node", "root")).alias("best"))
    centred = centred.join(best, "hub").withColumns({"top": F.col("best.score"), "best_root": F.col("best.root"), "best": F.col("best.node")})
    root = F.when(F.col("score") + F.col("top") >= 0, F.col("best_root")).otherwise(F.col("root"))
    return centred.withColumn("root", root).withColumn("in_best", (F.col("root") == F.col("best_root")).cast("int")).drop("best_root")


def _inside(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of a group, not known to be in one component, that differ from the others alike enough to be linked.

    If two members have scores s and t, they share at least -(s + t) / (2 * (100 + percent)) differing tokens, or are
    no link. So they share one among the first of each: its prefix, whose length depends on the scores of the bucket
    that the other is in.
    """
    weight = 2 * (100 + percent)
    opened = members.groupBy("hub").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("hub")
    tops = members.groupBy("hub", "bucket").agg(F.max("score").alias("top")).groupBy("hub").agg(F.collect_list(F.struct(F.col("bucket").alias("other"), F.col("top").alias("other_top"))).alias("tops"))
    some = members.join(opened, "hub", "left_semi").drop("top", "best").join(tops, "hub")
    some = some.select("hub", "node", "score", "differs", "own", "bucket", F.struct("in_best", "root").alias("rank"), F.inline("tops"))
    some = some.withColumn("least", F.greatest(F.lit(1), F.ceil(-(F.col("score") + F.col("other_top")) / weight)).cast("int"))
    some = some.withColumn("first", F.size("differs") - F.col("least") + 1).where("first > 0")
    prefix = F.slice("differs", F.lit(1), F.col("first"))
    key = ["hub", "small", "large", "token"]
    some = some.select(
        "hub", F.least("bucket", "other").alias("small"), F.greatest("bucket", "other").alias("large"), F.explode(prefix).alias("token"),
        "node", "score", "bucket", "rank", "least",
    )
    some = written(some, "differing")
    several = some.groupBy(*key).agg(F.min("rank").alias("low"), F.max("rank").alias("high")).where("low != high").drop("low")
    at = written(some.join(several, key), "open-differing")
    asking = at.where("rank < high").select(*key, F.col("node").alias("a"), F.col("score").alias("s"), F.col("bucket").alias("own"), F.col("rank").alias("own_rank"), F.col("least").alias("own_least"))
    both = asking.join(at, key).where((F.col("own_rank") < F.col("rank")) & ((F.col("small") == F.col("large")) | (F.col("own") != F.col("bucket"))))
    shared = both.groupBy("a", F.col("node").alias("b"), "s", "score", "own_least", "least").agg(F.count(F.lit(1)).alias("c"))
    need = F.greatest(F.lit(1), F.ceil(-(F.col("s") + F.col("score")) / weight)) - F.greatest("own_least", "least") + 1
    return shared.where(F.col("c") >= need).select("a", "b").distinct()


def _overlap(n: Column, other: Column, percent: int | Column) -> Column:
    """Tokens that two sets of these sizes share if they are similar enough."""
    return F.ceil((n + other) * percent / (percent + 100))


def _common(n: Column, other: Column, percent: int) -> Column:
    """Tokens that the prefixes of two such sets share at least.

    Of a prefix, n - overlap tokens may be missing in the other set; what is left of the prefix that ends first in the
    common order of tokens lies in the other prefix too.
    """
    return _overlap(n, other, percent) - _need(F.greatest(n, other), percent) + 1


def _bounded(pairs: DataFrame, rows: DataFrame, percent: int | Column) -> DataFrame:
    """Pairs ``a``, ``b`` whose sizes and rows of the matrix allow this similarity."""
    of_a = rows.select(F.col("node").alias("a"), "n", "bits")
    of_b = rows.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("others"))
    need = _overlap(F.col("n"), F.col("n_b"), percent)
    return _within(pairs.join(of_a, "a").join(of_b, "b").where(F.least("n", "n_b") >= need).withColumn("need", need))


def set_links(docs: DataFrame, signed: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``node`` and ``root`` of all sets that are linked to another one, directly or through others.

    First every prefix token brings its documents to the smallest of them, as far as they share two tokens in this
    way. What is truly linked forms components, and what is near forms groups around these hubs. Pairs of one group
    are found by what they differ in, see :func:`_inside`. Pairs of different groups share a prefix token: then the
    document of the smaller group is held against the rows of the matrix of the other one, and only members of rows
    within the bound are compared one by one. Documents that are known to be in one component are not compared.
    """
    spark = docs.sparkSession
    some = signed.where(F.col("node").isNotNull())
    copied = some.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("smallest")).where("m > 1").drop("m")
    copied = written(copied, "copied")
    some, names = some.select("node", "n", "prefix", "bits"), copied.select("node")
    sets = some.join(names, "node", "left_anti").union(some.join(names, "node", "left_semi").dropDuplicates(["node"]))
    tokens = sets.select(F.explode("prefix").alias("token"), "node")
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    shared = written(shared, "shared")
    with _bit_filter(shared, "token") as asked:
        held = written(_held(sets, asked).join(shared, "token"), "shared-tokens")
    tidy(spark)

    pivots = held.groupBy("token").agg(F.min("node").alias("pivot"))
    stars = held.join(pivots, "token").where("node != pivot")
    stars = stars.groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    n_a, n_b = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    close = (F.least("n_a", "n_b") >= _overlap(F.col("n_a"), F.col("n_b"), percent)) & (F.col("c") >= F.least(F.lit(2), _common(F.col("n_a"), F.col("n_b"), percent)))
    stars = written(stars.join(n_a, "a").join(n_b, "b").where(close).select("a", "b", "c"), "stars")
    # The hub of a document is the pivot it shares most tokens with; a hub of others is its own.
    chosen = stars.groupBy("a").agg(F.min(F.struct((-F.col("c")).alias("c"), "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    chosen = chosen.join(chosen.select(F.col("b").alias("a")), "a", "left_anti").withColumn("hub", F.lit(True))
    stars = stars.select("a", "b").join(chosen, ["a", "b"], "left").withColumn("hub", F.coalesce("hub", F.lit(False)))
    stars = written(stars, "hubs")
    tidy(spark)
    rows = _rows_of(sets, _nodes_of(stars))
    near = _bounded(stars, rows, F.when(F.col("hub"), NEAR).otherwise(percent))
    near = written(near.join(stars, ["a", "b"]), "pairs")
    compared = written(_compared(_with_sets(near, docs, copied, size), percent), "compared")
    links = compared.where("linked").select("a", "b")
    tidy(spark)
    roots = written(components(links), "roots")
    tidy(spark)
    members = written(_members(compared, roots), "members")
    centred = written(_centred(members, percent), "centred")
    sure = centred.where((F.col("score") + F.col("top") >= 0) & (F.col("node") != F.col("best"))).select(F.col("node").alias("a"), F.col("best").alias("b"))

    tidy(spark)
    # Groups: members in rows of at most GROUP; a set without a hub is a group of its own.
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("only"), F.max("root").alias("high"))
    grouped = members.select("node", "hub", "root").join(sizes, "hub").withColumn("only", F.when(F.col("only") == F.col("high"), F.col("only"))).drop("high")
    alone = F.coalesce("own_root", "node")
    placed = sets.select("node", "n").join(grouped, "node", "left").join(roots.withColumnRenamed("root", "own_root"), "node", "left")
    placed = placed.withColumns({"only": F.when(F.col("hub").isNull(), alone).otherwise(F.col("only")), "root": F.coalesce("root", alone)})
    placed = placed.withColumns({"hub": F.coalesce("hub", "node"), "members": F.coalesce("members", F.lit(1))}).drop("own_root")
    placed = written(placed.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / GROUP))), "groups")
    at = held.join(placed, "node").withColumn("rank", F.struct("members", "hub"))
    several = at.groupBy("token").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).where("low != high").drop("low")
    at = written(at.join(several, "token"), "open-tokens")
    # The largest group at a token is looked up, never asking; of two groups the smaller one asks.
    asking = at.where("rank < high").select("token", F.col("node").alias("a"), F.col("rank").alias("own"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
    matrix = at.groupBy("token", "rank", "part", "only").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    asked = asking.join(matrix, "token").where((F.col("own") < F.col("rank")) & ~F.col("root_a").eqNullSafe(F.col("only")))
    asked = asked.groupBy("a", "n_a", "root_a", F.col("rank.hub").alias("hub"), "part").agg(F.count(F.lit(1)).alias("c"), F.min("low").alias("low"), F.max("high").alias("high"))
    # As many tokens of the prefix as a partner of any size in the row shares at least; rounding is up to 1 off.
    asked = asked.withColumns({"low": F.greatest("low", _need(F.col("n_a"), percent)), "high": F.least("high", F.floor(F.col("n_a") * 100 / percent))})
    common = F.least(*[_common(F.col("n_a"), F.col(c), percent) for c in ("low", "high")]) - F.when(F.col("low") < F.col("high"), 1).otherwise(0)
    asked = written(asked.where((F.col("low") <= F.col("high")) & (F.col("c") >= common)).select("a", "root_a", "hub", "part"), "asked")
    tidy(spark)
    met = placed.join(asked.select("hub", "part").distinct(), ["hub", "part"], "left_semi")
    nodes = written(met.select("node").union(asked.select(F.col("a").alias("node"))).distinct(), "needed")
    rows = _rows_of(sets, nodes)
    unions = _unions(met.drop("n").join(rows, "node"))
    own = rows.select(F.col("node").alias("a"), "n", "bits", _need(F.col("n"), percent).alias("need"))
    candidates = asked.join(own, "a").join(unions, ["hub", "part"])
    opened = _within(candidates.select("a", F.xxhash64("hub", "part").alias("b"), "n", "need", "bits", "others"))
    inside = met.select(F.xxhash64("hub", "part").alias("group"), F.col("node").alias("b"), "root")
    pairs = opened.select("a", F.col("b").alias("group")).join(inside, "group").join(asked.select("a", "root_a").distinct(), "a")
    across = _bounded(pairs.where("root_a != root").select("a", "b").distinct(), rows, percent)
    within = _inside(centred, percent)
    more = written(across.union(within).distinct(), "pairs")
    tidy(spark)
    more = written(_linked(more, docs, copied, size, percent), "links")
    tidy(spark)
    return written(components(links.union(sure).union(more)), "roots")


def _held(sets: DataFrame, asked) -> DataFrame:
    """``token`` and ``node`` for the prefix tokens that pass a filter."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            tokens = lists.flatten().to_numpy()
            nodes = np.repeat(batch.column("node").to_numpy(), lists.value_lengths().to_numpy())
            passed = _passes(asked.value, tokens)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[passed]), pa.array(nodes[passed])], ["token", "node"])

    return sets.select("node", "prefix").mapInArrow(unfold, "token long, node long")


def _unions(members: DataFrame) -> DataFrame:
    """The matrix: ``others``, the bits of all members of each ``hub`` and ``part`` together."""

    one = members.where("members = 1").select("hub", "part", F.col("bits").alias("others"))

    def joined(table: pa.Table) -> pa.Table:
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(-1, COLUMNS // 8)
        row = {"hub": table.column("hub")[:1], "part": table.column("part")[:1], "others": pa.array([np.bitwise_or.reduce(bits).tobytes()], pa.binary())}
        return pa.table(row)

    many = members.where("members > 1").select("hub", "part", "bits")
    return one.union(many.groupBy("hub", "part").applyInArrow(joined, "hub long, part long, others binary"))


def _judged(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles`` and ``root``, equal for all rows of a component; null without shingles."""
    with released(docs.sparkSession):
        with _sent(docs.sparkSession, _graded(token_frequencies(docs, size))) as order:
            signed = written(signatures(docs, order, size, percent), "signatures")
        roots = set_links(docs, signed, size, percent)
    rows = signed.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node").join(roots, "node", "left")
    return rows.withColumn("root", F.coalesce("root", "node")).drop("node")


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles`` and ``component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    A-Z count as a-z; a text with fewer than ``size`` words has one shingle, one without words or text none, and then
    no link: its component is its own id. Rows link when 100 * intersection >= ``percent`` * union. ``component_id``
    is the smallest id in reach; where rows without an id are in reach they count only if there is no other.
    Repeated rows, and rows that share an id, are linked by their texts like any others. Other columns are not read.

    Shingles and sets are compared by 64-bit hashes: among 10^11 sets some 300 unrelated pairs would be taken as equal.
    """
    rows = _judged(docs, size, percent)
    smallest = written(rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("smallest")), "smallest")
    found = rows.join(smallest, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return found.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component only, that of the smallest id; same columns.

    Rows without an id come last, among equal ids the smallest hash of the text decides. Rows with the same id and
    text are one document: one of them stays, also of those without words. The rows to drop are looked up by id and
    text hash, so Spark broadcasts them if they are few.
    """
    judged = written(_judged(docs, SHINGLE, PERCENT), "components")
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = written(judged.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(name).alias("best"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m"), "best")
    key = {c: F.col(c).alias(f"__{c}") for c in ("doc_id", "text_hash")}
    drop = judged.join(best, "root").where(~name.eqNullSafe(F.col("best"))).select(*key.values()).distinct()
    hashed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    match = F.col("id").eqNullSafe(F.col("__doc_id")) & (F.col("hash") == F.col("__text_hash"))
    kept = hashed.join(drop, match, "left_anti")
    repeated = judged.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key.values())
    repeated = written(repeated, "repeated")
    single = kept.join(repeated, match, "left_anti")
    once = kept.join(repeated, match, "left_semi").groupBy("id", "hash").agg(F.first("doc").alias("doc"))
    return single.select("doc.*").union(once.select("doc.*"))
