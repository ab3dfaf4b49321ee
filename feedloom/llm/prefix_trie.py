"""The trie of all beginnings of conversations, from padded matrices of turn ids.

A conversation is a row of turn ids. Rows are dealt out by ranges of their order; a task sorts its rows as a matrix, and
where a row differs from the one before it in a column or an earlier one, a node begins. All figures of a depth are
sums over the stretches between such places. Nodes that hold a task's first or last row may go on in the next task:
their parts are added up afterwards, together with what they hold of each other. Conversations of more than ``WIDTH``
turns are several rows, one a block of depths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from feedloom.llm.word_hashes import mixed
from feedloom.session import written

#: Depths that a row covers. Besides it has its parents' column and, to see children, the one behind.
WIDTH = 32
#: Turns that a task's matrix is made of, about.
SHARD_TURNS = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NOBODY = hashlib.sha256(b"").hexdigest()
_PARTS = (
    "kind int, key long, parent_key long, above array<long>, shard int, block int, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends string"
)


def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` (from 0), ``id`` and ``size`` of every turn of ``conversations``.

    Reads ``conv_id``, ``turn``, ``role`` and ``text``. Turns are ordered by number, null first; those of the same
    number by ``id``, so repeated rows are turns of their own. ``id`` is a 63-bit hash of role and text, null being
    empty, and ``size`` the text's UTF-8 bytes. Rows without a ``conv_id`` belong to no conversation. The rows are
    numbered within ranges of (conversation, turn), so a conversation may be of any length.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).bitwiseAND(F.lit(2**63 - 1)).alias("id"), F.octet_length(text).cast("long").alias("size"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            if not len(conv):
                continue
            start = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            at = np.arange(len(conv)) - np.repeat(start, np.diff(np.append(start, len(conv))))
            if conv[0] == last:
                at[: start[1] if len(start) > 1 else None] += seen
            last, seen = conv[-1], at[-1] + 1
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(conv), part), pa.int32()), pa.array(at), batch.column("id"), batch.column("size")], ["conv_id", "part", "at", "id", "size"])

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.mapInArrow(number, "conv_id long, part int, at long, id long, size long"), "turns")
    # Only a conversation that goes on in the next range, at most one a range, has turns in ranges before.
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.sum("n").over(before)).where("before is not null").select("conv_id", "part", "before")
    found = ranged.join(offsets, ["conv_id", "part"], "left")
    return found.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("position"), "id", "size")


def _blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The rows of all matrices: ``block``, ``prefix``, ``ids``, ``sizes`` and ``conv_id``.

    Block k holds the turns that lead to the depths from k * WIDTH - 1 to (k + 1) * WIDTH, as far as there are any;
    the root and a column before it stand for themselves. ``prefix`` tells what comes before apart.
    """
    depth = F.col("position") + 1
    items = turns.select("conv_id", depth.alias("depth"), "id", "size")
    none, above = F.lit(0).cast("long"), F.lit(-1).cast("long")
    tops = conversations.select("conv_id", F.explode(F.array(above, none)).alias("depth"), none.alias("id"), none.alias("size"))
    place = F.col("depth") + 1
    block = F.floor(place / WIDTH).cast("int")
    also = F.when((place % WIDTH < 2) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    items = items.union(tops).select("conv_id", "depth", "id", "size", F.explode(also).alias("block"))
    rows = items.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("depth", "id", "size"))).alias("items"))
    rows = rows.select("conv_id", "block", F.col("items.id").alias("ids"), F.col("items.size").alias("sizes"))
    rows = written(rows, "turn-blocks")
    long = rows.where("block = 1").select("conv_id")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    hashed = rows.join(long, "conv_id", "left_semi").select("conv_id", "block", F.xxhash64(F.slice("ids", 1, WIDTH), "block").alias("h"))
    prefixes = hashed.withColumn("prefix", F.bit_xor("h").over(earlier)).where("block > 0").drop("h")
    later = rows.where("block > 0").join(prefixes, ["conv_id", "block"])
    first = rows.where("block = 0").withColumn("prefix", F.lit(0).cast("long"))
    return written(first.unionByName(later), "trie-rows")


def _shard(rows: pa.Table, shard: int) -> Iterator[pa.RecordBatch]:
    """The nodes of one range of rows, column by column: whole ones (kind 0), parts (1) and the latter's ends (2)."""
    lists = rows.column("ids").combine_chunks()
    offset, lens = lists.offsets.to_numpy()[:-1], lists.value_lengths().to_numpy()
    ids, sizes = lists.values.to_numpy(), rows.column("sizes").combine_chunks().values.to_numpy()
    width = int(lens.max())
    matrix = np.full((len(lens), width + 2), -1, np.int64)
    matrix[:, 0], matrix[:, 1] = rows.column("block").to_numpy(), rows.column("prefix").to_numpy()
    filled = np.arange(width) < lens[:, None]
    matrix[:, 2:][filled] = ids[(offset[:, None] + np.arange(width))[filled]]
    conv = rows.column("conv_id").to_numpy()
    order = np.lexsort((conv, *matrix.T[::-1]))
    matrix, lens, conv, offset = matrix[order], lens[order], conv[order], offset[order]
    leaves, saved = (rows.column(c).to_numpy()[order] for c in ("carried_leaves", "carried_saved"))
    changed = np.ones(matrix.shape, bool)
    np.not_equal(matrix[1:], matrix[:-1], out=changed[1:])
    begins = np.logical_or.accumulate(changed, axis=1)[:, 2:]

    # Keys of the nodes on the way to the first and to the last row.
    key = np.empty((2, width), np.uint64)
    ends_of = matrix[[0, -1]].view(np.uint64)
    now = mixed(mixed(ends_of[:, 0] + _ODD) * _ODD + ends_of[:, 1])
    for c in range(width):
        now = key[:, c] = mixed(now * _ODD + ends_of[:, c + 2] + np.uint64(1))
    key = key.view(np.int64)

    names, texts = [f.split()[0] for f in _PARTS.split(", ")], conv.astype(str)
    inner = np.zeros(len(conv), np.int64)
    below: list = []
    for c in range(width - 1, -1, -1):
        start = np.flatnonzero(begins[:, c])
        convs = np.diff(np.append(start, len(conv)))
        least = np.minimum.reduceat(conv, start)
        children = np.add.reduceat(inner, start)
        real = lens[start] > c
        open_ = np.zeros(len(start), bool)
        open_[[0, -1]] = True
        whole, parts = np.flatnonzero(real & ~open_), np.flatnonzero(real & open_)
        size = np.where(real, sizes[offset[start] + np.minimum(c, lens[start] - 1)], 0)
        if c <= WIDTH:
            leaves[start[whole]] += children[whole] == 0
            saved[start[whole]] += (convs[whole] - 1) * size[whole]
        n_leaves, n_saved = np.add.reduceat(leaves, start), np.add.reduceat(saved, start)
        inner = np.zeros(len(conv), np.int64)
        inner[start[whole]] = 1
        # The children's parent is known now: its smallest member, or the key of a part.
        for child_start, batch in below:
            at = np.searchsorted(start, child_start, "right") - 1
            side = np.where(at == 0, 0, 1)
            batch["parent_conv_id"] = pa.array(least[at], mask=open_[at])
            batch["parent_key"] = pa.array(key[side, c], mask=~open_[at])
            yield pa.RecordBatch.from_pydict(batch, schema=_SCHEMA)
        below = []
        for kind, at in ((0, whole), (1, parts)):
            if not len(at) or (kind == 0 and not 1 <= c <= WIDTH):
                continue
            s = start[at]
            enders = np.add.reduceat(lens == c + 1, start)[at] if 1 <= c <= WIDTH else np.zeros(len(at), np.int64)
            listed = [",".join(texts[i : i + n]) if n else None for i, n in zip(s.tolist(), enders.tolist(), strict=True)]
            side = np.where(at == 0, 0, 1)
            batch = {
                "kind": np.full(len(at), kind), "key": key[side, c] if kind else pa.nulls(len(at), pa.int64()), "parent_key": None,
                "above": key[side, : c + 1].tolist() if kind else pa.nulls(len(at), pa.list_(pa.int64())), "shard": np.full(len(at), shard),
                "block": matrix[s, 0], "depth": matrix[s, 0] * WIDTH + c - 1, "conv_id": least[at], "parent_conv_id": None, "n_convs": convs[at],
                "n_children": children[at], "n_leaves": n_leaves[at], "saved_tokens": n_saved[at], "size": size[at],
                "ends": [hashlib.sha256(t.encode()).hexdigest() if t else _NOBODY for t in listed] if kind == 0 else pa.nulls(len(at), pa.string()),
            }
            below.append((s, batch))
            if kind and any(listed):
                some = [i for i, t in enumerate(listed) if t]
                blank = {n: pa.nulls(len(some), _SCHEMA.field(n).type) for n in names}
                yield pa.RecordBatch.from_pydict(blank | {"kind": np.full(len(some), 2), "key": key[side, c][some], "shard": np.full(len(some), shard), "ends": [listed[i] for i in some]}, schema=_SCHEMA)
    for _, batch in below:
        batch["parent_conv_id"] = batch["parent_key"] = pa.nulls(len(batch["kind"]), pa.int64())
        yield pa.RecordBatch.from_pydict(batch, schema=_SCHEMA)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
_SCHEMA = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in _PARTS.split(", ")])


def _joined_ends(parts: DataFrame) -> DataFrame:
    """``key`` and ``ends``: the digest of all lists of a key in the order of the shards, read one after the other."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            keys, found = [], []
            for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends"), strict=True):
                if key != last:
                    if state:
                        keys.append(last)
                        found.append(state.hexdigest())
                    last, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.string())], ["key", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([state.hexdigest()])], ["key", "ends"])

    dealt = parts.select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    return dealt.select("key", "ends").mapInArrow(digest, "key long, ends string")


def _nodes(rows: DataFrame) -> DataFrame:
    """All nodes of the rows; sums over subtrees within a block, and what the rows carry from deeper ones."""
    spark = rows.sparkSession
    turns = rows.agg(F.sum(F.size("ids"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if got:
            yield from _shard(pa.Table.from_batches(got), TaskContext.get().partitionId())

    found = written(rows.repartitionByRange(shards, "block", "prefix", "ids", "conv_id").mapInArrow(work, _PARTS), "trie-parts")
    pieces = found.where("kind = 1")
    merged = pieces.groupBy("key").agg(
        *[F.any_value(c).alias(c) for c in ("parent_key", "above", "block", "depth", "size")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = written(merged, "trie-merged")
    split = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("split_children")).where("key is not null")
    merged = merged.join(split, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("split_children", F.lit(0))).drop("split_children")
    # What a split node is itself counts for itself and all above it.
    inside = F.col("depth") < (F.col("block") + 1) * WIDTH
    own = merged.where(inside).select(F.explode("above").alias("key"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("more"))
    own = own.where("leaf > 0 or more > 0").groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("more").alias("more"))
    ends = _joined_ends(found.where("kind = 2"))
    merged = written(merged.join(own, "key", "left").join(ends, "key", "left"), "trie-split")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))

    names = ["block", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    split = merged.where(inside & (F.col("depth") >= F.col("block") * WIDTH)).join(parents, "parent_key", "left").withColumns({
        "parent_conv_id": F.when(F.col("depth") > 0, F.col("parent")), "n_leaves": F.col("n_leaves") + F.coalesce("leaf", F.lit(0)),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("more", F.lit(0)), "ends": F.coalesce("ends", F.lit(_NOBODY)),
    })
    whole = found.where("kind = 0")
    under = whole.where("parent_key is not null").join(parents, "parent_key").withColumn("parent_conv_id", F.col("parent"))
    return whole.where("parent_key is null").select(*names).union(under.select(*names)).union(split.select(*names))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (``conv_id``, ``position`` from 0 without gaps, ``id``, ``size``).

    ``conversations`` has each ``conv_id`` once, also of conversations without turns: they belong to the root alone.
    A node of depth d is a distinct sequence of d first turns; its members are the conversations that begin with it.
    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes in its subtree, itself included), ``saved_tokens`` (``size`` of the
    last turn times members but one, summed over its subtree) and ``ends_sha256`` (SHA-256 of the ids, in order and
    joined by commas, of the conversations that end here). Without conversations there is no node.

    No task holds more than its share of rows: equal conversations are told apart by their ids, so any number of
    copies lies in any number of ranges, and of a split node only its parts and its list of ends meet again.
    """
    rows = _blocks(turns, conversations)
    # What lies in deeper blocks is carried to the earlier rows of its smallest member, which are below all ancestors.
    deeper = rows.where("block > 0").withColumns({"carried_leaves": F.lit(0).cast("long"), "carried_saved": F.lit(0).cast("long")})
    totals = _nodes(deeper).where(F.col("depth") == F.col("block") * WIDTH).select("conv_id", "block", "n_leaves", "saved_tokens")
    places = rows.where("block > 0").select("conv_id", "block").union(rows.where("block = 1").select("conv_id", F.lit(0)))
    after = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = places.join(totals, ["conv_id", "block"], "left").select(
        "conv_id", "block", F.sum("n_leaves").over(after).alias("carried_leaves"), F.sum("saved_tokens").over(after).alias("carried_saved")
    )
    carried = written(carried.where("carried_leaves > 0 or carried_saved > 0"), "carried")
    rows = rows.join(carried, ["conv_id", "block"], "left").na.fill(0, ["carried_leaves", "carried_saved"])
    return _nodes(written(rows, "carrying")).drop("block")
