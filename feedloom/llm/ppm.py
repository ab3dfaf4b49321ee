"""Prediction by partial matching over bytes, trained on one part of the corpus and scoring all of it.

The trie of byte contexts is a table of windows (a context and the byte after it) with counts; shorter contexts are
sums of longer ones. The score of a text is a sum over its windows: the most frequent windows, a bounded number, go to
every task, and the rare rest is looked up by a join. Words of the unigram base score go the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.word_hashes import WordHasher
from feedloom.session import written

#: Bytes of context.
ORDER = 5
#: Bytes that are worked on at a time, in whole documents.
SLICE_BYTES = 2_000_000
#: Windows, and words, that go to every task: the most frequent ones. All others are joined.
TABLE = 600_000
#: Different keys that a task counts before it passes them on.
HELD = 2_000_000
#: Stand for the time before a text and its end; neither occurs in UTF-8.
BEFORE, END = 0xFE, 0xFF
SYMBOLS = 256
WINDOW, WORD = 0, 1

LN10 = math.log(10)


class Lookup:
    """Places of numbers in a sorted array: by a hash table first, by bisection where two numbers share a slot.

    A number that is not there gets some place; compare with ``keys``.
    """

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slots[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, asked: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(asked)]
        missed = np.flatnonzero(self.keys[at] != asked)
        at[missed] = np.minimum(np.searchsorted(self.keys, asked[missed]), len(self.keys) - 1)
        return at


class Reader:
    """Words and byte windows of texts with A-Z as a-z and one blank between words."""

    def __init__(self, order: int = ORDER):
        self.order, self.hasher = order, WordHasher()
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes, bounds = self.hasher.words(texts)
        return hashes.view(np.int64), bounds

    def windows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A number for each byte and end with the ``order`` bytes before it, and where those of each text begin."""
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        at = at - at[0]
        inside = ~self.hasher.gap[raw]
        # The gap byte after a word stands for the blank, if a word of the same text follows.
        count = np.concatenate([[0], np.cumsum(inside)])
        last = np.repeat(count[at[1:]], np.diff(at))
        blank = np.zeros(len(raw), bool)
        blank[1:] = inside[:-1] & ~inside[1:]
        blank[at[:-1][at[:-1] < len(raw)]] = False
        blank &= count[1:] < last
        kept = inside | blank
        sizes = np.diff(np.concatenate([[0], np.cumsum(kept)])[at])
        pad = self.order
        starts = np.concatenate([[0], np.cumsum(sizes + pad + 1)])
        stream = np.full(starts[-1], BEFORE, np.uint8)
        shift = np.repeat(starts[:-1] + pad - (np.cumsum(sizes) - sizes), sizes)
        stream[np.arange(len(shift)) + shift] = np.where(blank, np.uint8(32), self.lower[raw])[kept]
        stream[starts[1:] - 1] = END
        keys = np.zeros(len(stream) - pad if len(stream) else 0, np.int64)
        for j in range(pad + 1):
            keys = (keys << 8) | stream[j : j + len(keys)]
        real = stream[pad:] != BEFORE
        return keys[real], np.concatenate([[0], np.cumsum(sizes + 1)])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[slice, pa.Array]]:
    """The texts of a batch in runs of about ``SLICE_BYTES``; null texts are empty."""
    texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        yield slice(first, last), texts.slice(first, last - first)
        first = last


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and summed counts of several sorted lists."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _counted(keys: np.ndarray, bounds: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of some texts, and how often each occurs in those that are trained on."""
    every = np.unique(keys)
    own, counts = np.unique(keys[np.repeat(train, np.diff(bounds))], return_counts=True)
    out = np.zeros(len(every), np.int64)
    out[np.searchsorted(every, own)] = counts
    return every, out


def key_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``kind``, ``key`` and ``n``: all windows and words of ``docs`` (``train``, ``text``) with their training counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(order)
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WINDOW: [], WORD: []}

        def flush(kind: int) -> Iterator[pa.RecordBatch]:
            keys, n = _merged(held[kind]) if held[kind] else (np.empty(0, np.int64),) * 2
            held[kind] = []
            for a in range(0, len(keys), 1 << 16):
                k = keys[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k), pa.array(n[a : a + (1 << 16)])], ["kind", "key", "n"])

        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for part, texts in _slices(batch):
                for kind, found in ((WINDOW, reader.windows(texts)), (WORD, reader.words(texts))):
                    held[kind].append(_counted(*found, train[part]))
                    if sum(len(k) for k, _ in held[kind]) > HELD:
                        held[kind] = [_merged(held[kind])]
                        if len(held[kind][0][0]) > HELD // 2:
                            yield from flush(kind)
        for kind in held:
            yield from flush(kind)

    return docs.select("train", "text").mapInArrow(count, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def window_scores(windows: DataFrame, order: int = ORDER) -> DataFrame:
    """``windows`` (``key``, training count ``n``) with ``value``, the log10 probability of each.

    At a context with total T and D different followers, a follower with count c has c / (T + D) and the escape to the
    next shorter context D / (T + D). There all followers of the longer context are excluded: they all follow the
    shorter one too, so what is left of T and D is a difference of two sums, and the excluded mass is a property of
    the longer context. Contexts that were never seen are passed over. After the empty context, what is left of the
    ``SYMBOLS`` is equally likely.
    """

    def low(key: Column, k: int) -> Column:
        return key.bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))

    counts = {order: written(windows.where("n > 0").select("key", F.col("n").alias("c")), f"order-{order}")}
    for k in range(order - 1, -1, -1):
        summed = counts[k + 1].groupBy(low(F.col("key"), k).alias("key")).agg(F.sum("c").alias("c"))
        counts[k] = written(summed, f"order-{k}")
    scored = windows.select("key", "n", *[low(F.col("key"), k).alias(f"key{k}") for k in range(order + 1)])
    for k in range(order + 1):
        scored = scored.join(counts[k].select(F.col("key").alias(f"key{k}"), F.col("c").alias(f"c{k}")), f"key{k}", "left")
        if k:
            below = counts[k - 1].select(F.col("key").alias("parent"), F.col("c").alias("below"))
            both = counts[k].join(below, low(F.col("key"), k - 1) == F.col("parent"))
            nodes = both.groupBy(F.shiftright("key", 8).alias(f"context{k}")).agg(
                F.sum("c").alias(f"t{k}"), F.count(F.lit(1)).alias(f"d{k}"), F.sum("below").alias(f"x{k}")
            )
            scored = scored.withColumn(f"context{k}", F.shiftright(f"key{k}", 8)).join(nodes, f"context{k}", "left")
    t0, d0 = counts[0].agg(F.sum("c"), F.count(F.lit(1))).first()
    t0, d0 = t0 or 0, d0 or 0

    def value(name: str, k: int) -> Column:
        return F.col(f"{name}{k}") if k else F.lit(t0 if name == "t" else d0)

    def step(k: int, gone: Column | None) -> Column:
        """Log probability at order k. ``gone``: whether the context one longer was seen and escaped from."""
        if k < 0:
            left = F.lit(float(SYMBOLS)) - (F.lit(d0) if t0 else F.lit(0))
            return -F.ln(F.greatest(left, F.lit(1.0)))
        total, distinct = value("t", k), value("d", k)
        if gone is not None:
            total = total - F.when(gone, F.col(f"x{k + 1}")).otherwise(0)
            distinct = distinct - F.when(gone, F.col(f"d{k + 1}")).otherwise(0)
        seen = value("t", k) > 0 if k else F.lit(t0 > 0)
        seen = F.coalesce(seen, F.lit(False))
        found = F.ln(F.col(f"c{k}")) - F.ln(total + distinct)
        escape = F.when(distinct > 0, F.ln(distinct) - F.ln(total + distinct)).otherwise(0.0)
        return F.when(F.col(f"c{k}").isNotNull(), found).when(seen, escape + F.col(f"after{k}")).otherwise(F.col(f"after{k}"))

    # From the empty context upwards: after{k} is what follows once order k has been left.
    for k in range(order + 1):
        gone = F.coalesce(F.col(f"t{k}") > 0, F.lit(False)) if k else F.lit(t0 > 0)
        scored = scored.withColumn(f"after{k}", step(k - 1, gone if k else None))
    return scored.select("key", "n", (step(order, None) / LN10).alias("value"))


def _frequent(values: DataFrame, most: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and values of the most frequent windows and words, at most ``most`` of each.

    Counts are compared exactly up to 1,000 and by thousandths of a decade above, so the driver sees some thousand
    levels, and all keys of a level are in or out.
    """
    level = F.when(F.col("n") < 1000, F.col("n")).otherwise(F.floor(F.log10("n") * 1000))
    levels, found = values.withColumn("level", level), {}
    sizes = levels.groupBy("kind", "level").agg(F.count(F.lit(1)).alias("keys")).orderBy(F.col("level").desc()).collect()
    for kind in (WINDOW, WORD):
        room, least = most, None
        for r in sizes:
            if r.kind == kind:
                room -= r["keys"]
                if room < 0:
                    break
                least = r.level
        kept = F.col("level") >= least if least is not None else F.lit(False)
        rows = levels.where((F.col("kind") == kind) & kept).select("key", "value").toArrow()
        keys, held = rows.column("key").to_numpy(), rows.column("value").to_numpy()
        order = np.argsort(keys)
        found[kind] = keys[order], held[order]
    return found


def score(docs: DataFrame, train: Column, order: int = ORDER, table: int = TABLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words with A-Z as a-z, then one end. ``base_score`` is the smoothed unigram score of the tokens,
    ``score`` the log10 probability of the words with one blank between them and the end, byte by byte. Null texts
    are empty. Rows where ``train`` is not true teach nothing; without any that is, all bytes are equally likely.
    Repeated rows count and are scored each; other columns are not read; no rows give none.

    The keys that are joined are those too rare for the ``table``, so none of them is hot, and no text is shuffled.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    totals = written(key_counts(read, order), "totals")
    words = totals.where(F.col("kind") == WORD).select("kind", "key", "n", F.col("n").cast("double").alias("value"))
    windows = totals.where(F.col("kind") == WINDOW).select("key", "n")
    scored = window_scores(windows, order).select(F.lit(WINDOW).cast("byte").alias("kind"), "key", "n", "value")
    values = written(words.union(scored), "values")
    ends = read.agg(F.count_if("train")).first()[0]
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    n, v = tokens + ends, kinds + (ends > 0)
    floor = n + 0.1 * (v + 1)
    sent = spark.sparkContext.broadcast(_frequent(values, table))
    of_end = math.log10((ends + 0.1) / floor)
    schema = "row long, doc_id long, train boolean, n_tokens long, n_known long, base double, score double, kind byte, key long"
    arrow = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("kind", pa.int8()), ("key", pa.int64())])

    def sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x)])
        return total[bounds[1:]] - total[bounds[:-1]]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, row = Reader(order), TaskContext.get().partitionId() << 40
        tables = {kind: (Lookup(keys), held) for kind, (keys, held) in sent.value.items()}

        def known(kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            lookup, held = tables[kind]
            if not len(held):
                return np.zeros(len(keys), bool), np.zeros(len(keys))
            at = lookup.find(keys)
            hit = lookup.keys[at] == keys
            return hit, np.where(hit, held[at], 0.0)

        for batch in batches:
            for part, texts in _slices(batch):
                rows = np.arange(row, row + len(texts))
                row += len(texts)
                keys, at = reader.windows(texts)
                hit, bits = known(WINDOW, keys)
                words, to = reader.words(texts)
                found, counts = known(WORD, words)
                base = np.where(found, np.log10((counts + 0.1) / floor), 0.0)
                size = np.diff(to) + 1
                columns = {"row": rows, "doc_id": batch.column("doc_id").slice(part.start, len(rows)), "train": batch.column("train").slice(part.start, len(rows)), "n_tokens": size}
                columns |= {"n_known": sums((counts > 0).astype(np.int64), to) + (ends > 0), "base": sums(base, to) + of_end, "score": sums(bits, at)}
                yield _filled(columns, arrow)
                for kind, keys, bounds, hit in ((WINDOW, keys, at, hit), (WORD, words, to, found)):
                    rare = {"row": np.repeat(rows, np.diff(bounds))[~hit], "key": keys[~hit]}
                    yield _filled(rare | {"kind": np.full(len(rare["key"]), kind, np.int8)}, arrow)

    rated = written(read.mapInArrow(rate, schema), "rated")
    rare = rated.where(F.col("kind").isNotNull()).select("row", "kind", "key").join(values.drop("n"), ["kind", "key"])
    is_word = F.col("kind") == WORD
    more = rare.groupBy(F.col("row").alias("r")).agg(
        F.sum(F.when(~is_word, F.col("value")).otherwise(0.0)).alias("more_score"),
        F.sum(F.when(is_word, F.log10((F.col("value") + 0.1) / floor)).otherwise(0.0)).alias("more_base"),
        F.count_if(is_word & (F.col("value") > 0)).alias("more_known"),
    )
    rows = rated.where(F.col("kind").isNull()).join(more, F.col("row") == F.col("r"), "left").fillna(0, ["more_score", "more_base", "more_known"])
    return rows.select(
        "doc_id", "train", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more_base")).alias("base_score"), (F.col("score") + F.col("more_score")).alias("score"),
    )


def _filled(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of a wider schema; the columns that are not given are null."""
    n = len(next(iter(columns.values())))
    arrays = [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)
