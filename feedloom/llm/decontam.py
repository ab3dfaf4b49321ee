"""Benchmark decontamination with spaced seeds: hashes over fixed masks that ignore some word positions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from feedloom.llm.text import word_count
from feedloom.llm.word_hashes import WordHasher, mixed, powers

#: Positions that count (1) in a window of words; a word that differs under a 0 leaves the hash as it is.
MASKS = ("111010011011", "110101110011", "101111001101")
SPAN = len(MASKS[0])
#: Items with fewer words are not looked for; those shorter than the masks must agree in every word.
MIN_WORDS = 8
#: An overlap counts from this many equal words on, or 90 % of an item that has fewer,
MIN_EQUAL = 13
#: if at least this share of its words are equal.
MIN_SHARE = 0.8
#: Words of test items that are looked for in one pass over the documents; more items take further passes.
BLOCK_WORDS = 500_000

#: Case, punctuation and white space do not count: words are runs of letters and digits.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


def _words(hasher: WordHasher, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return hasher.words(pc.utf8_lower(column))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window under the mask; window i begins at word i."""
    count = max(0, len(words) - len(mask) + 1)
    total = np.zeros(count, np.uint64)
    for j, p in enumerate(powers(0xD1B54A32D192ED03, len(mask))):
        if mask[j] == "1":
            total += words[j : j + count] * p
    return mixed(total + np.uint64(int(mask, 2)))


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, length and equal words of the stretch with most equal words of those with ``MIN_SHARE``, the first on a tie.

    ``equal`` says of every pair of words along a diagonal whether they are equal. The stretch begins and ends with
    equal words. A stretch has the share if the score, which falls by the share with every word and rises by 1 with an
    equal one, is not lower behind it than before it; so the first place with a score as low as that of an end is its
    best start, and one pass over the diagonal sees all stretches.
    """
    share = Fraction(MIN_SHARE).limit_denominator(1000)
    count = np.concatenate([[0], np.cumsum(equal)])
    score = count * share.denominator - np.arange(len(count)) * share.numerator
    first = np.searchsorted(-np.minimum.accumulate(score), -score, "left")
    end = int(np.argmax(count - count[first]))
    start = int(first[end])
    start += int(np.argmax(equal[start:end])) if end > start else 0
    return start, end - start, int(count[end] - count[start])


def along(doc: np.ndarray, item: np.ndarray, at: int, item_at: int, least: int) -> tuple[int, int, int, int] | None:
    """The best stretch of the whole diagonal of a hit: start in the document and the item, length, equal words.

    None if it has fewer than ``least`` equal words.
    """
    left, right = min(at, item_at), min(len(doc) - at, len(item) - item_at)
    equal = doc[at - left : at + right] == item[item_at - left : item_at + right]
    if np.count_nonzero(equal) < least:
        return None
    start, length, n = best_stretch(equal)
    return (at - left + start, item_at - left + start, length, n) if n >= least else None


@dataclass
class Seeds:
    """The seeds of one block of test items, sorted by hash, and the items' words."""

    items: list[np.ndarray]
    names: list[list]
    masks: list[str]
    hashes: list[np.ndarray]
    item: list[np.ndarray]
    place: list[np.ndarray]

    @classmethod
    def of(cls, ids: list, texts: pa.Array) -> Seeds:
        words, bounds = _words(WordHasher(SEPARATORS), texts)
        same: dict[bytes, list] = defaultdict(list)
        for name, start, end in zip(ids, bounds, bounds[1:], strict=False):
            if end - start >= MIN_WORDS:
                same[words[start:end].tobytes()].append(name)
        items = [np.frombuffer(b, np.uint64) for b in same]
        whole = ["1" * n for n in sorted({len(w) for w in items if len(w) < SPAN})]
        out = cls(items, list(same.values()), [], [], [], [])
        for mask in [*MASKS, *whole]:
            mine = [i for i, w in enumerate(items) if (len(w) >= SPAN if mask in MASKS else len(w) == len(mask))]
            found = [seeds(items[i], mask) for i in mine]
            if not found:
                continue
            hashes = np.concatenate(found)
            order = np.argsort(hashes, kind="stable")
            out.masks.append(mask)
            out.hashes.append(hashes[order])
            out.item.append(np.repeat(mine, [len(f) for f in found])[order])
            out.place.append(np.concatenate([np.arange(len(f)) for f in found])[order])
        return out

    def hits(self, words: np.ndarray, bounds: np.ndarray, table_bits: int = 20) -> Iterator[tuple[int, int, int, int]]:
        """Document, place in its words, item and place in the item of every hash that agrees, mask by mask."""
        shift = np.uint64(64 - table_bits)
        for mask, hashes, item, place in zip(self.masks, self.hashes, self.item, self.place, strict=True):
            table = np.zeros(1 << table_bits, bool)
            table[(hashes >> shift).astype(np.int64)] = True
            own = seeds(words, mask)
            at = np.flatnonzero(table[(own >> shift).astype(np.int64)])
            first, last = np.searchsorted(hashes, own[at], "left"), np.searchsorted(hashes, own[at], "right")
            at, first, last = at[last > first], first[last > first], last[last > first]
            doc = np.searchsorted(bounds, at, "right") - 1
            inside = at + len(mask) <= bounds[doc + 1]
            for d, a, f, t in zip(doc[inside].tolist(), at[inside].tolist(), first[inside].tolist(), last[inside].tolist(), strict=True):
                for k in range(f, t):
                    yield d, a - int(bounds[d]), int(item[k]), int(place[k])

    def overlaps(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """The best verified overlap of each document and item. A diagonal is judged as a whole, at its first hit."""
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        judged: set[tuple[int, int, int]] = set()
        for d, at, i, item_at in self.hits(words, bounds):
            line = (d, i, at - item_at)
            if line in judged:
                continue
            judged.add(line)
            item = self.items[i]
            found = along(words[bounds[d] : bounds[d + 1]], item, at, item_at, min(MIN_EQUAL, -(-len(item) * 9 // 10)))
            if found and ((d, i) not in best or (found[3], -found[0]) > (best[d, i][3], -best[d, i][0])):
                best[d, i] = found
        return best


def blocks(benchmark: DataFrame, words: int = BLOCK_WORDS) -> Iterator[Seeds]:
    """The test items (``item_id``, ``text``) in blocks of about ``words`` words, one after the other on the driver."""
    total = benchmark.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    count = max(1, -(-total // words))
    for b in range(count):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        rows = part.select(F.col("item_id").cast("string").alias("item_id"), "text").toArrow().combine_chunks()
        texts = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
        yield Seeds.of(rows.column("item_id").to_pylist(), texts)


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id``, ``item_id``, ``doc_start``, ``item_start``, ``n_words`` and ``n_equal`` of every verified overlap.

    Places count words from 0. Every document and item that overlap give one row, the overlap with most equal words,
    the first of them on a tie; repeated rows and repeated items give a row each. ``item_id`` is a string. Null and
    blank texts overlap with nothing; no documents or no items give no rows; other columns are not read.

    The test items are the query set: each block of them goes to every task and the documents stay where they are.
    """
    spark, out = docs.sparkSession, None
    schema = "doc_id long, item_id string, doc_start long, item_start long, n_words long, n_equal long"
    for block in blocks(benchmark, words):
        sent = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(SEPARATORS)
            for batch in batches:
                found = sent.value.overlaps(*_words(hasher, batch.column("text")))
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[d], name, *run) for (d, i), run in found.items() for name in sent.value.names[i]]
                if rows:
                    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"]
                    )

        one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, schema)
        out = one if out is None else out.union(one)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no test item; same columns, each row judged by its own text."""
    spark, text = docs.sparkSession, docs.columns.index("text")
    for block in blocks(benchmark, words):
        sent = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(SEPARATORS)
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                good[[d for d, _ in sent.value.overlaps(*_words(hasher, batch.column(text)))]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
