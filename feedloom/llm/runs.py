"""Periodic runs of words within whole texts, found by Lyndon roots.

A run is a maximal stretch that repeats with some period. Each run holds a Lyndon word as long as its period which is
the longest Lyndon word from its place on, under the order of words or under the reversed one. So every place gives two
candidates; each is extended to both sides as far as words one period apart are equal. The longest Lyndon words come
from the first phase of Baier's suffix sorter: groups of suffixes are gone through from the largest on, and whoever
stands directly before members of a group, and below it, takes their common start over and moves up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from feedloom.llm.word_hashes import WordHasher, grams, mixed, powers

#: Words of the shortest run.
MIN_LENGTH = 12
_BASE = 0x9E3779B97F4A7C15


def lyndon_lengths(letters: np.ndarray) -> np.ndarray:
    """Per place, how long the longest Lyndon word from there on is; letters are numbers from 0, and 0 ends a word.

    Baier's grouping. All places start in the group of their letter. From the largest group G down: a place's ``prev``
    is the last place before it whose group is lower; places that are ``prev`` of l members of G hold their word and l
    times that of G, so they leave their group for a new one right above it, larger l higher. A place passed on the
    way to ``prev`` is hidden afterwards, so all ways together are as long as the text.
    """
    text = letters.tolist()
    n, order = len(text), np.argsort(letters, kind="stable")
    count = np.bincount(letters, minlength=1)
    members = [part.tolist() for part in np.split(order, np.cumsum(count)[:-1])]
    size, length = count.tolist(), [1] * len(members)
    above, below = list(range(1, len(members) + 1)), list(range(-1, len(members) - 1))
    group, prev, done = text, [-1] * n, [False] * n
    now = len(members) - 1
    while now > 0:
        own = length[now]
        if size[now] == 1:
            place = next(i for i in members[now] if group[i] == now)
            j = place - 1
            while j >= 0 and done[j]:
                j = prev[j]
            prev[place], done[place] = j, True
            moves = [((-1, group[j]), [j])] if j >= 0 and group[j] else []
        else:
            pointing: dict[int, int] = {}
            places = [i for i in members[now] if group[i] == now]
            places.sort()
            for place in places:
                j = place - 1
                while j >= 0 and done[j]:
                    j = prev[j]
                prev[place], done[place] = j, True
                if j >= 0 and group[j]:
                    pointing[j] = pointing.get(j, 0) + 1
            parts: dict[tuple[int, int], list[int]] = {}
            for j, times in pointing.items():
                parts.setdefault((-times, group[j]), []).append(j)
            moves = sorted(parts.items())
        for (times, old), places in moves:
            grown = length[old] - times * own
            if size[old] == len(places):
                length[old] = grown
                continue
            new, top = len(members), above[old]
            members.append(places)
            size.append(len(places))
            size[old] -= len(places)
            length.append(grown)
            above.append(top)
            below.append(old)
            above[old] = below[top] = new
            for j in places:
                group[j] = new
        now = below[now]
    return np.array(length, np.int64)[group]


class Extensions:
    """How far two places of a text of 64-bit values agree, for many pairs at once, by hashes of all its prefixes.

    Where it says that they stop to agree they differ; whether they agree so far is to be verified.
    """

    def __init__(self, values: np.ndarray):
        self.values, self.n = values, len(values)
        self.up = powers(_BASE, self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * self.up[: self.n], out=self.sums[1:])

    def _same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[a + length] - self.sums[a]) * self.up[b - a] == self.sums[b + length] - self.sums[b]

    def agree(self, a: np.ndarray, b: np.ndarray, backwards: bool) -> np.ndarray:
        """Equal values from ``a`` and ``b`` on, or before them; a < b."""
        low, high = np.zeros(len(a), np.int64), a.copy() if backwards else self.n - b
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            at = middle if backwards else 0
            same = self._same(a - at, b - at, middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low


def _extended(values: np.ndarray, places: np.ndarray, periods: np.ndarray, min_length: int) -> Iterator[tuple[int, int, int]]:
    """Runs (start, length, period) that the roots at these places belong to; the last value must be a unique one."""
    fits = places + periods < len(values)
    places, periods = places[fits], periods[fits]
    # A run is two periods long, so the words before or behind the root go on with it.
    inside = places > 0
    near = (values[places] == values[places + periods]) | (inside & (values[places - inside] == values[places - inside + periods]))
    places, periods = places[near], periods[near]
    texts = Extensions(values)
    behind = texts.agree(places, places + periods, False)
    before = texts.agree(places, places + periods, True)
    start, length = places - before, before + periods + behind
    whole = length >= np.maximum(min_length, 2 * periods)
    runs = np.stack([start, length, periods], 1)[whole]
    different, which = np.unique(runs, axis=0, return_inverse=True)
    for i, (s, n, q) in enumerate(different.tolist()):
        if np.array_equal(values[s : s + n - q], values[s + q : s + n]):
            yield s, n, q
            continue
        # Equal hashes of different stretches: the roots are extended word by word.
        for place in places[whole][which.ravel() == i].tolist():
            unequal = np.append(np.flatnonzero(values[:-q] != values[q:]), len(values) - q)
            k = int(np.searchsorted(unequal, place))
            s = int(unequal[k - 1]) + 1 if k else 0
            n = int(unequal[k]) + q - s
            if n >= max(min_length, 2 * q):
                yield s, n, q


def runs_of(values: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """All runs (start, length, period), by start and period, of each text; ``values`` has the words of all texts.

    Words of a run stand in a stretch of half of ``min_length`` words that occurs a second time in the text: only such
    words are looked at. The texts' stretches of them are searched together, with an end mark behind each.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in bounds[1:]]
    size = -(-min_length // 2)
    tokens = grams(values, size)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    last = bounds[1:][text[: len(tokens)]] if len(tokens) else np.empty(0, np.int64)
    starts = np.flatnonzero(np.arange(len(tokens)) + size <= last)
    if not len(starts):
        return found
    tokens = tokens[starts] ^ mixed(text[starts].astype(np.uint64) + np.uint64(1))
    _, kind, often = np.unique(tokens, return_inverse=True, return_counts=True)
    starts = starts[often[kind] > 1]
    change = np.zeros(len(values) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    at = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if not len(at):
        return found
    first = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (text[at[1:]] != text[at[:-1]])]))
    # Stretch k is moved by k places, since an end mark goes behind each of the stretches before.
    stretch = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
    marks = np.append(first[1:], len(at)) + np.arange(len(first))
    joined = np.empty(len(at) + len(first), np.uint64)
    joined[marks] = mixed(np.arange(len(first), dtype=np.uint64) + np.uint64(1 << 40))
    joined[np.arange(len(at)) + stretch] = values[at]
    origin = np.empty(len(joined), np.int64)
    origin[np.arange(len(at)) + stretch], origin[marks] = at, -1
    _, letters = np.unique(values[at], return_inverse=True)
    runs = set()
    for sign in (1, -1):
        ranked = np.zeros(len(joined), np.int64)
        ranked[np.arange(len(at)) + stretch] = letters + 1 if sign > 0 else letters.max() + 1 - letters
        lengths = lyndon_lengths(ranked)
        places = np.flatnonzero(origin >= 0)
        runs.update(_extended(joined, places, lengths[places], min_length))
    for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])):
        t = text[origin[s]]
        found[t].append((int(origin[s] - bounds[t]), n, q))
    return found


def _case_kept() -> WordHasher:
    hasher = WordHasher()
    hasher.value = mixed(np.arange(1001, 1257, dtype=np.uint64) * np.uint64(_BASE))
    return hasher


def periodic_runs(docs: DataFrame, keep: Sequence[str], min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc`` (struct of ``keep``), ``n_words``, ``runs`` and ``collapsed`` of every row of ``docs`` (``text``).

    ``runs`` lists start, length and period, in words, of every run by start and period: at least ``min_length`` and
    two periods long, with its smallest period, extended as far as it goes. ``collapsed`` has the words that no run
    holds behind its first period, joined by blanks. Words are separated by ASCII white space and compared as they
    are. Null, empty and blank texts have no words. Repeated rows are rows like any others, other columns may have
    any name. A text is searched whole in one task: time and memory grow with its words, which are compared by
    64-bit hashes.
    """
    schema = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")).schema
    schema = schema.add("n_words", "long").add("runs", T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))).add("collapsed", "string")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _case_kept()
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            hashes, bounds = hasher.words(batch.column("text"))
            found, collapsed = runs_of(hashes, bounds, min_length), []
            for raw, runs in zip(column, found, strict=True):
                words = (raw.as_py() or b"").split()
                if runs:
                    drop = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in runs:
                        drop[start + period] += 1
                        drop[start + length] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
                collapsed.append(b" ".join(words))
            runs = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], pa.list_(run))
            text = pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(np.diff(bounds), pa.int64()), runs, text], ["doc", "n_words", "runs", "collapsed"])

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), "text").mapInArrow(search, schema)
