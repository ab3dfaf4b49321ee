"""64-bit hashes of the words of Arrow text columns, computed for whole batches on their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at a time; a single word may be longer.
SLICE = 1 << 20
_ODD = 0x9E3779B97F4A7C15


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """Hashes words with A-Z as a-z. A word is a run of bytes outside ``separators``, within one row.

    The hash of a word is the polynomial of its bytes, each replaced by a fixed random number, modulo 2^64: a
    difference of prefix sums times an inverse power, then mixed with the length.
    """

    def __init__(self, separators: bytes = b" \t\n\x0b\x0c\r"):
        self.gap = np.isin(np.arange(256), list(separators))
        self.value = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
        self.value[65:91] = self.value[97:123]
        self._tables(SLICE)

    def _tables(self, n: int) -> None:
        self.up, self.down = powers(_ODD, n), powers(pow(_ODD, -1, 1 << 64), n)

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All words of a text column, and where those of each row begin and end; null rows have none."""
        column = column.cast(pa.large_binary()).fill_null(b"")
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        if not len(column) or at[-1] == at[0]:
            return np.empty(0, np.uint64), np.zeros(len(column) + 1, np.int64)
        raw, at = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]
        inside = ~self.gap[raw]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cuts = at[(at > 0) & (at < len(raw))]
        start[cuts] |= inside[cuts]
        end[cuts - 1] |= inside[cuts - 1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        hashes, i = np.empty(len(starts), np.uint64), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, "right")))
            hashes[i:j] = self._slice(raw[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
            i = j
        return hashes, np.searchsorted(starts, at)

    def _slice(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(raw) > len(self.up):
            self._tables(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * self.up[: len(raw)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; run i begins at word i."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for j, p in enumerate(powers(_ODD ^ 0x5555, n)):
        total += words[j : j + count] * p
    return mixed(total + np.uint64(n))
