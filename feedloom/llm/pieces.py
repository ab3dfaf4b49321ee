"""SentencePiece ids of whole texts by a table of prefixes, and back to text.

The vocabulary is of the merge type: neighbours whose joined text is a piece merge, the best score first, the leftmost
of equals. An encoding is therefore right if every two neighbouring tokens stay as they are when they alone are merged,
and every prefix of a text has exactly one token that its encoding ends with. Going through a text, the pieces of an
automaton that end at a character are held against the last token of the prefix before them; the first compatible one
is stored. The ids are then read from the end backwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

SPACE = "▁"
#: Bytes of remembered encodings and pair tests of a task; beyond it all are forgotten.
MEMO_BYTES = 160_000_000
#: The rank of symbols that do not merge.
NEVER = float("inf")
#: What stands in the table for a character of no piece. It merges with nothing.
ALONE = -1
#: Characters of stretches that are worth remembering.
LONG = 100


class PrefixEncoder:
    """Encodes texts exactly as the sentencepiece library does with a BPE model, given as its file's bytes.

    Only models without normalisation rules are read: blanks become ``SPACE``, one goes before a text that is not
    empty. Characters outside the vocabulary become one token a byte and merge with nothing. Texts are cut where no
    piece of the vocabulary can reach across, and a stretch seen before is looked up.
    """

    def __init__(self, model: bytes, memo_bytes: int = MEMO_BYTES):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        if self.library.encode(f"  ﬁ  {SPACE}x", out_type=str)[:2] != [SPACE, " "] or self.library.encode(""):
            raise ValueError("the model normalises its texts")
        n = self.library.get_piece_size()
        if any(self.library.is_unused(i) for i in range(n)):
            raise ValueError("the model has pieces that are not to be used")
        special = [self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i) for i in range(n)]
        self.piece = [self.library.id_to_piece(i) for i in range(n)]
        self.rank = {p: -self.library.get_score(i) for i, p in enumerate(self.piece) if not special[i]}
        self.id = {p: i for i, p in enumerate(self.piece) if not special[i]}
        self.byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not self.library.is_byte(i) for i in self.byte):
            raise ValueError("the model has no token for every byte")
        self.steps = {i: self._steps(p) for p, i in self.id.items()}
        self.length = list(map(len, self.piece))
        self.pieces = ahocorasick.Automaton()
        for p, i in self.id.items():
            # A token that its own merges do not lead to is never chosen.
            if self.steps[i][-1][1] == p:
                self.pieces.add_word(p, i)
        self.pieces.make_automaton()
        # Where no piece has a blank behind something else, a text may be cut before its blanks; and around characters
        # of no piece. Line ends are such a character.
        inner = any(SPACE in p.lstrip(SPACE) for p in self.id)
        alone = "\n" if not any("\n" in p for p in self.id) else ""
        self.stretch = re.compile(r"(?s).+" if inner else rf"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}+" if alone else ""))
        self.memo_bytes = memo_bytes
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.room = self.memo_bytes

    def _steps(self, piece: str) -> list[tuple[float, str, str]]:
        """How a piece's characters merge: before each merge its rank, the first and the last symbol; then those left."""
        symbols, steps = list(piece), []
        rank = self.rank.get
        while True:
            ranks = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = min(ranks, default=NEVER)
            steps.append((best, symbols[0], symbols[-1]))
            if best == NEVER:
                return steps
            i = ranks.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when the characters of both merge.

        As long as nothing merges across, both go through their own steps, the lower rank first. They stay apart if at
        no time the two symbols that meet rank before the next step of either; of equal ranks the leftmost goes first.
        """
        ours, theirs, rank = self.steps[left], self.steps[right], self.rank.get
        i = j = 0
        while True:
            (l, _, last), (r, first, _) = ours[i], theirs[j]
            across = rank(last + first, NEVER)
            if across < l and across <= r and across != NEVER:
                return False
            if l == r == NEVER:
                return True
            i, j = (i + 1, j) if l <= r else (i, j + 1)

    def last_tokens(self, text: str) -> list[int]:
        """Per prefix of ``text``, the empty one first, the last token of its encoding; ALONE for a character of no piece.

        The automaton gives its matches by their ends, so the prefix before a match is settled when it comes.
        """
        table, pairs, length = [ALONE] * (len(text) + 1), self.pairs, self.length
        for end, token in self.pieces.iter(text):
            end += 1
            if table[end] != ALONE:
                continue
            before = table[end - length[token]]
            if before != ALONE:
                pair = before << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self._compatible(before, token)
                    self.room -= 150
                if not fits:
                    continue
            table[end] = token
        return table

    def stretch_ids(self, text: str) -> list[int]:
        """The ids of a stretch of text whose blanks are ``SPACE``, read from the table backwards."""
        table, ids, end, length = self.last_tokens(text), [], len(text), self.length
        while end:
            token = table[end]
            if token == ALONE:
                ids += [self.byte[b] for b in reversed(text[end - 1].encode())]
                end -= 1
            else:
                ids.append(token)
                end -= length[token]
        ids.reverse()
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        if self.room < 0:
            self._forget()
        parts, known = self.stretch.findall(SPACE + text.replace(" ", SPACE)), self.known
        found = list(map(known.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i]
                    ids = known.get(part)
                    if ids is None:
                        ids = np.array(self.stretch_ids(part), np.int32).tobytes()
                        if len(part) <= LONG:
                            known[part] = ids
                            self.room -= 250 + 2 * len(part) + len(ids)
                    found[i] = ids
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """What the library makes of the ids."""
        return self.library.decode(ids.tolist()) if len(ids) else ""


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    """The texts of a batch one at a time; null is empty, bytes that are not UTF-8 are U+FFFD."""
    return ((t.as_py() or b"").decode("utf-8", "replace") for t in batch.column("text").cast(pa.binary()))


def encode_texts(docs: DataFrame, model: bytes, keep: Sequence[str]) -> DataFrame:
    """``doc`` (struct of ``keep``), ``ids`` and ``decoded``, the library's decoding of them, of every row of ``docs``.

    Null and empty texts have no ids and decode to the empty text. Texts are encoded whole, one at a time; repeated
    rows and rows without an id are rows like any others; other columns may have any name. ``model`` is the content of
    a model file (half a megabyte for 32,000 pieces); it goes to the tasks, so executors need no file of it.
    """
    read = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PrefixEncoder(sent.value)
        for batch in batches:
            ids = [encoder.encode(t) for t in _texts(batch)]
            columns = [batch.column("doc"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(encoder.decode, ids), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "ids", "decoded"])

    return read.mapInArrow(encode, read.select("doc").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string"))
