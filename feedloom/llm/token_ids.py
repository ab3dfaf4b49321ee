"""Token ids of whole texts from a public vocabulary file, one pre-tokenized piece at a time."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

MEMO_BYTES = 96_000_000

#: The splitting rules, as they stand in a vocabulary file, that PIECE, ODD and the end-of-word mark follow.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
MARK = "</w>"
#: The vocabulary's own rule for pieces, for lower-case ASCII and Latin-1 characters.
LETTER, NUMBER = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
#: All pieces but runs of letters, which are what lies between them.
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|[{NUMBER}]|[^\x09-\x0d\x20{LETTER}{NUMBER}]+"
#: Characters outside of these, and the opening of a special token.
ODD = r"[^\x09-\x0d\x20-\x7e¡-ÿ]|<\|"
#: Pieces of letters that are encoded together.
GROUP = 200


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file, read on the driver: it goes to the tasks as a value, not as a path."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def send_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary's text for the tasks, which get their encoder of it from ``encoder_of``."""
    return spark.sparkContext.broadcast({"vocabulary": read_vocabulary(path)})


def encoder_of(sent: Broadcast) -> PieceEncoder:
    """The encoder of a vocabulary sent: one for all tasks that a Python worker runs, kept with its copy of the value.

    The memory that an encoder takes does not all come back when it goes, so one a task adds up. Spark drops the copy
    when the worker goes on to tasks that do not read it.
    """
    held = sent.value
    if "encoder" not in held:
        held["encoder"] = PieceEncoder(held["vocabulary"])
    return held["encoder"]


def cut_in_pieces(vocabulary: str) -> bool:
    """Whether a vocabulary (the text of its file) has the splitting rules that texts are cut by here."""
    rules = json.loads(vocabulary)
    model = rules["model"]
    return (
        rules["normalizer"] == NORMALIZER
        and rules["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
        and (model["type"], model["end_of_word_suffix"]) == ("BPE", MARK)
        and not (model["dropout"] or model["continuing_subword_prefix"] or rules["truncation"] or rules["padding"])
        and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in rules["added_tokens"])
    )


class PieceEncoder:
    """Encodes texts with a lower-casing word-piece vocabulary (``word_bpe_49k.json``), given as the text of its file.

    No piece of its pre-tokenizer crosses white space, so the ids of a text are those of its pieces one after the
    other. Texts without ``ODD`` characters are cut by ``PIECE`` and each different piece of a batch is looked up
    once; of other texts each word is given to the tokenizer as it is. New pieces of letters are encoded many at a
    time: each ends with the one id that carries the end-of-word mark. What is remembered is bounded by ``memo_bytes``
    and forgotten as a whole beyond it. Null texts have no ids; bytes that are not UTF-8 count as U+FFFD.

    A vocabulary with other splitting rules is given each text whole.
    """

    def __init__(self, vocabulary: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(vocabulary)
        pieces = self.whole.get_vocab(with_added_tokens=True)
        self.size, self.in_pieces = max(pieces.values()) + 1, cut_in_pieces(vocabulary)
        self.memo_bytes = self.room = memo_bytes
        self.known: dict[str, bytes] = {}
        if not self.in_pieces:
            return
        # For pieces that are lower-case letters already: the same model, in memory once, behind white space alone.
        self.model = Tokenizer(self.whole.model)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for token, i in pieces.items() if token.endswith(MARK)]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a string column, and where those of each row begin and end."""
        texts = self._valid(texts)
        if not self.in_pieces:
            packed = [self._alone(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(packed), "<u4"), np.cumsum([0, *[len(p) // 4 for p in packed]])
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        pieces = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(plain), PIECE, r" \0 "))
        rows = pieces.offsets.to_numpy()
        coded = pieces.values.slice(rows[0], rows[-1] - rows[0]).dictionary_encode()
        packed = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes, lengths = coded.indices.to_numpy(), np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        pool = np.frombuffer(b"".join(packed), "<u4")
        counts = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(lengths) - lengths)[codes] - ends[:-1]
        ids, bounds = pool[np.repeat(shift, counts) + np.arange(ends[-1])], ends[rows - rows[0]]
        if not odd.any():
            return ids, bounds
        parts = [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for i in np.flatnonzero(odd).tolist():
            parts[i] = np.frombuffer(b"".join(map(self._word, pc.ascii_split_whitespace(texts[i]).as_py())), "<u4")
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    @staticmethod
    def _valid(texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("")
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in texts.cast(pa.binary()).to_pylist()], pa.string())
        return texts

    def _ids(self, pieces: list[str]) -> list[bytes]:
        new = [p for p in pieces if p not in self.known]
        if 250 * len(new) + sum(map(len, new)) > self.room:
            self.known, self.room, new = {}, self.memo_bytes, pieces
        letters = [p for p in new if p.isalpha()]
        groups = [letters[i : i + GROUP] for i in range(0, len(letters), GROUP)]
        for group, found in zip(groups, self.model.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            packed, start = ids.tobytes(), 0
            for piece, end in zip(group, ends.tolist(), strict=True):
                self.known[piece] = packed[start:end]
                start = end
        self.known.update((p, self._alone(p)) for p in new if not p.isalpha())
        self.room -= 200 * len(new) + 3 * sum(map(len, new))
        return [self.known[p] for p in pieces]

    def _alone(self, word: str) -> bytes:
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word with odd characters; remembered under its own spelling, which no plain piece has."""
        key = f" {word}"
        if key not in self.known:
            if self.room < 0:
                self.known, self.room = {}, self.memo_bytes
            self.known[key] = self._alone(word)
            self.room -= 200 + 3 * len(word)
        return self.known[key]
