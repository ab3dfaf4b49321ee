"""Language identification with a string kernel: n-gram presence, Nystroem landmarks, one-versus-rest ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from feedloom.session import written

#: Lengths of the character n-grams whose presence the kernel blends.
ORDERS = (1, 2, 3)
#: Labelled texts per language that the classifier is fitted on: the first by hash of the text.
SAMPLE = 256
#: Texts of that sample per language that serve as landmarks.
LANDMARKS = 32
RIDGE = 1e-3
UNKNOWN = "und"

_WIDTH = 21


def ngram_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct n-grams of every text, as numbers; none where there is no letter.

    Upper case counts as lower case, and what lies between words as one blank. An n-gram is its code points in 21 bits
    each, so different n-grams have different numbers.
    """
    lower = pc.utf8_lower(texts.fill_null(""))
    lettered = pc.match_substring_regex(lower, r"\pL").to_pylist()
    words = pc.replace_substring_regex(lower, r"[^\pL\pM]+", " ").to_pylist()
    sets = []
    for text, some in zip(words, lettered, strict=True):
        points = np.frombuffer(f" {text.strip()} ".encode("utf-32-le"), np.uint32).astype(np.int64) if some else np.empty(0, np.int64)
        grams, found = points, [points]
        for n in range(1, max(ORDERS)):
            grams = (grams[:-1] << _WIDTH) | points[n:]
            found.append(grams)
        sets.append(np.unique(np.concatenate([found[n - 1] for n in ORDERS])))
    return sets


@dataclass
class Classifier:
    """``vocabulary``: the landmarks' n-grams. ``presence``: n-grams by landmarks, each column scaled to length one.

    ``weights`` and ``bias`` give the regression of every language on the kernel with the landmarks.
    """

    languages: list[str]
    vocabulary: np.ndarray
    presence: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Shared n-grams over the geometric mean of both counts, for every text and landmark: one matrix product."""
        rows = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        for row, grams in zip(rows, sets, strict=True):
            at = np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
            row[at[self.vocabulary[at] == grams]] = 1 / np.sqrt(max(1, len(grams)))
        return rows @ self.presence

    def predict(self, sets: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
        """The best language of every text, and how far its regression of 1 (it) against -1 (others) reaches, as 0 to 1."""
        if not self.languages:
            return [UNKNOWN] * len(sets), np.zeros(len(sets))
        values = self.kernel(sets) @ self.weights + self.bias
        best = values.argmax(axis=1) if len(sets) else np.empty(0, np.int64)
        some = np.array([len(s) > 0 for s in sets], bool)
        score = np.clip((values[np.arange(len(sets)), best] + 1) / 2, 0, 1)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], np.where(some, score, 0.0)


def fit_sets(sets: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Classifier:
    """Fit on sets in a fixed order. The features of a text are its kernel with the landmarks times their own kernel's
    inverse square root; one ridge regression per language weighs the texts so that all languages count alike."""
    languages = sorted(set(labels))
    if not languages:
        return Classifier([], np.empty(0, np.int64), *[np.empty((0, 0), np.float32)] * 3)
    of = np.array([languages.index(x) for x in labels])
    chosen = np.sort(np.concatenate([np.flatnonzero(of == k)[:landmarks] for k in range(len(languages))]))
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen]))
    presence = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for column, i in enumerate(chosen):
        presence[np.searchsorted(vocabulary, sets[i]), column] = 1 / np.sqrt(len(sets[i]))
    model = Classifier(languages, vocabulary, presence, np.empty(0), np.empty(0))
    kernel = model.kernel(sets).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max())) @ vectors.T
    features = kernel @ root
    share = (1 / np.bincount(of))[of] / len(languages)
    target = np.where(of[:, None] == np.arange(len(languages)), 1.0, -1.0)
    middle, level = share @ features, share @ target
    centred = features - middle
    inner = centred.T @ (centred * share[:, None]) + ridge * np.eye(len(chosen))
    solved = np.linalg.solve(inner, centred.T @ ((target - level) * share[:, None]))
    model.weights = (root @ solved).astype(np.float32)
    model.bias = (level - middle @ solved).astype(np.float32)
    return model


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fit on at most ``sample`` texts of each language of ``labelled`` (``text``, ``lang``).

    Rows without a language or a letter are left out; of equal texts with the same language one counts. Spark keeps
    the first texts per language in every task, and what reaches the driver are their n-grams. Without any row the
    classifier knows no language and answers ``und``.
    """
    fine = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("h"))
    # Hashes are chosen first, so that copies of a text are one row before anything is ranked.
    ranked = fine.select("lang", "h").distinct().withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("h")))
    chosen = written(ranked.where(F.col("rank") <= sample), "language-sample")
    ranked = fine.join(chosen, ["lang", "h"]).groupBy("lang", "rank").agg(F.min("text").alias("text"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = pa.array(ngram_sets(batch.column("text")), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), grams], ["lang", "rank", "grams"])

    rows = ranked.select("lang", "rank", "text").mapInArrow(collect, "lang string, rank int, grams array<long>").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("rank", "ascending")]).combine_chunks()
    return fit_sets([np.array(g.values) for g in rows.column("grams")], rows.column("lang").to_pylist())


def identify(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every row, from its whole text alone.

    Texts that are null or have no letter are ``und`` with score 0. Repeated rows are answered each, other columns are
    not read. Batches of texts are scored by matrix products with the landmarks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = [], []
            for start in range(0, batch.num_rows, 128):
                found = sent.value.predict(ngram_sets(batch.column("text").slice(start, 128)))
                languages += found[0]
                scores.append(found[1])
            score = pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(languages, pa.string()), score], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
