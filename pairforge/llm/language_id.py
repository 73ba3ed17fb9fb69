"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram is the product of
its letters' vectors, each rotated by its place; a text is the sum of its
n-grams' vectors, a language the sum over its training texts.  A text takes
the language whose vector has the largest cosine with its own.

Learning sums one vector per language and task; the model is labels x
dimensions numbers, whatever the number of documents.

Defined cases (see also ``common``): a text without letters (or null, or when
nothing could be learned) is ``und`` with score 0; equal cosines go to the
first label in order; no rows: an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import U64, documents, mix

DIMENSIONS = 1024
GRAM = 3
#: n-gram vectors that a worker keeps
GRAM_CACHE = 30_000
UNKNOWN = "und"

#: bits of a code point in an n-gram's number
_BITS = 21


class GramVectors:
    """Vectors of n-grams, each bound once and kept."""

    def __init__(self, dimensions: int):
        self._dimensions = dimensions
        self._letters: dict[int, np.ndarray] = {}
        self._rows: dict[int, int] = {}
        self._table = np.empty((GRAM_CACHE, dimensions), dtype=np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self._letters:
            with np.errstate(over="ignore"):
                bits = mix(np.arange(self._dimensions, dtype=U64) + mix(np.array([code + 1], dtype=U64)))
            self._letters[code] = ((bits >> U64(63)).astype(np.int8) * 2 - 1).astype(np.int8)
        return self._letters[code]

    def _bind(self, gram: int) -> np.ndarray:
        bound = np.ones(self._dimensions, dtype=np.int8)
        for place in range(GRAM):
            bound = bound * np.roll(self._letter((gram >> (_BITS * place)) & ((1 << _BITS) - 1)), place)
        return bound

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weighted sum of the n-grams' vectors."""
        total = np.zeros(self._dimensions, dtype=np.float32)
        for i in range(0, len(grams), GRAM_CACHE // 2):
            part = grams[i:i + GRAM_CACHE // 2].tolist()
            if len(self._rows) + len(part) > GRAM_CACHE:
                self._rows = {}
            for g in part:
                if g not in self._rows:
                    self._rows[g] = len(self._rows)
                    self._table[self._rows[g]] = self._bind(g)
            rows = np.fromiter(map(self._rows.__getitem__, part), dtype=np.int64, count=len(part))
            total += counts[i:i + len(part)].astype(np.float32) @ self._table[rows].astype(np.float32)
        return total


_VECTORS: dict[int, GramVectors] = {}
_ALPHA: list[np.ndarray] = []


def _vectors(dimensions: int) -> GramVectors:
    if dimensions not in _VECTORS:
        _VECTORS[dimensions] = GramVectors(dimensions)
    return _VECTORS[dimensions]


def _alphabetic() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0]


def letter_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of lower-case letters, runs of other characters being one
    gap, and their counts; nothing if the text has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = _alphabetic()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    codes = np.concatenate([[0], np.where(letter, codes, 0), [0]])
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    grams = sum(codes[k:len(codes) - GRAM + 1 + k] << (_BITS * (GRAM - 1 - k)) for k in range(GRAM))
    return np.unique(grams, return_counts=True)


def _learner(dimensions: int):
    def learn(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                grams, counts = letter_grams(text)
                if len(grams):
                    sums[label] = sums.get(label, 0) + _vectors(dimensions).bundle(grams, counts).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"label": list(sums), "vector": [v.tolist() for v in sums.values()]},
                schema=pa.schema([("label", pa.string()), ("vector", pa.list_(pa.float64()))]))
    return learn


def _predictor(labels: list[str], prototypes: np.ndarray, dimensions: int):
    def predict(batches):
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text").to_pylist():
                grams, counts = letter_grams(text)
                vector = _vectors(dimensions).bundle(grams, counts) if len(grams) and labels else None
                length = 0.0 if vector is None else float(np.linalg.norm(vector))
                if length == 0.0:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = prototypes @ (vector / length)
                best = int(np.argmax(cosines))
                names.append(labels[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return predict


def learn_languages(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(labels, unit vectors) from the columns text and label."""
    parts = labelled.select("text", "label").mapInArrow(_learner(dimensions), "label string, vector array<double>")
    rows = (parts.select("label", F.posexplode("vector").alias("at", "value")).groupBy("label", "at")
            .agg(F.sum("value").alias("value")).collect())
    labels = sorted({r["label"] for r in rows})
    prototypes = np.zeros((len(labels), dimensions))
    for r in rows:
        prototypes[labels.index(r["label"]), r["at"]] = r["value"]
    lengths = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return labels, (prototypes / np.where(lengths > 0, lengths, 1)).astype(np.float32)


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Documents whose crc32 of the doc_id's text leaves 2 on division by 4 are
    held out; the others with a ``lang`` teach."""
    rows = documents(docs, "text", "lang").withColumn(
        "held_out", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2)
    labels, prototypes = learn_languages(
        rows.where("not held_out and lang is not null").select("text", F.col("lang").alias("label")), dimensions)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predictor(labels, prototypes, dimensions),
        "doc_id bigint, held_out boolean, lang_pred string, score double")
