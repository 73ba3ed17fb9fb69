"""Importance resampling towards a target distribution (hashed word features).

A feature is a run of 1 to ``max_n`` words joined by one space; its bucket is
the CRC-32 of its UTF-8 bytes modulo the number of buckets.  Documents (raw)
and target texts each give one count per bucket; a bucket's gain is the
logarithm of the ratio of its smoothed shares; a document's weight is the sum
of the gains of its features; a Gumbel draw keyed by ``doc_id`` is added and
the highest scores are drawn without replacement.

CRCs are made in bulk: the distinct features that a worker has not met yet are
grouped by length, each group is a uint8 matrix with one feature per row, and
one table look-up per column moves the CRCs of all rows on (``crc32_rows``).

Jobs: one pass counts the buckets (a task sends at most one row per bucket),
one pass scores every document, and the ranks of the drawn come from counted
score ranges of the slim score table.  What reaches the driver is bounded by
the number of buckets and of score ranges.

Nulls: a null text has no features, weight 0 and is never drawn; rows without
``doc_id`` are left out (and not counted).  Rows that repeat a doc_id get a
row each; ties go to the smaller doc_id.  Empty documents give an empty
result, an empty target gives T = 0.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import byte_texts, documents, fold_words, id_array, save
from pairforge.operators.index import dense_index

#: texts are tokenised in slices of about so many bytes
SLICE_BYTES = 8 << 20
#: a worker forgets its features when their bytes pass this
KNOWN_BYTES = 48 << 20
#: features longer than this are cut into rows of this length, whose CRCs are then joined
PIECE = 256

# Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


TABLE = _crc_table()


def _columns(matrix: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Move one CRC register per row over the columns of a uint8 matrix."""
    for column in np.ascontiguousarray(matrix.T):
        state = TABLE[(state ^ column) & 255] ^ (state >> 8)
    return state


def _zero_piece_tables() -> np.ndarray:
    """What PIECE zero bytes make of a register, for each byte of it (a linear map)."""
    registers = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    return _columns(np.zeros((1024, PIECE), dtype=np.uint8), registers).reshape(4, 256)


_ZEROS = _zero_piece_tables()


def _long_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC registers of long rows: the start value is put into the first four bytes, the
    front is filled with zeros (they leave an empty register empty), and the registers of
    the pieces are joined from left to right."""
    n, length = matrix.shape
    count = -(-length // PIECE)
    padded = np.zeros((n, count * PIECE), dtype=np.uint8)
    padded[:, count * PIECE - length:] = matrix
    padded[:, count * PIECE - length:count * PIECE - length + 4] ^= 255
    pieces = _columns(padded.reshape(n * count, PIECE), np.zeros(n * count, dtype=np.uint32)).reshape(n, count)
    state = np.zeros(n, dtype=np.uint32)
    for k in range(count):
        state = (_ZEROS[0][state & 255] ^ _ZEROS[1][(state >> 8) & 255] ^ _ZEROS[2][(state >> 16) & 255]
                 ^ _ZEROS[3][state >> 24] ^ pieces[:, k])
    return state


def crc32_rows(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each byte string: equal lengths share a matrix, results go back to their places."""
    lengths = np.fromiter(map(len, features), dtype=np.int64, count=len(features))
    flat = np.frombuffer(b"".join(features), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(len(features), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        length = int(lengths[rows[0]])
        for part in np.array_split(rows, -(-len(rows) * max(length, 1) // SLICE_BYTES)):
            matrix = flat[starts[part][:, None] + np.arange(length)]
            start = np.full(len(part), 0xFFFFFFFF, dtype=np.uint32)
            out[part] = _long_rows(matrix) if length > 2 * PIECE else _columns(matrix, start)
    return ~out


class FeatureBuckets:
    """Buckets of features; each distinct feature is hashed once per worker while it is remembered."""

    def __init__(self, buckets: int):
        self.buckets, self.known, self.size = buckets, {}, 0

    def __call__(self, features: list[bytes]) -> np.ndarray:
        if self.size > KNOWN_BYTES:
            self.known, self.size = {}, 0
        known = self.known
        new = [f for f in set(features) if f not in known]
        if new:
            known.update(zip(new, (crc32_rows(new) % np.uint32(self.buckets)).tolist()))
            self.size += sum(map(len, new)) + 100 * len(new)
        return np.fromiter(map(known.__getitem__, features), dtype=np.int64, count=len(features))


def text_features(text: bytes, max_n: int) -> tuple[int, list[bytes]]:
    """(number of words, features with repeats) of a text."""
    words = fold_words(text)
    features = list(words)
    for n in range(2, max_n + 1):
        features += [b" ".join(words[k:k + n]) for k in range(len(words) - n + 1)]
    return len(words), features


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about SLICE_BYTES together."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > SLICE_BYTES:
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _featurised(texts: list[bytes], max_n: int, bucket_of: FeatureBuckets):
    """Per slice: (first row, words per row, features per row, buckets of all features)."""
    for a, b in _slices(texts):
        rows = [text_features(t, max_n) for t in texts[a:b]]
        flat = list(itertools.chain.from_iterable(f for _, f in rows))
        yield a, [n for n, _ in rows], [len(f) for _, f in rows], bucket_of(flat)


def bucket_counts(texts: DataFrame, buckets: int, max_n: int, text: str = "text") -> np.ndarray:
    """Features of all texts per bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of, total = FeatureBuckets(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for *_, found in _featurised(byte_texts(batch.column(0)), max_n, bucket_of):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    parts = texts.select(text).mapInArrow(count, "bucket int, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares, in doubles."""
    buckets = len(raw)
    s_all, t_all = float(int(raw.sum()) + buckets), float(int(target.sum()) + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def gumbel(seed: int, doc_id: int) -> int:
    """A document's draw: floor(1000 x Gumbel) from the hash of the seed and its id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(docs: DataFrame, target: DataFrame, *, buckets: int = 10000, max_n: int = 1, seed: int = 2024,
               min_words: int = 20, percent: int = 10) -> DataFrame:
    """Every document's (doc_id, n_words, n_features, weight, score, rank).

    ``rank`` is 1, 2, ... for the floor(percent * N / 100) highest scores among the
    N documents with at least ``min_words`` words, null for all others."""
    docs = documents(docs, "text")
    gains = bucket_gains(bucket_counts(docs, buckets, max_n), bucket_counts(target, buckets, max_n))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = FeatureBuckets(buckets)
        for batch in batches:
            ids = id_array(batch.column(0))
            words, features = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
            weight = np.zeros(len(ids), dtype=np.int64)
            for a, n_words, n_features, found in _featurised(byte_texts(batch.column(1)), max_n, bucket_of):
                rows = slice(a, a + len(n_words))
                words[rows], features[rows] = n_words, n_features
                ends = np.cumsum(n_features)
                sums = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(gains[found])])
                weight[rows] = sums[ends] - sums[ends - n_features]
            drawn = weight + np.fromiter((gumbel(seed, k) for k in ids.tolist()), dtype=np.int64, count=len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (ids, words, features, weight, drawn)],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    scored = save(docs.mapInArrow(
        score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"), "importance-scores")
    eligible = F.col("n_words") >= min_words
    n_drawn = percent * scored.where(eligible).count() // 100
    ranked = dense_index(scored.where(eligible), [-F.col("score"), "doc_id", "weight", "n_features"], "rank", first=n_drawn)
    rest = ranked.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("bigint")))
    return rest.select("doc_id", "n_words", "n_features", "weight", "score",
                       F.when(F.col("rank") < n_drawn, F.col("rank") + 1).alias("rank"))
