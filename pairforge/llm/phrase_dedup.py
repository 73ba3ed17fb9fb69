"""Repeated passages of words, located by phrase automata.

A window is ``window`` consecutive words of one document.  Each window has a
seed phrase of ``seed`` words (the smallest phrase hash in it), so equal
windows have equal seeds.  Seed phrases that several documents hold are
confirmed by a distributed count.  The documents that hold one are streamed
through Aho-Corasick automata over word numbers, one automaton for each shard
of documents, compiled from the confirmed phrases of that shard; this locates
every occurrence.  Windows around an occurrence are compared over all
documents by their full hash, and the words of a window that also starts in
a document with a smaller doc_id are removed.

Exact copies of a text are settled by the text's digest beforehand.

Defined cases (see also ``common``): null text has no words; texts shorter
than a window lose nothing; no rows: an empty result.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import (U64, beside, byte_texts, covered, documents, free_shuffles, gram_hashes, id_array,
                                  list_column, list_values, long_gram_hashes, runs_of, save, window_minimizers,
                                  word_hashes)
from pairforge.llm.flags import flagged_keys

WINDOW = 50
SEED = 10
#: words of the documents that one automaton serves
SHARD_WORDS = 400_000


def _seed_grams(hashes: np.ndarray, seed: int) -> np.ndarray:
    return gram_hashes(hashes, seed, seed=101)


def _scanner(window: int, seed: int):
    def scan(batches):
        for batch in batches:
            counts, shas, digests, seeds = [], [], [], []
            for text in byte_texts(batch.column("text")):
                words = text.split()
                counts.append(len(words))
                joined = b" ".join(words)
                shas.append(hashlib.sha256(joined).hexdigest())
                digests.append(xxhash.xxh3_128_digest(joined))
                lows = window_minimizers(_seed_grams(word_hashes(words), seed), window - seed + 1)
                seeds.append(np.unique(lows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(digests, pa.binary()), list_column(seeds)],
                names=["doc_id", "n_words", "sha", "digest", "keys"])
    return scan


class _Shard:
    """Documents of one automaton: word numbers, and their confirmed seed hashes."""

    def __init__(self):
        self.docs, self.words = [], 0

    def add(self, doc_id: int, text: bytes, confirmed: np.ndarray) -> None:
        words = text.split()
        self.docs.append((doc_id, text, word_hashes(words), confirmed))
        self.words += len(words)

    def located(self, window: int, seed: int):
        """(doc_id, text, sorted distinct hashes of the windows around a confirmed phrase)."""
        numbers: dict[int, int] = {}
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        streams, compiled = [], set()
        for _, _, hashes, confirmed in self.docs:
            stream = tuple(numbers.setdefault(h, len(numbers)) for h in hashes.tolist())
            streams.append(stream)
            grams = _seed_grams(hashes, seed)
            for place in np.flatnonzero(np.isin(grams, confirmed)):
                if (key := int(grams[place])) not in compiled:
                    compiled.add(key)
                    automaton.add_word(stream[place:place + seed], len(compiled))
        if compiled:
            automaton.make_automaton()
        for (doc_id, text, hashes, _), stream in zip(self.docs, streams, strict=True):
            ends = np.fromiter((end for end, _ in automaton.iter(stream)), dtype=np.int64) if compiled else []
            spans = len(hashes) - window + 1
            if len(ends) == 0 or spans <= 0:
                continue
            first = np.maximum(ends - window + 1, 0)
            step = np.zeros(spans + 1, dtype=np.int64)
            np.add.at(step, np.minimum(first, spans), 1)
            np.add.at(step, np.minimum(ends - seed + 2, spans), -1)
            near = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            yield doc_id, text, np.unique(long_gram_hashes(hashes, window, seed=202)[near])


def _locator(window: int, seed: int):
    def rows(shard):
        found = list(shard.located(window, seed))
        for i in range(0, len(found), 500):
            part = found[i:i + 500]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _, _ in part], pa.int64()), pa.array([t for _, t, _ in part], pa.binary()),
                 list_column([k for _, _, k in part])], names=["doc_id", "body", "keys"])

    def locate(batches):
        shard = _Shard()
        for batch in batches:
            ids, texts = id_array(batch.column("doc_id")), byte_texts(batch.column("text"))
            lengths, flat = list_values(batch.column("keys"))
            for doc_id, text, confirmed in zip(ids, texts, np.split(flat.view(U64), np.cumsum(lengths)[:-1]),
                                               strict=True):
                shard.add(int(doc_id), text, confirmed)
                if shard.words >= SHARD_WORDS:
                    yield from rows(shard)
                    shard = _Shard()
        yield from rows(shard)
    return locate


def _cutter(window: int):
    def cut(batches):
        for batch in batches:
            lengths, flat = list_values(batch.column("keys"))
            removed, shas, spans = [], [], []
            for text, found in zip(byte_texts(batch.column("body")), np.split(flat.view(U64), np.cumsum(lengths)[:-1]),
                                   strict=True):
                words = text.split()
                starts = np.flatnonzero(np.isin(long_gram_hashes(word_hashes(words), window, seed=202), found))
                gone = covered(starts, window, len(words))
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
                            .hexdigest())
                begins, ends = runs_of(gone)
                spans.append(np.stack([begins, ends], axis=1).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                 list_column(spans)], names=["doc_id", "n_removed", "kept_sha256", "spans"])
    return cut


def repeated_words(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept
    words joined by one space) and spans, the removed word ranges as a flat list
    start, end, start, end, ..."""
    texts = documents(docs, "text")
    scanned = save(texts.mapInArrow(_scanner(window, seed), "doc_id bigint, n_words bigint, sha string, "
                                    "digest binary, keys array<bigint>"), "phrase-scan")
    first = save(scanned.groupBy("digest").agg(F.min("doc_id").alias("first")), "phrase-first")
    heads = scanned.join(first.select(F.col("first").alias("doc_id")), "doc_id", "left_semi").where("size(keys) > 0")
    n_seeds = scanned.agg(F.sum(F.size("keys"))).first()[0] or 0
    confirmed = flagged_keys(heads.select("doc_id", "keys"), n_seeds)
    located = save(texts.join(beside(confirmed), "doc_id").mapInArrow(
        _locator(window, seed), "doc_id bigint, body binary, keys array<bigint>"), "phrase-located")
    free_shuffles(docs.sparkSession)
    n_windows = located.agg(F.sum(F.size("keys"))).first()[0] or 0
    later = flagged_keys(located.select("doc_id", "keys"), n_windows, later=True)
    cut = save(located.select("doc_id", "body").join(beside(later), "doc_id").mapInArrow(
        _cutter(window), "doc_id bigint, n_removed bigint, kept_sha256 string, spans array<bigint>")
        .dropDuplicates(["doc_id"]), "phrase-cut")
    free_shuffles(docs.sparkSession)
    whole = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= window)
    return (scanned.drop("keys").join(first, "digest").join(cut, "doc_id", "left")
            .select("doc_id", "n_words",
                    F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint")))
                    .alias("n_removed"),
                    F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha"))
                    .alias("kept_sha256"),
                    F.when(whole, F.array(F.lit(0).cast("bigint"), "n_words"))
                    .otherwise(F.coalesce("spans", F.array().cast("array<bigint>"))).alias("spans")))
