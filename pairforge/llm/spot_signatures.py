"""Document fingerprints from spot signatures.

Words are runs of letters and digits (ASCII letters lower-cased).  The corpus's most
common words (by number of documents, over all documents) are the anchors.  A spot is
an anchor, the first word, or a word with no spot among the ``GAP`` before it (so every
text has spots, in any language).  Its signature hashes the anchor and the chain of the
next ``CHAIN`` content words, i.e. words that are no anchors; a chain ends with the text.
A fingerprint is the set of a text's signatures: 8 hex digits each, ascending, so equal
sets are equal strings.  A text with characters but no word has one signature, of itself;
only the empty text has the empty fingerprint.

Likeness is the Jaccard similarity of two sets.  Sets are partitioned by length: lengths
grow by 1 / threshold from a partition to the next, so a set is like one of its own or a
neighbouring partition only, and ``pruned_jaccard`` leaves a pair as soon as its lengths
or its common smallest signatures rule the threshold out.  ``search`` finds for a set of
queries all documents that are like them: partitions and the smallest signatures of each
set are joined, then the sets are compared.

``fingerprints`` also compares each text with an edited one (its last half replaced by the
beginning of the next document) and with the next document.  Texts are shuffled once, to
ranges of doc_id; the first document of a range visits the range before.  What the driver
holds is bounded by the number of anchors and of ranges.

Nulls: a null text is empty; two empty texts have likeness 1, an empty and another 0.
Rows without ``doc_id`` are left out; rows that repeat one are ordered by their text's
hash.  A single document is its own next one.  No rows: no rows.  Only the named columns
are read.  doc_id is taken for an identifier: the copies of one share a range.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import U64, byte_texts, documents, fold_words, id_array, mix, odd_multipliers, save

ANCHORS = 256
CHAIN = 3
GAP = 16
#: a worker's table of words is begun anew past so many
KNOWN_WORDS = 400_000
#: ranges of doc_id at most, and sample documents that place the cut of one
MAX_RANGES, PER_RANGE = 16384, 64

_SEED = 12
_NO_ANCHOR = U64(0x5107)


def common_words(docs: DataFrame, limit: int = ANCHORS) -> list[int]:
    """64-bit hashes of the words that most documents hold (ties: smaller hash first), at most
    ``limit`` and at most an eighth of all distinct words.  Tasks send counts by hash."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), dtype=U64, count=len(seen)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen: Counter = Counter()
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                seen.update(set(fold_words(text)))
                if len(seen) > KNOWN_WORDS:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()
    counts = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    # fewer than eight times the limit are all words there are
    top = counts.orderBy(F.desc("n"), "word").limit(8 * limit).collect()
    return [r.word % (1 << 64) for r in top[:len(top) // 8]]


class Spots:
    """Signature sets of texts, for one set of anchors."""

    class _Words(dict):
        """word -> hash, whose lowest bit tells an anchor."""

        def __init__(self, anchors: list[int]):
            super().__init__()
            self.anchors = set(anchors)

        def __missing__(self, word: bytes) -> int:
            value = xxhash.xxh3_64_intdigest(word)
            value = value & ~1 | (value in self.anchors)
            if len(word) <= 64:
                if len(self) >= KNOWN_WORDS:
                    self.clear()
                self[word] = value
            return value

    def __init__(self, anchors: list[int]):
        self.words = Spots._Words(anchors)
        self.multipliers = odd_multipliers(CHAIN + 1, _SEED)

    def __call__(self, text: bytes) -> np.ndarray:
        """Ascending distinct 32-bit signatures."""
        words = fold_words(text)
        if not words:
            return np.array([xxhash.xxh3_64_intdigest(text) >> 32] if text else [], dtype=np.uint32)
        hashes = np.fromiter(map(self.words.__getitem__, words), dtype=U64, count=len(words))
        anchor = (hashes & U64(1)).astype(bool)
        spots = np.flatnonzero(anchor)
        if not anchor[0]:
            spots = np.concatenate([[0], spots])
        room = (np.diff(np.append(spots, len(words))) - 1) // GAP  # words without a spot for too long
        step = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room) + 1
        spots = np.concatenate([spots, np.repeat(spots, room) + GAP * step])
        content = np.flatnonzero(~anchor)
        chain = np.concatenate([hashes[content], np.zeros(CHAIN, dtype=U64)])
        start = np.searchsorted(content, spots, side="right")
        with np.errstate(over="ignore"):
            value = np.where(anchor[spots], hashes[spots], _NO_ANCHOR) * self.multipliers[0]
            for k in range(CHAIN):
                value = value + chain[start + k] * self.multipliers[k + 1]
            return np.unique((mix(value) >> U64(32)).astype(np.uint32))


def as_string(signatures: np.ndarray) -> str:
    return signatures.astype(">u4").tobytes().hex()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").astype(np.uint32)


def length_partition(size: int, threshold: float) -> int:
    """Number of the partition that holds sets of this length: the first lengths of two
    neighbouring partitions differ by 1 / threshold at least, the next whole number up."""
    number, first = 0, 1
    while size >= (following := int(first / threshold) + 1):
        number, first = number + 1, following
    return number


def pruned_jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two ascending sets, or 0 where it can't reach ``least``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < least * len(large):
        return 0.0
    # pruning by the head: what the head misses is missing from the whole
    head = len(small) // 8
    if least and head:
        missed = head - int(np.isin(small[:head], large[:np.searchsorted(large, small[head - 1], "right")], assume_unique=True).sum())
        both = len(small) - missed
        if both < least * (len(small) + len(large) - both):
            return 0.0
    if len(small) == len(large) and (small == large).all():
        return 1.0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    value = both / (len(small) + len(large) - both)
    return value if value >= least else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the text's code points replaced by the beginning of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> list[int]:
    """First ids of the ranges but the first, from a bounded sample of ids and text lengths."""
    spark = docs.sparkSession
    n = docs.count()
    wanted = min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions()),
                 n // PER_RANGE)
    if wanted < 2:
        return []
    share = min(1.0, wanted * PER_RANGE / n)
    drawn = sorted((r.doc_id, r.n) for r in docs.where(F.rand(_SEED) < share).select(
        "doc_id", (F.coalesce(F.length("text"), F.lit(0)) + 100).alias("n")).collect())
    if not drawn:
        return []
    ids, sizes = zip(*drawn)
    sums = np.cumsum(sizes)  # ranges of similar text, not of similar numbers of documents
    at = np.searchsorted(sums, sums[-1] * np.arange(1, wanted) / wanted)
    return sorted({ids[k] for k in at})


def _in_order(docs: DataFrame) -> DataFrame:
    """(part, visitor, doc_id, text) by ranges of doc_id, each sorted and followed by the
    first document of the next range (the last one by the very first document)."""
    cuts = np.array(_ranges(docs), dtype=np.int64)

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), side="right").astype(np.int32))
    parted = docs.withColumn("part", part_of("doc_id"))
    first = sorted((r.part, r.doc_id) for r in parted.groupBy("part").agg(F.min("doc_id").alias("doc_id")).collect())
    visits = [(doc_id, first[k - 1][0]) for k, (_, doc_id) in enumerate(first)]
    # one row per range: MAX_RANGES rows at most
    guests = docs.join(F.broadcast(docs.sparkSession.createDataFrame(visits, "doc_id bigint, part int")), "doc_id")
    rows = parted.select("part", F.lit(False).alias("visitor"), "doc_id", "text").unionByName(
        guests.select("part", F.lit(True).alias("visitor"), "doc_id", "text"))
    # every range has its own task, whatever its number hashes to
    return (rows.repartitionByRange(max(len(cuts) + 1, 1), "part")
            .sortWithinPartitions("part", "visitor", "doc_id", F.xxhash64("text"), "text").select("part", "visitor", "doc_id", "text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_spots)."""
    docs = documents(docs, "text")
    anchors = common_words(docs)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots, before = Spots(anchors), None
        for batch in batches:
            out = []
            for part, visitor, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                known = before and before[0] == part
                if known and not before[1]:  # the row before gets its next document
                    spot = spots(text.encode())
                    out.append(compared(spots, before, text, spot))
                elif not visitor:
                    spot = spots(text.encode())
                else:
                    continue
                before = (part, visitor, doc_id, text, spot)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    def compared(spots, row, following, following_spots):
        _, _, doc_id, text, own = row
        text_edited = edited(text, following)
        edited_spots = spots(text_edited.encode())
        return {"doc_id": doc_id, "n_chars": len(text),
                "edited_sha256": hashlib.sha256(text_edited.encode()).hexdigest(),
                "fingerprint": as_string(own), "edited_fingerprint": as_string(edited_spots),
                "near_edited": pruned_jaccard(own, edited_spots), "near_next": pruned_jaccard(own, following_spots),
                "n_spots": len(own)}
    kind = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                      ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                      ("near_next", pa.float64()), ("n_spots", pa.int64())])
    return _in_order(docs).mapInArrow(rows_of, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                      "edited_fingerprint string, near_edited double, near_next double, n_spots bigint")


def signature_sets(docs: DataFrame, anchors: list[int], threshold: float) -> DataFrame:
    """(doc_id, length_class, spots array<bigint>, prefix array<bigint>): of two sets that are
    like each other, the prefixes (smallest signatures) share one."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = Spots(anchors)
        for batch in batches:
            rows = []
            for doc_id, text in zip(id_array(batch.column(0)).tolist(), byte_texts(batch.column(1))):
                own = spots(text).astype(np.int64)
                head = len(own) - int(np.ceil(threshold * len(own) - 1e-9)) + 1
                if len(own):
                    rows.append({"doc_id": doc_id, "length_class": length_partition(len(own), threshold),
                                 "spots": own, "prefix": own[:head]})
            yield pa.RecordBatch.from_pylist(rows, schema=kind)
    kind = pa.schema([("doc_id", pa.int64()), ("length_class", pa.int32()), ("spots", pa.list_(pa.int64())),
                      ("prefix", pa.list_(pa.int64()))])
    return docs.mapInArrow(sets, "doc_id bigint, length_class int, spots array<bigint>, prefix array<bigint>")


def search(docs: DataFrame, queries: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(query_id, doc_id, likeness) of every query and other document whose likeness reaches
    the threshold.  Keys (length partition, prefix signature) are joined: a query looks in its
    own and both neighbouring partitions.  Candidates are met once each, then their sets are
    fetched and compared."""
    docs, queries = documents(docs, "text"), documents(queries, "text")
    anchors = common_words(docs)
    stored = save(signature_sets(docs, anchors, threshold), "spot-sets")
    asked = save(signature_sets(queries, anchors, threshold), "spot-queries")
    near = F.explode(F.array(*(F.col("length_class") + d for d in (-1, 0, 1))))
    keys = asked.select(F.col("doc_id").alias("query_id"), near.alias("length_class"), F.col("prefix")).select(
        "query_id", "length_class", F.explode("prefix").alias("signature"))
    met = stored.select("doc_id", "length_class", F.explode("prefix").alias("signature")).join(
        keys, ["length_class", "signature"]).where("doc_id <> query_id").select("query_id", "doc_id").distinct()

    @F.pandas_udf("double")
    def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([pruned_jaccard(np.asarray(x), np.asarray(y), threshold) for x, y in zip(a, b)], dtype="float64")
    sets = met.join(stored.select("doc_id", F.col("spots").alias("a")), "doc_id").join(
        asked.select(F.col("doc_id").alias("query_id"), F.col("spots").alias("b")), "query_id")
    return sets.select("query_id", "doc_id", likeness("a", "b").alias("likeness")).where(F.col("likeness") > 0).distinct()
