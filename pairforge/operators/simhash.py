"""Simhash fingerprints and near-duplicate review candidates.

Fingerprint (defaults of the public ``simhash`` package): lower-case, keep
only word characters, slide a 4-character window, hash every shingle with
md5 and keep its low 64 bits; bit i of the fingerprint is 1 when more
shingle occurrences have that bit set than unset.

The shingles of a row are counted inside the task that reads it, by an Arrow
function that hashes every distinct shingle once; a row leaves it as 64 sums,
and the rows of a document are summed.  The fingerprint is
returned as two 32-bit halves so every engine can compare it in plain
integers.
"""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash
from pairforge.operators.index import group_index

# The package's default tokenisation.
WORD_CHARS_RX = r"[^\p{L}\p{N}_]"
SHINGLE = 4
BITS = 64
DIGEST_CACHE = 200_000
NEAR_DUPLICATE_MAX = 10   # distance <= 10 is rejected
MAX_REJECTS = 25          # give up after more than 25 rejects in a row


class _Digests(dict):
    """shingle -> the low 64 bits of its md5 (big-endian), computed once per worker for frequent shingles."""

    def __missing__(self, shingle: str) -> bytes:
        value = hashlib.md5(shingle.encode()).digest()[8:]
        if len(self) >= DIGEST_CACHE:
            self.clear()
        if len(shingle) <= SHINGLE:
            self[shingle] = value
        return value


_DIGESTS = _Digests()


def bit_votes(content: str | None) -> np.ndarray:
    """Of every bit (0 first) the shingle occurrences that have it set minus those that have it
    unset.  Shorter content is a single shingle; null has none."""
    if content is None:
        return np.zeros(BITS, dtype=np.int64)
    found = collections.Counter(content[i:i + SHINGLE] for i in range(max(len(content) - SHINGLE, 0) + 1))
    digests = np.frombuffer(b"".join(map(_DIGESTS.__getitem__, found)), dtype=np.uint8).reshape(-1, BITS // 8)
    counts = np.fromiter(found.values(), dtype=np.float64, count=len(found))  # exact below 2**53
    ones = counts @ np.unpackbits(digests, axis=1).astype(np.float64)
    return (2 * ones - counts.sum()).astype(np.int64)[::-1]


def _votes(batches):
    for batch in batches:
        votes = [bit_votes(content) for content in batch.column("_c").to_pylist()]
        flat = np.concatenate(votes) if votes else np.empty(0, dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(votes) + 1, dtype=np.int32) * BITS), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("_k"), lists], names=["_k", "_v"])


def simhash(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, fp_hi, fp_lo)``: the 64-bit fingerprint as two 32-bit halves."""
    content = F.regexp_replace(F.lower(F.col(text)), WORD_CHARS_RX, "")
    c = df.select(F.col(key), content.alias("_c"))
    kind = df.schema[key].dataType.simpleString()
    votes = c.select(F.col(key).alias("_k"), "_c").mapInArrow(_votes, f"_k {kind}, _v array<bigint>")
    sums = [F.sum(F.get("_v", F.lit(i))).alias(f"_s{i}") for i in range(BITS)]
    agg = votes.groupBy(F.col("_k").alias(key)).agg(*sums)

    def pack(lo: int) -> Column:
        out = F.lit(0).cast("bigint")
        for i in range(lo, lo + 32):
            out = out + F.when(F.col(f"_s{i}") > 0, F.lit(1 << (i - lo))).otherwise(F.lit(0)).cast("bigint")
        return out
    return agg.select(key, pack(32).alias("fp_hi"), pack(0).alias("fp_lo"))


def distance(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return F.bit_count(a_hi.bitwiseXOR(b_hi)) + F.bit_count(a_lo.bitwiseXOR(b_lo))


def group_pair_counts(df: DataFrame, group_cols) -> DataFrame:
    """A2 + J7: functions and unordered pairs per key; keys with at most one
    pair are skipped.  Pairs are counted, never materialised."""
    g = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_funcs"))
    g = g.withColumn("n_pairs", (F.col("n_funcs") * (F.col("n_funcs") - 1) / 2).cast("bigint"))
    return g.filter(F.col("n_pairs") > 1)


def review_candidates(df: DataFrame, group_cols, id_col: str, text: str, seed=42,
                      max_rejects: int = MAX_REJECTS, theta: int = NEAR_DUPLICATE_MAX,
                      reviewed: DataFrame | None = None) -> DataFrame:
    """Per key, the first of up to ``max_rejects + 1`` random pairs
    whose fingerprints are more than ``theta`` bits apart.

    A draw t picks member i uniformly and a different member j uniformly --
    the same distribution as a uniform draw over all unordered pairs -- from
    seeded hashes, so only ``26 x keys`` draw rows exist; they find their
    members through equi joins on (key, member index).  No pair list is built,
    and only drawn members are fingerprinted.  Pairs in ``reviewed`` (id_a < id_b)
    are drawn but not proposed again.
    """
    gcols = list(group_cols)
    members = group_index(df.select(*gcols, id_col), gcols, [id_col], "m")
    keys = group_pair_counts(df.select(*gcols), gcols)
    gc = [F.col(c) for c in gcols]
    draws = keys.select(*gcols, "n_funcs", F.explode(F.sequence(F.lit(0), F.lit(max_rejects))).alias("t"))
    i = dhash(seed, *gc, F.col("t"), F.lit("a")) % F.col("n_funcs")
    j0 = dhash(seed, *gc, F.col("t"), F.lit("b")) % (F.col("n_funcs") - 1)
    draws = draws.withColumn("i", i).withColumn("j", F.when(j0 >= F.col("i"), j0 + 1).otherwise(j0))
    a = members.select(*gcols, F.col("m").alias("i"), F.col(id_col).alias("id_i"))
    b = members.select(*gcols, F.col("m").alias("j"), F.col(id_col).alias("id_j"))
    drawn = draws.join(a, gcols + ["i"]).join(b, gcols + ["j"])
    if reviewed is not None:
        again = reviewed.select(F.col("id_a").alias("_a"), F.col("id_b").alias("_b")).distinct()
        drawn = drawn.join(again, (F.least("id_i", "id_j") == F.col("_a")) & (F.greatest("id_i", "id_j") == F.col("_b")),
                           "left_anti")
    # only the drawn texts are fingerprinted, and each of them once
    sides = drawn.select(*gcols, "t", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("id_i").alias("id")),
        F.struct(F.lit(1).alias("side"), F.col("id_j").alias("id")))).alias("m")).select(*gcols, "t", "m.side", F.col("m.id").alias(id_col))
    fps = simhash(df.select(id_col, text).join(sides.select(id_col).distinct(), id_col, "left_semi"), id_col, text)
    parts = {f"{c}_{n}": F.max(F.when(F.col("side") == i, F.col(col)))
             for i, n in enumerate("ij") for c, col in (("id", id_col), ("hi", "fp_hi"), ("lo", "fp_lo"))}
    scored = sides.join(fps, id_col).groupBy(*gcols, "t").agg(*(agg.alias(name) for name, agg in parts.items()))
    scored = scored.withColumn("distance", distance(F.col("hi_i"), F.col("lo_i"), F.col("hi_j"), F.col("lo_j")))
    ok = scored.filter(F.col("distance") > theta)
    first = ok.groupBy(*gcols).agg(F.min_by(F.struct("t", "id_i", "id_j", "distance"), F.col("t")).alias("c"))
    return first.select(*gcols, (F.col("c.t") + 1).cast("bigint").alias("n_tries"),
                        F.least("c.id_i", "c.id_j").alias("id_a"), F.greatest("c.id_i", "c.id_j").alias("id_b"),
                        F.col("c.distance").cast("bigint").alias("distance"))
