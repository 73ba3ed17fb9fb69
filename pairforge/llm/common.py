"""Helpers shared by the training-data operators.

Conventions of all operators on documents: a row without ``doc_id`` is not a
document and is left out; a null text is an empty one; rows that repeat a
``doc_id`` are copies of one row, and each gets its own result row; only the
named columns are read, so extra columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.session import scratch_path

U64 = np.uint64
#: odd multipliers and mixing constants of the 64-bit hashes
GOLDEN = U64(0x9E3779B97F4A7C15)
MIX_A = U64(0xBF58476D1CE4E5B9)
MIX_B = U64(0x94D049BB133111EB)

WORD_CACHE = 400_000
#: bytes of a batch's rows that are worked on at a time
SLICE_BYTES = 4_000_000


def save(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts the
    lineage, and a lost executor loses nothing that was written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished, written steps now
    instead of at the driver's next garbage collection."""
    spark.sparkContext._jvm.System.gc()


def beside(slim: DataFrame) -> DataFrame:
    """The slim side of a join with whole texts.  Texts are shuffled once by id and
    the slim side is hashed, at every size: no broadcast that grows with the
    corpus, no sorting of texts."""
    return slim.hint("shuffle_hash")


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` (bigint) and the named columns of the rows that have an id."""
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), *columns)


def byte_texts(column) -> list[bytes]:
    """A text column's values as UTF-8 bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def sliced(batches):
    """The batches' rows in slices of about SLICE_BYTES at most: what a worker makes of a slice
    doesn't grow with the texts of a whole batch."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# The word characters 0-9, a-z (A-Z lowered) and all bytes above 127; other bytes part words.
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b if b >= 128 or b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def fold_words(text: bytes) -> list[bytes]:
    """Words of ASCII letters and digits and all non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def id_array(column) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), dtype=np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix64)."""
    x = x + GOLDEN
    x = (x ^ (x >> U64(30))) * MIX_A
    x = (x ^ (x >> U64(27))) * MIX_B
    return x ^ (x >> U64(31))


class _WordHashes(dict):
    """word -> 64-bit hash, computed once per worker for frequent words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = value
        return value


_HASHES = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=U64, count=len(words))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers from a seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * GOLDEN + U64(seed)) | U64(1)


def gram_hashes(units: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of all runs of n consecutive units (a weighted sum modulo 2**64, mixed)."""
    count = len(units) - n + 1
    if count <= 0:
        return np.empty(0, dtype=U64)
    with np.errstate(over="ignore"):
        acc = np.zeros(count, dtype=U64)
        for k, m in enumerate(odd_multipliers(n, seed)):
            acc += units[k:k + count] * m
        return mix(acc)


def long_gram_hashes(units: np.ndarray, n: int, seed: int) -> np.ndarray:
    """As ``gram_hashes`` for long runs: prefix sums of a polynomial modulo 2**64."""
    count = len(units) - n + 1
    if count <= 0:
        return np.empty(0, dtype=U64)
    base = int(odd_multipliers(1, seed)[0])
    back = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(units), base, dtype=U64))
        sums = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(mix(units) * powers)])
        backs = np.cumprod(np.full(count, back, dtype=U64))
        return mix((sums[n:] - sums[:count]) * backs)


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each window of ``width`` values, by doubling."""
    if len(values) < width:
        return values[:0]
    out, done = values, 1
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    if done < width:
        rest = width - done
        out = pick(out[:-rest], out[rest:])
    return out


def window_minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams its smallest hash: equal windows have
    equal minimizers, and neighbours mostly share theirs."""
    return slide(grams, width, np.minimum)


def list_column(arrays: list[np.ndarray], kind=None) -> pa.ListArray:
    """A list<int64> column from one array per row."""
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int64)
    flat = flat.view(np.int64) if flat.dtype == U64 else flat
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind or pa.int64()))


def list_values(column) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, flat values) of a list<int64> column without null lists."""
    lengths = np.diff(np.asarray(column.offsets))
    return lengths, np.asarray(column.flatten())


def lists_of(lengths: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    """A list<int64> column of the lists of these lengths that stand one after the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int64()))


def binary_values(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, bytes) of a binary array without nulls: value k is bytes[bounds[k]:bounds[k + 1]]."""
    array = array.cast(pa.large_binary())
    _, bounds, data = array.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    return bounds, np.frombuffer(data or b"", dtype=np.uint8)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[0::2], edges[1::2]


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Flags of the units that a run of ``length`` from one of the starts covers."""
    step = np.zeros(size + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, size), -1)
    return np.cumsum(step[:-1]) > 0
