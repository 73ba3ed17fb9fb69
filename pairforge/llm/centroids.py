"""Centroid clustering of whole-number vectors over Hilbert-ordered blocks.

Vectors are ordered along a Hilbert curve (a few bits per component) and cut into
blocks of ``BLOCK_ROWS``, written once with the smallest and largest value of each
component (a zone map).  In a round each block first asks its box: the distance from
a centroid to the box is a lower bound for all its vectors, and the largest distance
of its vectors to the centroid next to the box's middle is an upper bound for their
nearest; only centroids whose lower bound does not pass it are candidates, which are
then compared exactly with all vectors of the block at once.  All arithmetic is on
whole numbers, so bounds, distances and centroids are exact whatever the blocks.

A round is one pass over the blocks: tasks send counts and sums per cluster and
component (at most k x d rows a task), Spark adds them up and the driver holds the
k new centroids, nothing else.  The blocks are a written table: a lost executor costs
the tasks it had.  Equal vectors are spread over blocks by their ids, so a vector
that a third of the rows share is no hot spot.

Nulls: a vector that is null, has another length or holds a null, NaN or infinite
component is left out, as is a row without ``vec_id``.  Rows that repeat a vec_id are
vectors of their own.  Ties go to the smaller cluster.  No vectors: no rows.  With
fewer than k vectors each is a centroid at first.  Components are kept within
+-2**27, so that every distance fits a long.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import id_array, save

#: vectors of a block
BLOCK_ROWS = 512
#: bits of a component that the curve orders by
CURVE_BITS = 2
#: bound of a component; whole-number products of components below EXACT are exact in doubles
LIMIT = 1 << 27
EXACT = 1 << 21


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, kept within the limit."""
    return np.clip(np.floor(vectors * float(scale)), -LIMIT, LIMIT).astype(np.int32)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row (components 0 .. 2**bits - 1) on the Hilbert curve, as a row of
    bytes in comparison order: the components are unwound from the top bit down into the
    transposed index, Gray-coded, and their bits interleaved."""
    x = points.astype(np.uint32).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(dims):
            high = (x[i] & np.uint32(q)) != 0
            swap = np.where(high, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where((x[-1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    x, c = x.astype(np.int64), c.astype(np.int64)
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:  # doubles hold every sum, and multiply faster
        x, c = x.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def candidates(x: np.ndarray, low: np.ndarray, high: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be the nearest of a vector in the block."""
    c = c.astype(np.int64)
    low, high = low.astype(np.int64), high.astype(np.int64)
    gap = np.maximum(np.maximum(low - c, c - high), 0)
    at_least = (gap * gap).sum(1)
    middle = np.abs(2 * c - (low + high))
    guide = int(np.argmin((middle.astype(np.float64) ** 2).sum(1)))
    return np.flatnonzero(at_least <= squared_distances(x, c[guide:guide + 1]).max())


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector of a block."""
    near = candidates(x, low, high, c)
    d = squared_distances(x, c[near])
    best = d.argmin(1)  # the first of equals, and candidates ascend
    return near[best].astype(np.int32), d[np.arange(len(x)), best]


def kept_vectors(vectors: DataFrame, dims: int, column: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col(column).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & (F.size(column) == dims)).where(~odd)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")))


def _matrix(column, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dims)


def component_ranges(kept: DataFrame, dims: int, scale: int) -> np.ndarray:
    """Smallest and largest value of each component, dims x 2."""
    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = whole(_matrix(batch.column(0), dims), scale)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low), pa.array(high)],
                                             names=["i", "low", "high"])
    out = np.zeros((dims, 2), dtype=np.int64)
    parts = kept.select("v").mapInArrow(extremes, "i int, low int, high int")
    for r in parts.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        out[r.i] = r.low, r.high
    return out


def blocks_of(kept: DataFrame, dims: int, scale: int) -> DataFrame:
    """The written table of blocks in curve order: (ids, points, low, high); points, low
    and high are little-endian 32-bit numbers."""
    ranges = component_ranges(kept, dims, scale)
    low, span = ranges[:, 0], np.maximum(ranges[:, 1] - ranges[:, 0] + 1, 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(_matrix(batch.column(1), dims), scale)
            cells = ((x.astype(np.int64) - low) << CURVE_BITS) // span
            keys = hilbert_keys(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k.tobytes() for k in keys], pa.binary()),
                 pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())], names=["vec_id", "key", "point"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = [], []

        def block(n):
            x = np.frombuffer(b"".join(points[:n]), dtype="<i4").reshape(n, dims)
            return {"ids": ids[:n], "points": x.tobytes(), "low": x.min(0).tobytes(), "high": x.max(0).tobytes()}
        for batch in batches:
            ids += batch.column(0).to_pylist()
            points += batch.column(1).to_pylist()
            out = []
            while len(ids) >= BLOCK_ROWS:
                out.append(block(BLOCK_ROWS))
                del ids[:BLOCK_ROWS], points[:BLOCK_ROWS]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=kind)
        if ids:
            yield pa.RecordBatch.from_pylist([block(len(ids))], schema=kind)
    kind = pa.schema([("ids", pa.list_(pa.int64())), ("points", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
    ordered = (kept.mapInArrow(keyed, "vec_id bigint, key binary, point binary")
               .repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id").select("vec_id", "point"))
    return save(ordered.mapInArrow(cut, "ids array<bigint>, points binary, low binary, high binary"), "vector-blocks")


def _blocks(batch: pa.RecordBatch, dims: int):
    for ids, points, low, high in zip(*(batch.column(name).to_pylist() for name in ("ids", "points", "low", "high"))):
        yield (np.array(ids, dtype=np.int64), np.frombuffer(points, dtype="<i4").reshape(-1, dims),
               np.frombuffer(low, dtype="<i4"), np.frombuffer(high, dtype="<i4"))


def moved(blocks: DataFrame, c: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floor(sum / count) per component; empty clusters stay."""
    k, dims = c.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, x, low, high in _blocks(batch, dims):
                cluster, _ = nearest(x, low, high, c)
                n += np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                met, first = np.unique(cluster[order], return_index=True)
                total[met] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(met, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(met)), pa.int32()),
             pa.array(np.repeat(n[met], dims)), pa.array(total[met].ravel())], names=["cluster", "i", "n", "total"])
    parts = blocks.mapInArrow(sums, "cluster int, i int, n bigint, total bigint")
    out = c.copy()
    for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"),
                                               F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[r.cluster, r.i] = int(r.total) // r.n
    return out


def start_order(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def cluster(vectors: DataFrame, *, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
            column: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    The first centroids are the k vectors with the smallest sha256 of ``seed:vec_id``
    (equal ids: in order of their components)."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims, column)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    start = kept.orderBy(start_order(seed), "v").limit(k).collect()
    if not start:
        return spark.createDataFrame([], schema)
    c = whole(np.array([r.v for r in start], dtype=np.float64), scale).astype(np.int64)
    blocks = blocks_of(kept, dims, scale)
    for _ in range(rounds):
        c = moved(blocks, c)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, low, high in _blocks(batch, dims):
                near, distance = nearest(x, low, high, c)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])
    table = save(blocks.mapInArrow(assigned, "vec_id bigint, cluster int, distance bigint"), "vector-clusters")
    sums = {r.cluster: r.total for r in table.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = {n: hashlib.sha256(",".join(map(str, c[n].tolist())).encode()).hexdigest() for n in sums}
    clusters = spark.createDataFrame([(n, total, sum(sums.values(), Decimal(0)), digests[n]) for n, total in sums.items()],
                                     "cluster int, total decimal(38,0), of_all decimal(38,0), centroid_sha256 string")
    # one row per cluster: k rows at most
    return (table.join(F.broadcast(clusters), "cluster")
            .select("vec_id", "cluster", "distance", F.col("total").cast("bigint").alias("cluster_inertia"),
                    F.col("of_all").cast("bigint").alias("inertia"), "centroid_sha256"))
