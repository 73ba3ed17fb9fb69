"""Clusters against plain Python; the curve, the boxes and the bounds by their properties."""

import hashlib
import itertools
import math

import numpy as np
import pytest

from pairforge.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, key string, label int"


def plain(rows, k, rounds, dims, scale=256, seed=2):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    c = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in c]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        near = assign()
        for n in range(len(c)):
            own = [v for (_, v), (m, _) in zip(kept, near) if m == n]
            if own:
                c[n] = [sum(column) // len(own) for column in zip(*own)]
    near = assign()
    total = sum(d for _, d in near)
    return sorted((i, n, d, sum(e for m, e in near if m == n), total,
                   hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for (i, _), (n, d) in zip(kept, near))


def _rows(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "c", "k", 1) for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in C.cluster(frame, **options).collect())


@pytest.mark.parametrize("block", [4, 512])
def test_equals_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 8))
    rows = [(i, (middles[i % 6] + 0.1 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, [0.5] * 8) for i in range(60)]  # one vector in many rows
    rows += [(7, rows[9][1]), (7, rows[7][1]), (7, rows[7][1])]  # repeated ids, equal and other vectors
    rows += [(300, None), (301, []), (302, [1.0] * 7), (303, [None] + [1.0] * 7), (304, [math.nan] * 8),
             (305, [math.inf] + [0.0] * 7), (None, [0.0] * 8), (306, [0.0] * 8), (307, [-0.001] * 8)]
    assert _rows(spark, rows, k=9, rounds=5, dims=8) == plain(rows, 9, 5, 8)


def test_few_rows_ties_and_empty(spark):
    assert _rows(spark, [], k=3, dims=2) == []
    assert _rows(spark, [(1, [math.nan, 0.0])], k=3, dims=2) == []
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [-1.0, 0.0])]
    assert _rows(spark, rows, k=40, rounds=2, dims=2) == plain(rows, 40, 2, 2)
    huge = [(1, [1e30, -1e30]), (2, [1e30, 0.0]), (3, [0.0, 0.0])]  # kept within the limit
    assert [r[2] for r in _rows(spark, huge, k=3, rounds=0, dims=2)] == [0, 0, 0]


def test_large_components_are_exact():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-C.LIMIT, C.LIMIT, (40, 16)), rng.integers(-C.LIMIT, C.LIMIT, (5, 16))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
    assert C.squared_distances(x, c).tolist() == want


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in C.hilbert_keys(points, bits)]
    assert len(set(keys)) == len(keys)
    path = points[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_candidates_hold_every_nearest_and_prune():
    rng = np.random.default_rng(3)
    c = rng.integers(-1000, 1000, (30, 6))
    pruned = 0
    for _ in range(50):
        x = rng.integers(-1000, 1000, 6) + rng.integers(-60, 60, (100, 6))
        near = C.candidates(x, x.min(0), x.max(0), c)
        assert set(C.squared_distances(x, c).argmin(1)) <= set(near.tolist())
        pruned += 30 - len(near)
    assert pruned > 600
