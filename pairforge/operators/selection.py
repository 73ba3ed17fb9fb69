"""Exact order statistics without sorting the table.

``rank_keys`` finds the keys that stand at given ranks of a total order.  Each
round draws a bounded random sample of the keys still in question, takes a few
sample keys around the wanted quantile as cuts and counts, in one aggregation
that returns one row, how many keys lie below and at each cut.  The counts are
exact, so the wanted key is known to lie between two neighbouring cuts (the
sample only decides how quickly the range shrinks).  A range of at most
``SAMPLE`` keys is fetched.  Only the key columns are read, nothing is shuffled
by key and nothing is persisted: rows are then labelled by comparing their key
with the keys found.

``range_cuts`` gives cut keys that deal the rows to ranges of similar size, and
``range_of`` the range of a row as a plain expression: the same row is in the same
range in every job, whatever is recomputed.

Keys compare as structs: a null sorts before every value, as in ORDER BY.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: keys that a round fetches (about so many: a random sample of them, or all of a small range)
SAMPLE = 16384
#: ranges of one numbering at most; each is sorted by one task, spilling if it must
RANGES = 128


class Found(NamedTuple):
    """The key at a rank, the number of keys before it and of keys equal to it."""
    key: tuple
    below: int
    equal: int


def _cols(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in cols]


def key_struct(order_cols) -> Column:
    return F.struct(*(c.alias(f"k{i}") for i, c in enumerate(_cols(order_cols))))


def _key_type(df: DataFrame, order_cols) -> T.StructType:
    return df.select(key_struct(order_cols).alias("k")).schema["k"].dataType


def key_literal(key: tuple, kind: T.StructType) -> Column:
    return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind.fields)))


def _sort_key(key: tuple):
    return tuple((v is not None, (math.isnan(v), v) if isinstance(v, float) else v) if v is not None else (False,)
                 for v in key)


def _sample(keys: DataFrame, size: int) -> list[tuple]:
    """All keys of a range of at most SAMPLE keys, else about SAMPLE random ones, in order."""
    if size > SAMPLE:
        keys = keys.where(F.rand(7) < SAMPLE / size)
    return sorted((tuple(r.k) for r in keys.collect()), key=_sort_key)


def _between(keys: DataFrame, kind: T.StructType, low: tuple | None, high: tuple | None) -> DataFrame:
    if low is not None:
        keys = keys.where(F.col("k") > key_literal(low, kind))
    return keys if high is None else keys.where(F.col("k") < key_literal(high, kind))


def rank_keys(df: DataFrame, order_cols, ranks: list[int], n: int | None = None) -> dict[int, Found | None]:
    """The key at each 0-based rank of the order; None beyond the last row."""
    kind = _key_type(df, order_cols)
    keys = df.select(key_struct(order_cols).alias("k"))
    n = keys.count() if n is None else n
    found: dict[int, Found | None] = {r: None for r in ranks}
    todo = [(None, None, 0, n, sorted({r for r in ranks if 0 <= r < n}))]  # low and high excluded
    while todo:
        low, high, before, size, wanted = todo.pop()
        if not wanted:
            continue
        part = _between(keys, kind, low, high)
        sample = _sample(part, size)
        if size <= SAMPLE:
            for r in wanted:
                key = sample[r - before]
                found[r] = Found(key, before + sum(_sort_key(k) < _sort_key(key) for k in sample), sample.count(key))
            continue
        cuts = []
        for r in wanted:
            share = (r - before + 0.5) / size
            spread = math.sqrt(len(sample) * share * (1 - share)) + 1
            cuts += [sample[min(max(round(share * len(sample) + z * spread), 0), len(sample) - 1)]
                     for z in (-4, -2, -1, 0, 1, 2, 4)] if sample else []
        cuts = sorted(set(cuts), key=_sort_key)
        if not cuts:  # an empty draw: draw again
            todo.append((low, high, before, size, wanted))
            continue
        literals = [key_literal(c, kind) for c in cuts]
        counts = part.agg(*(F.count_if(F.col("k") < c).alias(f"b{i}") for i, c in enumerate(literals)),
                          *(F.count_if(F.col("k") == c).alias(f"e{i}") for i, c in enumerate(literals))).first()
        edges = [(low, before, 0)] + [(c, before + counts[f"b{i}"], counts[f"e{i}"]) for i, c in enumerate(cuts)]
        for i, (cut, below, equal) in enumerate(edges):
            start = below + equal
            end = edges[i + 1][1] if i + 1 < len(edges) else before + size
            upper = edges[i + 1][0] if i + 1 < len(edges) else high
            found.update({r: Found(cut, below, equal) for r in wanted if below <= r < start})
            todo.append((cut, upper, start, end - start, [r for r in wanted if start <= r < end]))
    return found


def label_by_rank(df: DataFrame, order_cols, bounds: list[int], names, name: str, n: int | None = None) -> DataFrame:
    """Add ``name``: names[0] for the first bounds[0] rows of the order, names[1] for those up to
    bounds[1], ..., the last name for the rest.  Rows with equal keys share a label (that of the
    first of them), so the key has to identify a row for exact sizes."""
    kind = _key_type(df, order_cols)
    found = rank_keys(df, order_cols, bounds, n)
    key, label = key_struct(order_cols), F.lit(names[-1])
    for bound, value in reversed(list(zip(bounds, names))):
        hit = found[bound] if bound > 0 else None
        if hit is not None:
            before = key < key_literal(hit.key, kind)
            if hit.below < bound:  # the bound falls among equal keys
                before = before | (key == key_literal(hit.key, kind))
            label = F.when(before, F.lit(value)).otherwise(label)
        elif bound > 0:  # all rows come before this bound
            label = F.lit(value)
    return df.withColumn(name, label)


def range_cuts(df: DataFrame, order_cols, ranges: int) -> list[tuple]:
    """Cut keys that deal the rows to at most ``ranges`` ranges of similar size (from a bounded
    sample; the number and place of the cuts change no result)."""
    keys = df.select(key_struct(order_cols).alias("k"))
    sample = _sample(keys, keys.count())
    ranges = min(ranges, RANGES, max(len(sample) // 128, 1))
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}, key=_sort_key)


def range_of(key: Column, cuts: list[tuple], kind: T.StructType) -> Column:
    """The number of cuts at or below the key, by a tree of comparisons."""
    def tree(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(key < key_literal(cuts[mid], kind), tree(a, mid)).otherwise(tree(mid + 1, b))
    return tree(0, len(cuts))
