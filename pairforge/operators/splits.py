"""Dataset splits (T1-T5).  All are exact and reproducible: the keys at the
boundary ranks are selected by counting (``selection``), every row is labelled by
comparing its key with them (no sort, no shuffle, nothing persisted), and random
orders come from ``dhash``."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash
from pairforge.operators.selection import label_by_rank

SPLIT = "split"


def ordered_split(df: DataFrame, order_cols, fractions=(0.7, 0.2),
                  names=("train", "valid", "test")) -> DataFrame:
    """First ``int(0.7 n)`` rows train, next ``int(0.2 n)`` valid, rest test
    (DOUBLE arithmetic, equal to Python's ``int(0.7 * n)``)."""
    n = df.count()
    first, second, _ = split_sizes(n, fractions)
    return label_by_rank(df, order_cols, [first, first + second], names, SPLIT, n)


def random_split(df: DataFrame, key_cols, seed=42, test_size=0.3, second_test_size=0.33333,
                 names=("train", "valid", "test")) -> DataFrame:
    """Two-stage shuffle split with sklearn's sizes: the held-out part
    is ``ceil(0.3 n)`` rows, of which ``ceil(0.33333 * held)`` are test.  Row
    order is a seeded hash order instead of a process RNG."""
    keys = [F.col(k) if isinstance(k, str) else k for k in key_cols]
    n = df.count()
    held = math.ceil(float(n) * float(test_size))
    test = math.ceil(float(held) * float(second_test_size))
    return label_by_rank(df, [dhash(seed, *keys)] + keys, [n - held, n - test], names, SPLIT, n)


def percent_split(df: DataFrame, order_cols, percent: int = 5,
                  names=("validation", "train")) -> DataFrame:
    """The first ``p`` % of rows (boundary rounded half-to-even, like
    percent slicing of datasets) become validation, the rest train."""
    n = df.count()
    return label_by_rank(df, order_cols, [round(float(n) * float(percent) / 100.0)], names, SPLIT, n)


def group_split(df: DataFrame, group_cols, seed=42, fractions=(0.7, 0.2),
                names=("train", "valid", "test")) -> DataFrame:
    """T5: leak-free split -- every row of a group lands in the same split,
    chosen by a hash threshold on the group key (no shuffle at all)."""
    bucket = dhash(seed, *group_cols) % 100
    a = int(round(fractions[0] * 100))
    b = int(round((fractions[0] + fractions[1]) * 100))
    return df.withColumn(SPLIT, F.when(bucket < a, F.lit(names[0]))
                         .when(bucket < b, F.lit(names[1])).otherwise(F.lit(names[2])))


def split_sizes(n: int, fractions=(0.7, 0.2)) -> tuple[int, int, int]:
    """Driver-side T1 sizes for a known n (used in tests)."""
    a = int(fractions[0] * n)
    b = int(fractions[1] * n)
    return a, b, n - a - b
