"""Label analysis and encoding.

A label vocabulary is a table that rows are joined with; no label list
reaches the driver.  ``multi_hot`` and ``multi_hot_decode`` take a list that
the caller has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.operators.index import dense_index


def distinct_labels(df: DataFrame, col: str = "label") -> DataFrame:
    """A4: distinct labels as strings; list-valued labels are exploded."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.ArrayType):
        c = F.explode(c)
    return df.select(c.cast("string").alias("label")).distinct()


def label_vocab(df: DataFrame, col: str = "label", drop=("-1",), total: str | None = None) -> DataFrame:
    """Union of labels over all splits, sorted, ``-1`` removed, with ids
    (and, with ``total``, the number of labels)."""
    labels = distinct_labels(df, col).filter(~F.col("label").isin(list(drop)))
    return dense_index(labels, ["label"], "label_id", total=total)


def unseen_labels(df: DataFrame, col: str = "label", split_col: str = "split",
                  base: str = "train") -> DataFrame:
    """Labels of the other splits that never occur in ``base``."""
    seen = df.filter(F.col(split_col) == base).select(F.col(col).cast("string").alias("label")).distinct()
    other = (df.filter(F.col(split_col) != base)
               .select(split_col, F.col(col).cast("string").alias("label")).distinct())
    return other.join(seen, "label", "left_anti")


def require_classes(vocab: DataFrame, at_least: int = 2) -> DataFrame:
    """A classifier needs two labels or more; the check reads that many rows."""
    n = len(vocab.limit(at_least).collect())
    if n < at_least:
        raise ValueError(f"{n} label(s), a classifier needs at least {at_least}")
    return vocab


def label_sets(df: DataFrame, key: str, col: str, vocab: DataFrame) -> DataFrame:
    """F13 by a join with the vocabulary table: per key ``names`` (its labels in id
    order), ``ids`` and ``n_labels``.  ``vocab``: label, label_id, n_labels."""
    ids = df.select(key, F.col(col).cast("string").alias("label")).distinct().join(vocab, "label")
    return (ids.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("label_id", "label"))).alias("_l"),
                                 F.first("n_labels").alias("n_labels"))
            .select(key, F.col("_l.label").alias("names"), F.col("_l.label_id").alias("ids"), "n_labels"))


def dense_hot(ids: Column, n: Column) -> Column:
    """The multi-hot vector of ``n`` places with 1 at ``ids``."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.array_contains(ids, i).cast("int"))


def multi_hot(labels: Column, vocab: list) -> Column:
    """multi-hot vector over ``vocab``."""
    v = F.array(*[F.lit(x) for x in vocab])
    return F.transform(v, lambda x: F.when(F.array_contains(labels, x), 1).otherwise(0))


def multi_hot_decode(hot: Column, vocab: list) -> Column:
    """names whose position is 1."""
    v = F.array(*[F.lit(x) for x in vocab])
    return F.filter(v, lambda x, i: hot[i] == 1)


def label_to_id(df: DataFrame, vocab: DataFrame, col: str = "label") -> DataFrame:
    """Label -> id through a join with the vocabulary table."""
    return df.join(vocab.select(F.col("label").alias(col), "label_id"), col, "left")


def task_type(df: DataFrame, col: str = "label") -> str:
    """Regression for float labels, multi-label for lists, else single."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "regression"
    if isinstance(dt, T.ArrayType):
        return "multi_label_classification"
    return "single_label_classification"
