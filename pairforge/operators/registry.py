"""Task and metric registries.

A task names how the files of its splits are read and labelled and which metrics
score it; a metric name maps to aggregate columns over ``pred``/``label``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.operators import metrics as M
from pairforge.sources.datasets import read_pair_examples


@dataclass(frozen=True)
class Task:
    name: str
    labels: tuple[str, ...]
    output_mode: str          # classification | regression
    metric: str
    reader: Callable[[SparkSession, str, str], DataFrame] = read_pair_examples

    def read(self, spark: SparkSession, files: dict[str, str]) -> DataFrame:
        """All splits: the reader's columns, ``split`` and ``label_id`` (F16: the label's place
        among the task's labels, null for another; F17: a float for regression)."""
        frames = [self.reader(spark, path, split).withColumn("split", F.lit(split)) for split, path in files.items()]
        rows = functools.reduce(DataFrame.unionByName, frames)
        if self.output_mode == "regression":
            return rows.withColumn("label_id", F.col("label").try_cast("double"))
        names = F.array(*(F.lit(name) for name in self.labels))
        place = F.array_position(names, F.col("label").cast("string"))
        return rows.withColumn("label_id", F.when(place > 0, place - 1))


# The clone-detection task of the original scripts.
TASKS = {
    "codesearch": Task("codesearch", ("0", "1"), "classification", "acc_and_f1"),
    "clone": Task("clone", ("0", "1"), "classification", "acc_and_f1"),
}


def task(name: str) -> Task:
    if name not in TASKS:
        raise KeyError(f"task not found: {name}")
    return TASKS[name]


def _acc(p, y):
    return [M.accuracy(p, y).alias("accuracy")]


def _f1(p, y):
    return [M.f1_binary(p, y).alias("f1")]


def _acc_f1(p, y):
    acc, f1 = M.accuracy(p, y), M.f1_binary(p, y)
    return [acc.alias("acc"), f1.alias("f1"), ((acc + f1) / 2).alias("acc_and_f1")]


def _mse(p, y):
    return [M.mse(p, y).alias("mse")]


METRICS: dict[str, Callable[[Column, Column], list[Column]]] = {
    "accuracy": _acc, "f1": _f1, "acc_and_f1": _acc_f1, "mse": _mse,
}

DEFAULT_METRIC = {"regression": "mse", "single_label_classification": "accuracy",
                  "multi_label_classification": "f1"}


def evaluate(df: DataFrame, metric: str, pred: str = "pred", label: str = "label") -> DataFrame:
    """One aggregation computing the named metric(s)."""
    if metric not in METRICS:
        raise KeyError(f"unknown metric {metric}")
    return df.agg(*METRICS[metric](F.col(pred), F.col(label)))
