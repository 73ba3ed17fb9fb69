"""Evaluation metrics as one-pass aggregates.

Each metric is an aggregate ``Column`` (or a small DataFrame transform), so
many of them share one scan and the partial aggregation happens map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def argmax(a: Column) -> Column:
    """0-based index of the maximum, first one on ties."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def threshold_hot(a: Column, at: float = 0.0) -> Column:
    """1 where the logit is above ``at``."""
    return F.transform(a, lambda x: F.when(x > at, 1).otherwise(0))


def squeeze(a: Column) -> Column:
    """``[x] -> x``."""
    return F.element_at(a, 1)


def accuracy(pred: Column, label: Column) -> Column:
    """A5."""
    return F.count_if(pred == label) / F.count(F.lit(1))


def f1_binary(pred: Column, label: Column) -> Column:
    """Positive class 1; 0 when nothing is positive."""
    tp = F.count_if((pred == 1) & (label == 1))
    fp = F.count_if((pred == 1) & (label != 1))
    fn = F.count_if((pred != 1) & (label == 1))
    den = 2 * tp + fp + fn
    return F.when(den == 0, F.lit(0.0)).otherwise(2 * tp / den)


def acc_and_f1(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """A7 (+A10): acc, f1 and their mean in one aggregation."""
    p, y = F.col(pred), F.col(label)
    out = df.agg(F.count(F.lit(1)).alias("n"), accuracy(p, y).alias("acc"), f1_binary(p, y).alias("f1"))
    return out.withColumn("acc_and_f1", (F.col("acc") + F.col("f1")) / 2)


def combined_score(metrics: list[Column]) -> Column:
    """A10: mean of the metrics when there is more than one."""
    if len(metrics) == 1:
        return metrics[0]
    total = metrics[0]
    for m in metrics[1:]:
        total = total + m
    return total / len(metrics)


def micro_counts(pred_hot: Column, true_hot: Column) -> list[Column]:
    """A8 cell counts: tp, fp, fn over all (row, class) cells."""
    z = F.arrays_zip(pred_hot.alias("p"), true_hot.alias("y"))

    def count(cond):
        return F.sum(F.aggregate(z, F.lit(0), lambda acc, c: acc + F.when(cond(c), 1).otherwise(0))).cast("bigint")
    return [count(lambda c: (c["p"] == 1) & (c["y"] == 1)).alias("tp"),
            count(lambda c: (c["p"] == 1) & (c["y"] == 0)).alias("fp"),
            count(lambda c: (c["p"] == 0) & (c["y"] == 1)).alias("fn")]


def micro_f1_from_counts(tp: Column, fp: Column, fn: Column) -> Column:
    den = 2 * tp + fp + fn
    return F.when(den == 0, F.lit(0.0)).otherwise(2 * tp / den)


def mse(pred: Column, label: Column) -> Column:
    """A9."""
    return F.avg(F.pow(pred - label, 2))


def masked_accuracy_counts(preds: Column, labels: Column, ignore: int = -100) -> list[Column]:
    """(correct, counted) over positions whose label is not ``ignore``."""
    z = F.arrays_zip(preds.alias("p"), labels.alias("y"))
    correct = F.aggregate(z, F.lit(0), lambda a, c: a + F.when((c["y"] != ignore) & (c["p"] == c["y"]), 1).otherwise(0))
    counted = F.aggregate(z, F.lit(0), lambda a, c: a + F.when(c["y"] != ignore, 1).otherwise(0))
    return [F.sum(correct).cast("bigint").alias("n_correct"), F.sum(counted).cast("bigint").alias("n_counted")]


def cross_entropy(logits: Column, label: Column) -> Column:
    """Per-row loss ``logsumexp(logits) - logits[label]`` (stable form)."""
    m = F.array_max(logits)
    lse = m + F.log(F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - m)))
    return lse - F.element_at(logits, label + 1)


def perplexity(mean_loss: Column) -> Column:
    """exp(mean loss); overflow gives +Infinity."""
    return F.exp(mean_loss)


def sample_count(n: Column, limit: int | None) -> Column:
    """``min(limit, n)``."""
    return n if limit is None else F.least(n, F.lit(limit))


def best_run(runs: DataFrame, epoch: str = "epoch", metric: str = "acc") -> DataFrame:
    """The epoch with the best metric; the first one wins ties."""
    return runs.agg(F.max_by(F.col(epoch), F.struct(F.col(metric), -F.col(epoch))).alias("best_epoch"),
                    F.max(metric).alias("best_acc"))


def running_best(runs: DataFrame, epoch: str = "epoch", metric: str = "acc") -> DataFrame:
    """Best metric of all earlier epochs and whether this one improves it.
    Runs are one row per epoch, so the unpartitioned window is tiny."""
    w = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.max(metric).over(w)
    return (runs.withColumn("prev_best", prev)
                .withColumn("improved", (F.col(metric) > F.coalesce(F.col("prev_best"), F.lit(float("-inf")))).cast("int")))


def length_stats(df: DataFrame, length_col: str, group_cols=()) -> DataFrame:
    """A3: min, max, mean and exact linear-interpolated quartiles (numpy's
    default).  ``percentile`` keeps a value->count map per group, so memory
    follows the number of distinct lengths, not rows."""
    x = F.col(length_col)
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("min_len"), F.max(x).alias("max_len"),
                 F.avg(x).alias("avg_len"), F.percentile(x, 0.25).alias("q1"), F.percentile(x, 0.75).alias("q3"))
