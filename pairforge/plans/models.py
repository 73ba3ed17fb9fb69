"""Scoring queries: batch scoring with a model function and the clone
baseline over conversation pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.operators import pairs, scoring, splits
from pairforge.operators import registry as R
from pairforge.plans.pairing import SEED, conversation_views
from pairforge.plans.registry import query
from pairforge.session import written
from pairforge.sources import writers


def split_pairs(src, dec):
    """The chosen pairs, split on their keys, with texts."""
    chosen = written(pairs.choose_pairs(src, dec, seed=SEED), "chosen-pairs")
    return pairs.with_texts(splits.ordered_split(chosen, ["codehash1"]), src, dec)


@query("batch_scores")
def batch_scores(spark, sf_dir):
    """V5 + F11 + K8: positive and negative conversation pairs scored in Arrow
    batches by the fitted clone model (512 features); the prediction is the
    argmax of the logits, and each row's scored-instance line is built."""
    src, dec = conversation_views(spark, sf_dir)
    pn = split_pairs(src, dec)
    s = scoring.score_pairs(pn).withColumn("logits", F.transform("logits", lambda v: F.round(v, 4)))
    return s.select("codehash1", "codehash2", "label", "split",
                    scoring.argmax_prediction(F.col("logits")).alias("pred"), "logits",
                    writers.scored_lines(["label", "codehash1", "codehash2", "func1", "func2"], "logits").alias("scored_line"))


@query("clone_baseline")
def clone_baseline(spark, sf_dir):
    """V6 + A5-A7: logistic regression on hashed pair features, trained on
    the train split of the positive/negative pairs, scored on the rest."""
    src, dec = conversation_views(spark, sf_dir)
    pn = split_pairs(src, dec)
    scored = scoring.train_clone_baseline(pn)
    task = R.task("clone")
    out = scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                      *R.METRICS[task.metric](F.col("prediction"), F.col("label").cast("int")))
    return out.select("split", "n", F.round("acc", 6).alias("acc"), F.round("f1", 6).alias("f1"),
                      F.round("acc_and_f1", 6).alias("acc_and_f1"))
