import math

from pyspark.sql import functions as F

from pairforge.operators import labels as L
from pairforge.operators import metrics as M


def test_acc_f1_golden(spark):
    df = spark.createDataFrame(list(zip([1, 0, 0, 1, 1], [1, 1, 0, 0, 1])), "pred int, label int")
    r = M.acc_and_f1(df).collect()[0]
    assert r.acc == 0.6 and round(r.f1, 6) == 0.666667 and round(r.acc_and_f1, 6) == 0.633333


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],)], "a array<double>")
    assert df.select(M.argmax(F.col("a")).alias("i")).collect()[0].i == 1


def test_perplexity_and_best_run(spark):
    df = spark.createDataFrame([(math.log(2.0),)], "l double")
    assert abs(df.select(M.perplexity(F.avg("l")).alias("p")).collect()[0].p - 2.0) < 1e-12
    runs = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9)], "epoch int, acc double")
    assert M.best_run(runs).collect()[0].best_epoch == 2
    rb = {r.epoch: r.improved for r in M.running_best(runs).collect()}
    assert rb == {1: 1, 2: 1, 3: 0}


def test_length_stats_golden(spark):
    df = spark.createDataFrame([(x,) for x in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]], "x int")
    r = M.length_stats(df, "x").collect()[0]
    assert (r.min_len, r.max_len, r.avg_len, r.q1, r.q3) == (1, 9, 3.9, 2.25, 5.0)


def test_masked_accuracy_ignores_minus_100(spark):
    df = spark.createDataFrame([([5, 6, 7], [5, -100, 8])], "p array<int>, y array<int>")
    r = df.agg(*M.masked_accuracy_counts(F.col("p"), F.col("y"))).collect()[0]
    assert (r.n_correct, r.n_counted) == (1, 2)


def test_label_vocab_and_multi_hot(spark):
    df = spark.createDataFrame([("b", "train"), ("a", "train"), ("-1", "valid"), ("c", "test")], "label string, split string")
    assert [(r.label, r.label_id) for r in L.label_vocab(df).orderBy("label_id").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    assert [r.label for r in L.unseen_labels(df).collect()] == ["c"] or sorted(r.label for r in L.unseen_labels(df).collect()) == ["-1", "c"]
    vocab = ["a", "b", "c"]
    one = spark.createDataFrame([(["c", "a"],)], "l array<string>")
    r = one.select(L.multi_hot(F.col("l"), vocab).alias("h")).collect()[0]
    assert r.h == [1, 0, 1]
    back = one.select(L.multi_hot_decode(L.multi_hot(F.col("l"), vocab), vocab).alias("d")).collect()[0]
    assert back.d == ["a", "c"]
    assert L.task_type(spark.createDataFrame([(1.0,)], "label double")) == "regression"
