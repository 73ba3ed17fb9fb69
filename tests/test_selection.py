"""Exact rank selection against sorting, over many rounds (a small sample forces them)."""

import pytest
from pyspark.sql import functions as F

from pairforge.operators import selection, splits
from pairforge.operators.index import dense_index, offset_slice


@pytest.fixture
def small_sample(monkeypatch):
    monkeypatch.setattr(selection, "SAMPLE", 64)


def test_rank_keys_equal_sorted_order(spark, small_sample):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.concat(F.lit("x"), F.col("id") % 13).alias("b"))
    want = sorted((r.a, r.b) for r in df.collect())
    ranks = [0, 1, 49, 2500, 3500, 4998, 4999, 5000]
    got = selection.rank_keys(df, ["a", "b"], ranks)
    assert got[5000] is None
    assert {r: got[r].key for r in ranks[:-1]} == {r: want[r] for r in ranks[:-1]}


def test_rank_keys_ties_and_nulls(spark, small_sample):
    # a third of the rows share one key, some keys are null: null sorts first
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 100 != 1, F.col("id")).alias("a"))
    want = sorted((r.a for r in df.collect()), key=lambda v: (v is not None, v or 0))
    for rank, hit in selection.rank_keys(df, ["a"], [0, 5, 40, 500, 1100, 2999]).items():
        assert hit.key == (want[rank],)
        assert (hit.below, hit.equal) == (want.index(want[rank]), want.count(want[rank]))


def test_splits_are_exact_over_rounds(spark, small_sample):
    for n in (0, 1, 3, 10, 999, 4000):
        df = spark.range(n).select((F.col("id") * 31 % 4001).alias("id"))
        order = sorted(r.id for r in df.collect())
        a, b, _ = splits.split_sizes(n)
        got = {r.id: r.split for r in splits.ordered_split(df, ["id"]).collect()}
        assert got == {k: "train" if i < a else "valid" if i < a + b else "test" for i, k in enumerate(order)}
        got = {r.id for r in splits.percent_split(df, ["id"], 5).where("split = 'validation'").collect()}
        assert got == set(order[:round(n * 5 / 100.0)])


def test_slices_and_numbers_over_rounds(spark, small_sample):
    df = spark.range(4000).select((F.col("id") * 31 % 4001).alias("id"), F.lit("wide").alias("text"))
    order = sorted(r.id for r in df.collect())
    assert sorted(r.id for r in offset_slice(df, ["id"], 1234, 500).collect()) == order[1234:1734]
    assert {r.id: r.i for r in offset_slice(df, ["id"], 3990, 50, "i").collect()} == {
        k: i for i, k in enumerate(order) if i >= 3990}
    assert offset_slice(df, ["id"], 9000, 5).count() == 0
    got = dense_index(df, ["id"], "i", first=100).collect()
    assert len(got) == 4000 and {r.id: r.i for r in got if r.i is not None and r.i < 100} == {
        k: i for i, k in enumerate(order[:100])}


def test_nothing_stays_persisted_and_no_text_is_read(spark):
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cut = splits.ordered_split(df, ["doc_id"])
    cut.groupBy("split").count().collect()
    dense_index(df, ["doc_id"]).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before
    plan = cut.groupBy("split").count()._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "rangepartitioning" not in plan
