from pyspark.sql import functions as F

from pairforge.operators import splits


def _sizes(df):
    c = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    return c.get("train", 0), c.get("valid", 0), c.get("test", 0)


def test_ordered_split_sizes(spark):
    # FIXTURES: n=10 -> 7/2/1; n=1 -> 0/0/1; n=1000 -> 700/200/100
    for n, want in ((10, (7, 2, 1)), (1, (0, 0, 1)), (1000, (700, 200, 100))):
        assert _sizes(splits.ordered_split(spark.range(0, n), ["id"])) == want
        assert splits.split_sizes(n) == want


def test_ordered_split_is_prefix(spark):
    got = splits.ordered_split(spark.range(0, 50), ["id"]).collect()
    train = sorted(r.id for r in got if r.split == "train")
    assert train == list(range(35))


def test_random_split_partitions_rows(spark):
    df = spark.range(0, 1000)
    got = splits.random_split(df, ["id"], seed=1)
    tr, va, te = _sizes(got)
    assert (tr, va, te) == (700, 200, 100)   # held = ceil(300) = 300, test = ceil(99.999) = 100
    assert got.select("id").distinct().count() == 1000
    again = splits.random_split(df.repartition(5), ["id"], seed=1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_group_split_never_splits_a_group(spark):
    df = spark.range(0, 2000).withColumn("g", (F.col("id") % 37).cast("string"))
    got = splits.group_split(df, [F.col("g")])
    assert got.groupBy("g").agg(F.countDistinct("split").alias("k")).filter("k > 1").count() == 0


def test_percent_split(spark):
    got = splits.percent_split(spark.range(0, 100), ["id"], 5).collect()
    assert sorted(r.id for r in got if r.split == "validation") == list(range(5))
