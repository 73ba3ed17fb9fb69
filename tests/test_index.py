from pyspark.sql import Window
from pyspark.sql import functions as F

from pairforge.operators.index import dense_index, group_index, offset_slice, shuffled_head


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dense_index_equals_row_number_any_partitioning(spark):
    base = spark.range(0, 2000).select((F.col("id") * 7919 % 2003).alias("k"), F.col("id"))
    expect = _rows(base.withColumn("idx", F.row_number().over(Window.orderBy("k", "id")) - 1), "k", "id", "idx")
    for parts in (1, 3, 16):
        got = dense_index(base.repartition(parts), ["k", "id"], "idx", num_partitions=parts + 2)
        assert _rows(got, "k", "id", "idx") == expect


def test_dense_index_total(spark):
    got = dense_index(spark.range(0, 37), ["id"], "idx", total="n").collect()
    assert {r.n for r in got} == {37} and sorted(r.idx for r in got) == list(range(37))


def test_group_index_hot_group(spark):
    # one key holds most rows: the index inside each group is still 0..n-1
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("g"), "id")
    got = group_index(df, ["g"], ["id"], "gi", size="gn").collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.id, r.gi, r.gn))
    for g, xs in by.items():
        xs.sort()
        assert [x[1] for x in xs] == list(range(len(xs)))
        assert {x[2] for x in xs} == {len(xs)}


def test_offset_slice_both_strategies(spark):
    df = spark.range(0, 500)
    small = [r.id for r in offset_slice(df, ["id"], 10, 5).collect()]
    big = sorted(r.id for r in offset_slice(df, ["id"], 10, 5, name="i").collect())
    assert sorted(small) == big == list(range(10, 15))


def test_shuffled_head_positions(spark):
    got = shuffled_head(spark.range(0, 1000), 42, ["id"], 10, "pos").collect()
    assert sorted(r.pos for r in got) == list(range(10))


def test_take_first_per_split(spark):
    from pairforge.operators.index import take_first_per_split
    df = spark.range(0, 100).withColumn("split", F.when(F.col("id") < 80, "train").otherwise("test"))
    got = sorted((r.split, r.id) for r in take_first_per_split(df, "split", ["id"], 3).collect())
    assert got == [("test", 80), ("test", 81), ("test", 82), ("train", 0), ("train", 1), ("train", 2)]
