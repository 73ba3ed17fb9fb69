import pytest
from pyspark.sql import functions as F

from pairforge.sources import store


def _functions(spark, ids):
    # a third of the functions share one signature
    sig = F.when(F.col("id") % 3 == 0, F.lit("transfer(address,uint256)")).otherwise(
        F.concat(F.lit("f"), F.format_string("%05d", F.col("id")), F.lit("()")))
    return ids.select(F.concat(F.lit("0x"), F.md5(F.col("id").cast("string"))).alias("codehash"), sig.alias("signature"),
                      F.concat(F.lit("body "), "id").alias("text"), "id")


def test_lookup_reads_few_files_and_appends_count_once(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append(_functions(spark, spark.range(0, 3000)), path, "a", file_rows=200)
    store.append(_functions(spark, spark.range(3000, 4000)), path, "b", file_rows=200)
    total = store.manifest(spark, path).count()
    assert total == 20
    again = store.append(_functions(spark, spark.range(3000, 4000)), path, "b", file_rows=200)
    assert again.startswith("b-") and store.manifest(spark, path).agg(F.sum("n")).first()[0] == 4000
    one = store.lookup(spark, path, ["f00007()"])
    assert [r.id for r in one.collect()] == [7]
    assert len(one.inputFiles()) <= 2
    hot = store.lookup(spark, path, ["transfer(address,uint256)"])
    assert hot.count() == 1334 and 4 <= len(hot.inputFiles()) < total
    both = store.lookup(spark, path, ["f00007()", "f03001()", "nothing()"], ["id"])
    assert sorted(r.id for r in both.collect()) == [7, 3001] and len(both.inputFiles()) <= 5
    assert store.lookup(spark, path, ["zzz()"]).count() == 0
    store.compact(spark, path, str(tmp_path / "one"), file_rows=500)
    assert store.manifest(spark, str(tmp_path / "one")).count() == 8
    assert len(store.lookup(spark, str(tmp_path / "one"), ["f00007()"]).inputFiles()) == 1


def test_unfinished_generations_and_empty_stores(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        store.lookup(spark, path, ["f()"])
    store.append(_functions(spark, spark.range(0, 10)), path)
    # files of an append that never reached the manifest
    _functions(spark, spark.range(0, 10)).write.parquet(path + "/data/batch-lost")
    assert store.lookup(spark, path, ["f00001()"]).count() == 1
    store.append(_functions(spark, spark.range(0)), path)
    none = _functions(spark, spark.range(5)).withColumn("signature", F.lit(None).cast("string"))
    store.append(none, path)
    assert store.manifest(spark, path).agg(F.sum("n")).first()[0] == 10
