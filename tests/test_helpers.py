import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pairforge.operators import index, labels, metrics, quarantine, registry, rows
from pairforge.sources import datasets, writers


def test_split_edits_and_casts(spark):
    df = spark.createDataFrame([("a", "train", "1.5"), ("b", "dev", "x"), ("c", "validation", "2")],
                               "t string, split string, label string")
    renamed = rows.rename_split(df, "dev", "validation")
    assert sorted((r.t, r.split) for r in renamed.collect()) == [("a", "train"), ("b", "validation")]
    assert [r.t for r in rows.remove_splits(df, ["dev", "validation"]).collect()] == ["a"]
    lab = {r.t: (r.label, r.error) for r in rows.regression_label(df, strict=False).collect()}
    assert lab["a"] == (1.5, None) and lab["b"] == (None, "label_not_float")
    ids = [r.g for r in df.select(rows.example_id(F.col("split"), F.lit(3)).alias("g")).collect()]
    assert ids[0] == "train-3"
    assert df.select(rows.append_text(F.col("t"), F.lit("dfg")).alias("x")).first().x == "a dfg"


def test_loaders(spark):
    root = tempfile.mkdtemp(prefix="pf-load-")
    p = os.path.join(root, "pre.jsonl")
    with open(p, "w") as f:
        for i in range(5):
            f.write(json.dumps({"id": i, "text": f"t{i}", "type": "contract", "codehash": "0x"}) + "\n")
    assert [r.text for r in datasets.first_texts(spark, p, 3).collect()] == ["t0", "t1", "t2"]
    assert datasets.read_pretrain_jsonl(spark, p).schema["id"].dataType.typeName() == "long"
    assert datasets.load_lm_text(spark, p).count() == 5
    csv = os.path.join(root, "lm.csv")
    with open(csv, "w") as f:
        f.write("body,other\nhello,1\nworld,2\n")
    assert sorted(r.text for r in datasets.load_lm_text(spark, csv).collect()) == ["hello", "world"]
    with pytest.raises(ValueError):
        datasets.load_splits(spark, {"train": p, "validation": csv})


def test_writers(spark):
    df = spark.createDataFrame([(1, "zé", [0.5, -1.0], "train")], "label int, f string, logits array<double>, split string")
    line = df.select(writers.scored_lines(["label", "f"]).alias("x"))
    assert line.first().x == "1<CODESPLIT>z<CODESPLIT>0.5<CODESPLIT>-1.0"
    root = tempfile.mkdtemp(prefix="pf-w-")
    writers.write_split_text(df.withColumn("text", F.col("f")), os.path.join(root, "t"))
    assert os.path.isdir(os.path.join(root, "t", "split=train"))


def test_label_lookup_and_registry(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "label string, label_id long")
    df = spark.createDataFrame([("b",), ("z",)], "label string")
    got = {r.label: r.label_id for r in labels.label_to_id(df, vocab).collect()}
    assert got == {"b": 1, "z": None}
    preds = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (1, 1)], "pred int, label int")
    r = registry.evaluate(preds, registry.task("clone").metric).first()
    assert r.acc == 0.5 and abs(r.f1 - 2 / 3) < 1e-12
    with pytest.raises(KeyError):
        registry.task("nope")


def test_quarantine_and_index_helpers(spark):
    df = spark.range(0, 10).withColumn("t", F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.lit("x")))
    c = quarantine.classify(df, [("empty", F.col("t") == "")])
    assert quarantine.good(c).count() == 6 and quarantine.bad(c).count() == 4
    assert {(r.stage, r.status): r.n for r in quarantine.counters(c, "s").collect()} == {("s", "ok"): 6, ("s", "empty"): 4}
    ids = index.interleaved_ids(spark.range(0, 4), ["id"], start_id=10).collect()
    assert sorted(r.pair_idx for r in ids) == [10, 12, 14, 16]
    b = spark.range(0, 5).select(index.batch_number("id", 2).alias("b")).collect()
    assert [r.b for r in b] == [0, 0, 1, 1, 2]
    g = spark.range(0, 20).withColumn("k", F.col("id") % 2)
    picks = index.pick_per_group(g, 1, ["k"], ["id"], "id", "pick").collect()
    assert len(picks) == 2 and all(r.pick % 2 == r.k for r in picks)
    one = spark.createDataFrame([([7.0],)], "a array<double>")
    assert one.select(metrics.squeeze(F.col("a")).alias("x")).first().x == 7.0
    n = spark.range(0, 1).select(metrics.sample_count(F.lit(10), 3).alias("x"),
                                 metrics.combined_score([F.lit(0.5), F.lit(1.0)]).alias("y")).first()
    assert (n.x, n.y) == (3, 0.75)


def test_table_cache_builds_once(spark):
    from pairforge.sources.cache import cached_table
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    key = {"kind": "test", "nonce": os.urandom(4).hex()}
    assert cached_table(spark, key, build).count() == 5
    assert cached_table(spark, key, build).count() == 5
    assert len(calls) == 1


def test_non_blank_uses_python_space_set(spark):
    df = spark.createDataFrame([("  　\t",), (" ",), (" x ",), ("",)], "line string")
    assert [r.line for r in rows.non_blank(df, "line").collect()] == [" x "]
