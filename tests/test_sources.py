import json
import os
import tempfile

from pyspark.sql import functions as F

from pairforge.sources import corpus, datasets, writers
from pairforge.streaming.incremental import incremental_append


def _write(root, rel, content):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(content)


def test_contract_corpus_cases(spark):
    root = tempfile.mkdtemp(prefix="pf-corpus-")
    _write(root, "aa/1.json", json.dumps({"codehash": "0x1111", "bytecode": "60",
                                          "source": {"SourceCodes": [{"Code": "contract A {}"}, {"Code": "contract B {}"}]}}))
    _write(root, "aa/2.json", json.dumps({"codehash": "0x2222", "bytecode": "60", "source": None}))
    _write(root, "bb/3.json", json.dumps({"codehash": "0x3333", "bytecode": "60"}))
    _write(root, "bb/4.json", "{not json")
    _write(root, "bb/5.json", json.dumps({"codehash": "0x5555", "bytecode": "60", "source": {"SourceCodes": []}}, indent=2))
    _write(root, "bb/readme.txt", "ignore me")
    _write(root, "cc/6.json", json.dumps({"codehash": "0x1111", "bytecode": "61",
                                          "source": {"SourceCodes": [{"Code": "contract C {}"}]}}))
    raw = corpus.read_contracts(spark, root)
    assert raw.count() == 6                       # readme.txt is not read
    status = {r.status: r.n for r in corpus.corpus_status(raw).collect()}
    assert status == {"unreadable": 1, "no_source": 2, "ok": 3}
    src = {r.codehash: r.text for r in corpus.contract_sources(raw).collect()}
    assert src == {"0x1111": "contract C {}", "0x5555": ""}   # last path wins; null/absent source dropped


def test_decompiled_reader(spark):
    root = tempfile.mkdtemp(prefix="pf-dec-")
    _write(root, "1111/0x1111aa.sol", "function Unresolved_a9059cbb() {\n return; \n}\n")
    got = corpus.read_decompiled(spark, root).collect()
    assert len(got) == 1 and got[0].codehash == "0x1111aa" and got[0].text.count("\n") == 3


def test_split_loader_and_writers(spark):
    root = tempfile.mkdtemp(prefix="pf-ds-")
    _write(root, "train.json", json.dumps([{"sentence": "a", "label": 1}, {"sentence": "b", "label": 0}]))
    _write(root, "valid.json", json.dumps([{"sentence": "c", "label": 1}]))
    df = datasets.load_splits(spark, {"train": os.path.join(root, "train.json"),
                                      "validation": os.path.join(root, "valid.json")})
    assert sorted((r.split, r.sentence) for r in df.collect()) == [("train", "a"), ("train", "b"), ("validation", "c")]
    assert datasets.eval_split(df) == "validation"
    out = os.path.join(root, "pred")
    p = df.select(F.monotonically_increasing_id().alias("index"),
                  writers.prediction_text("single_label_classification", F.col("label"), ["neg", "pos"]).alias("prediction"))
    writers.write_predictions(p, out)
    back = spark.read.option("sep", "\t").option("header", True).csv(out)
    assert back.columns == ["index", "prediction"] and sorted(r.prediction for r in back.collect()) == ["neg", "pos", "pos"]
    m = spark.createDataFrame([(0.5, 0.25)], "acc double, f1 double")
    rows = sorted((r.metric, r.value) for r in writers.metrics_rows(m, "r1", "valid").collect())
    assert rows == [("acc", 0.5), ("f1", 0.25)]


def test_stream_equals_batch_and_ids_continue(spark):
    root = tempfile.mkdtemp(prefix="pf-stream-")
    src = os.path.join(root, "in")
    df = spark.range(0, 500).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("v"))
    df.repartitionByRange(5, "event_id").write.parquet(src)
    out = os.path.join(root, "out")
    n = incremental_append(spark, src, df.schema, out, os.path.join(root, "ckpt"),
                           lambda d: d.filter(F.col("v") != 3), ["event_id"], glob="*.parquet")
    got = spark.read.parquet(out)
    assert n == 5
    batch = df.filter(F.col("v") != 3)
    assert got.select("event_id", "v").exceptAll(batch).count() == 0 and got.count() == batch.count()
    assert sorted(r.id for r in got.collect()) == list(range(batch.count()))


def test_stream_resumes_and_continues_ids(spark):
    root = tempfile.mkdtemp(prefix="pf-stream2-")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ckpt"))
    first = spark.range(0, 100).select(F.col("id").alias("event_id"))
    first.repartition(2).write.parquet(os.path.join(src, "a"))
    schema = first.schema
    assert incremental_append(spark, os.path.join(src, "*"), schema, out, ck, lambda d: d, ["event_id"],
                              glob="*.parquet") == 2
    second = spark.range(100, 130).select(F.col("id").alias("event_id"))
    second.coalesce(1).write.parquet(os.path.join(src, "b"))
    assert incremental_append(spark, os.path.join(src, "*"), schema, out, ck, lambda d: d, ["event_id"],
                              glob="*.parquet") == 1
    got = spark.read.parquet(out)
    assert got.count() == 130 and sorted(r.id for r in got.collect()) == list(range(130))
    new_ids = sorted(r.id for r in got.filter(F.col("event_id") >= 100).collect())
    assert new_ids == list(range(100, 130))


def test_csv_files_of_a_split_are_bounded(spark, tmp_path, monkeypatch):
    import glob

    from pairforge.sources import datasets, writers
    monkeypatch.setattr(writers, "CSV_ROWS", 10)
    df = spark.range(0, 35, 1, 1).selectExpr("'train' AS split", "id", "concat('a\n\"', id) AS text")
    files = writers.write_split_files(df, str(tmp_path), "csv", ["train"])
    assert len(glob.glob(f"{files['train']}/part-*.csv")) == 4
    back = datasets.load_splits(spark, files, df.drop("split").schema)
    assert sorted((r.id, r.text) for r in back.collect()) == sorted((r.id, r.text) for r in df.collect())
