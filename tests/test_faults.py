"""One test per fault that a review proved."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pairforge.operators.bpe import _choose
from pairforge.operators.extract import extract_functions
from pairforge.operators.index import offset_slice
from pairforge.operators.labels import label_vocab, require_classes
from pairforge.operators.pairs import pos_neg_pairs
from pairforge.sources.cache import cached_table, content_stamp
from pairforge.sources.datasets import read_by_extension
from pairforge.sources.records import PAIR_FIELDS, decode_lenient, encode_records
from pairforge.streaming.incremental import incremental_append


def _write(spark, root, name, low, high):
    path = os.path.join(root, name)
    spark.range(low, high).select(F.col("id").alias("key")).coalesce(1).write.parquet(path)
    return path


def test_two_streams_append_to_one_table(spark):
    root = tempfile.mkdtemp(prefix="pf-streams-")
    out = os.path.join(root, "out")
    schema = spark.range(1).select(F.col("id").alias("key")).schema
    for name, low, high in (("a", 0, 100), ("b", 100, 130)):
        incremental_append(spark, _write(spark, root, name, low, high), schema, out,
                           os.path.join(root, f"ck-{name}"), lambda df: df, ["key"])
    got = spark.read.parquet(out)
    assert sorted(r.key for r in got.collect()) == list(range(130))
    assert sorted(r.id for r in got.collect()) == list(range(130))


def test_line_break_inside_a_delimiter_is_quarantined(spark):
    rows = [(1, "h1", "h2", "x<CODE\nSPLIT>y", "f"), (0, "h3", "h4", "a\nb", "c"), (0, "h5", "h6", "x<CODE", "SPLIT>")]
    lines = encode_records(spark.createDataFrame(rows, "label int, codehash1 string, codehash2 string, func1 string, func2 string"))
    got = {r.codehash1: r.error for r in lines.collect()}
    assert got["h1"] == "delimiter_in_field" and got["h3"] is None
    clean = lines.where("error IS NULL").select("value")
    assert decode_lenient(clean, names=PAIR_FIELDS).count() == clean.count()


def test_symbol_merged_with_itself_bounds_later_merges():
    # eight spaces x 100 (700 pairs) and "xy" x 150: one at a time the second merge is (2020, 2020)
    top = [("20 20", 700), ("78 79", 150)]
    assert _choose(top, 2, 2, False) == [("20", "20")]


def test_offset_slice_has_one_plan(spark):
    got = offset_slice(spark.range(100), ["id"], 90, 20)
    assert sorted(r.id for r in got.collect()) == list(range(90, 100))


def test_functions_around_yul_functions_stay(spark):
    yul = ('contract C { function outer(uint a) public returns (uint r) { r = a; assembly ("memory-safe") { '
           'function helper(x) -> y { y := add(x, 1) } if r { r := helper(r) } } r = r + 1; } '
           'function next(uint b) public returns (uint q) { q = b + 1; q = q + b; return q; } }')
    got = {r.name: r for r in extract_functions(spark.createDataFrame([("0x1", yul)], "codehash string, text string")).collect()}
    assert set(got) == {"outer", "next"}
    assert got["outer"].text.endswith("r = r + 1; }") and "helper(x)" in got["outer"].text
    assert got["outer"].signature == "outer(uint256)"


def test_cache_follows_the_files(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pf-cache-"), "t")
    spark.range(3).write.parquet(path)
    before = content_stamp(spark.read.parquet(path))
    assert before == content_stamp(spark.read.parquet(path))
    spark.range(3, 5).write.mode("append").parquet(path)
    assert before != content_stamp(spark.read.parquet(path))
    built = []

    def build():
        built.append(1)
        return spark.range(2)
    key = {"kind": "t", "stamp": before, "root": path}
    assert [cached_table(spark, key, build).count() for _ in range(2)] == [2, 2] and len(built) == 1


def test_one_label_is_an_error(spark):
    one = spark.createDataFrame([("a",), ("a",), ("-1",)], "label string")
    with pytest.raises(ValueError):
        require_classes(label_vocab(one))


def test_array_after_a_blank_line(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pf-json-"), "a.json")
    with open(path, "w") as f:
        f.write("\n  \n[{\"a\": 1},\n {\"a\": 2}]\n")
    assert sorted(r.a for r in read_by_extension(spark, path).collect()) == [1, 2]


def test_streams_leave_no_cached_frame(spark):
    root = tempfile.mkdtemp(prefix="pf-streams-")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    incremental_append(spark, _write(spark, root, "c", 0, 10), spark.range(1).select(F.col("id").alias("key")).schema,
                       os.path.join(root, "out"), os.path.join(root, "ck"), lambda df: df, ["key"])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_a_single_owner_is_quarantined(spark):
    for name in ("a", "b", "c", "d", "e", "f"):  # the coin sends some of them to the negatives
        one = spark.createDataFrame([(name, 1, "x"), (name, 2, "y")], "codehash string, selector int, text string")
        rows = pos_neg_pairs(one, one, errors=True).collect()
        assert len(rows) == 1 and (rows[0].error is None) == (rows[0].label == 1)
        assert rows[0].func1 in ("x", "y") and pos_neg_pairs(one, one).count() == rows[0].label


def test_tokens_are_made_once(spark):
    from tests.test_extract import CONTRACT
    df = extract_functions(spark.createDataFrame([("0xabc", CONTRACT)], "codehash string, text string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1 and "Join" not in plan
