"""Packing on a stream, reviewed pairs and one-scan quarantine: replays change nothing."""

import random

from pyspark.sql import functions as F

from pairforge.operators import quarantine as Q
from pairforge.operators import simhash as S
from pairforge.operators.index import running_offset
from pairforge.sources import reviews
from pairforge.streaming import packing


def _batches(spark):
    rnd = random.Random(2)
    rows = [(k, [rnd.randint(5, 99) for _ in range(rnd.choice([0, 1, 3, 40, 7]))]) for k in range(60)]
    cuts = [0, 0, 7, 30, 31, 60]
    frames = [spark.createDataFrame(rows[a:b], "k int, ids array<int>").repartition(3) for a, b in zip(cuts, cuts[1:])]
    return [i for _, ids in rows for i in ids], frames


def _state(spark, out):
    left = packing.rest(spark, out).collect()
    return ({r.block: r.input_ids for r in packing.packed_blocks(spark, out).collect()},
            [(r.start, r.ids) for r in left])


def test_stream_blocks_equal_one_pass_and_replays(spark, tmp_path):
    flat, frames = _batches(spark)
    out, block = str(tmp_path / "packed"), 16
    for k, frame in enumerate(frames):
        packing.pack_batch(frame, ["k"], out, f"{k:09d}", block)
        if k in (2, 4):  # the batch comes again
            packing.pack_batch(frame, ["k"], out, f"{k:09d}", block)
    whole = len(flat) // block
    want = ({b: flat[b * block:(b + 1) * block] for b in range(whole)}, [(whole * block, flat[whole * block:])])
    assert _state(spark, out) == want
    none = str(tmp_path / "none")
    packing.pack_batch(frames[0], ["k"], none, "000000000", block)
    assert _state(spark, none) == ({}, [(0, [])])


def test_running_offset(spark):
    df = spark.range(500).select((F.col("id") * 17 % 503).alias("k"), (F.col("id") % 7).alias("v"))
    total, want = 0, {}
    for r in sorted(df.collect()):
        want[r.k] = total
        total += r.v
    assert {r.k: r.offset for r in running_offset(df.repartition(3), ["k"], "v", num_partitions=4).collect()} == want


def test_reviewed_pairs_are_not_proposed_again(spark, tmp_path):
    path = str(tmp_path / "reviews")
    rnd = random.Random(1)
    docs = spark.createDataFrame([(k, k % 2, " ".join(rnd.choice("abcdefgh") * 6 for _ in range(30))) for k in range(12)],
                                 "doc_id int, g int, text string")
    assert reviews.current(spark, path) is None
    seen = set()
    for run in range(4):
        proposed = S.review_candidates(docs, ["g"], "doc_id", "text", reviewed=reviews.current(spark, path)).collect()
        new = {(r.id_a, r.id_b) for r in proposed}
        assert len(new) == 2 and not new & seen
        seen |= new
        answers = spark.createDataFrame([(b, a, True) for a, b in new] + [(None, 1, True)], "id_a int, id_b int, similar boolean")
        for _ in range(2):
            reviews.record(answers, path, run)
        assert {(r.id_a, r.id_b) for r in reviews.current(spark, path).collect()} == seen
    a, b = min(seen)
    reviews.record(spark.createDataFrame([(a, b, False)], "id_a int, id_b int, similar boolean"), path, 9)
    table = reviews.current(spark, path)
    assert table.count() == len(seen) and [(r.id_a, r.id_b, r.run) for r in table.where("not similar").collect()] == [(a, b, 9)]


def test_write_by_status_counts_in_one_scan(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id").cast("string")).alias("text"))
    checks = [("no_text", F.col("text").isNull()), ("odd", F.col("id") % 2 == 1), ("never", F.col("id") < 0)]
    path = str(tmp_path / "t")
    assert Q.write_by_status(df, checks, path) == {"ok": 40, "no_text": 10, "odd": 50, "never": 0}
    assert [Q.read_status(df, path, n).count() for n in Q.statuses(checks)] == [40, 10, 50, 0]
    assert Q.read_status(df, path, "no_text").columns == ["id", "text"]
    assert Q.write_by_status(df.where("id < 0"), checks, path) == {"ok": 0, "no_text": 0, "odd": 0, "never": 0}
