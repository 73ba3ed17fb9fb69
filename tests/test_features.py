import itertools

from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash
from pairforge.operators import features as Z


def loop_truncate(la, lb, L):
    while la + lb > L:
        if la > lb:
            la -= 1
        else:
            lb -= 1
    return la, lb


def test_truncation_closed_form_equals_loop(spark):
    cases = [(a, b, L) for a, b, L in itertools.product(range(0, 40), range(0, 40), range(0, 50))]
    df = spark.createDataFrame(cases, "la int, lb int, L int")
    got = {}
    for L in (0, 1, 7, 15, 49):
        sub = df.filter(F.col("L") == L)
        la2, lb2 = Z.truncated_pair_lengths(F.col("la"), F.col("lb"), L)
        for r in sub.select("la", "lb", la2.alias("a"), lb2.alias("b")).collect():
            got[(r.la, r.lb, L)] = (r.a, r.b)
    for (a, b, L), v in got.items():
        assert v == loop_truncate(a, b, L), (a, b, L)
    # FIXTURES goldens
    for (a, b, L), want in {(50, 600, 509): (50, 459), (10, 10, 15): (8, 7), (3, 4, 20): (3, 4)}.items():
        assert loop_truncate(a, b, L) == want


def test_pair_feature_golden(spark):
    df = spark.createDataFrame([([11, 12], [21])], "a array<int>, b array<int>")
    r = Z.pair_features(df, "a", "b", max_len=8).collect()[0]
    assert r.input_ids == [2, 11, 12, 3, 21, 3, 0, 0]
    assert r.input_mask == [1, 1, 1, 1, 1, 1, 0, 0]
    assert r.segment_ids == [1, 0, 0, 0, 1, 1, 0, 0]


def test_features_lengths_and_mask_sum(spark):
    rows = [(list(range(5, 5 + i)), list(range(9, 9 + (i * 7) % 23))) for i in range(30)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>")
    for r in Z.pair_features(df, "a", "b", max_len=16).collect():
        assert len(r.input_ids) == len(r.input_mask) == len(r.segment_ids) == 16
        assert sum(r.input_mask) == sum(1 for x in r.input_ids[:sum(r.input_mask)] if True)


def test_pack_blocks_golden(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [4, 5]), (2, [6, 7])], "idx long, ids array<int>")
    got = sorted((r.block, r.input_ids) for r in Z.pack_blocks(df, "idx", "ids", block=3).collect())
    assert got == [(0, [1, 2, 3]), (1, [4, 5, 6])]
    short = spark.createDataFrame([(0, [1])], "idx long, ids array<int>")
    assert Z.pack_blocks(short, "idx", "ids", block=3).count() == 0


def test_mlm_mask_properties(spark):
    df = spark.createDataFrame([(i, [2] + list(range(5, 400)) + [3]) for i in range(20)], "k long, ids array<int>")
    inputs, labels = Z.mlm_mask(F.col("ids"), F.col("k").cast("string"))
    out = df.select("ids", inputs.alias("inp"), labels.alias("lab")).collect()
    chosen = total = 0
    for r in out:
        assert r.inp[0] == 2 and r.inp[-1] == 3 and r.lab[0] == -100 and r.lab[-1] == -100
        for x, i, l in zip(r.ids, r.inp, r.lab):
            if l != -100:
                chosen += 1
                assert l == x
            else:
                assert i == x
        total += len(r.ids) - 2
    assert 0.12 < chosen / total < 0.18


def test_dynamic_pad_multiple_of_8(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (0, [1] * 10), (1, [4])], "b int, ids array<int>")
    for r in Z.dynamic_pad(df, "ids", "b").collect():
        assert r.padded_len % 8 == 0 and len(r.ids) == r.padded_len
    assert Z.block_size(None) == 1024 and Z.block_size(512) == 512 and Z.block_size(4096, 1024) == 1024



def test_blocks_are_shuffled_as_pieces(spark):
    rows = [(k, [k * 100 + j for j in range(n)]) for k, n in enumerate((3, 40, 2, 2, 17, 90, 5))]
    rows = [(k, None if k == 2 else ids) for k, ids in rows]
    df = spark.createDataFrame([*rows, (7, [])], "idx bigint, ids array<int>")
    packed = Z.pack_blocks(df, "idx", "ids", block=16, batch_rows=4, mask_seed=5)
    want = {}
    for batch in (0, 1):
        flat = [i for k, ids in rows if k // 4 == batch for i in ids or []]
        want |= {(batch, b): flat[b * 16:(b + 1) * 16] for b in range(len(flat) // 16)}
    got = packed.collect()
    assert {(r.batch, r.block): r.input_ids for r in got} == want
    draws = packed.select(F.posexplode("mask_draws").alias("i", "r"), dhash(5, F.concat_ws("/", "batch", "block"), "i").alias("d"))
    assert draws.where("r = d").count() == sum(map(len, want.values())) == draws.count()
    assert "posexplode" not in packed._jdf.queryExecution().optimizedPlan().toString()


def test_masking_hashes_a_position_once_and_keeps_nulls(spark):
    df = spark.createDataFrame([("a", [7, 8, 3, 9] * 50), ("b", None), ("c", [])], "k string, ids array<int>")
    inputs, labels = Z.mlm_mask(F.col("ids"), F.col("k"), seed=3)
    masked = df.select("k", "ids", inputs.alias("i"), labels.alias("l"))
    got = {r.k: r for r in masked.collect()}
    assert got["b"].i is None and got["b"].l is None and got["c"].i == got["c"].l == []
    r = df.select("k", F.posexplode("ids").alias("p", "x")).select("p", "x", dhash(3, "k", "p").alias("r")).collect()
    chosen = {t.p for t in r if t.x > 4 and t.r % 10000 < 1500}
    assert {p for p, x in enumerate(got["a"].l) if x != -100} == chosen and chosen
    want = [4 if p in chosen and (t.r >> 14) % 10 < 8 else (t.r >> 24) % 30005 if p in chosen and (t.r >> 14) % 10 == 8 else t.x
            for p, t in enumerate(sorted(r, key=lambda t: t.p))]
    assert got["a"].i == want
    assert "md5(" not in masked._jdf.queryExecution().optimizedPlan().toString()
