from pyspark.sql import functions as F

from pairforge.operators import pairs, simhash


def _views(spark, n_owners=40, per_owner=5):
    rows = [(f"c{o:03d}", s, f"text {o} {s} " * (1 + (o + s) % 4)) for o in range(n_owners) for s in range(per_owner)]
    src = spark.createDataFrame(rows, "codehash string, selector int, text string")
    dec = spark.createDataFrame([(c, s, t.upper()) for c, s, t in rows if (s + len(c)) % 3 != 0],
                                "codehash string, selector int, text string")
    return src, dec


def test_pos_neg_properties_and_partition_independence(spark):
    src, dec = _views(spark)
    got = pairs.pos_neg_pairs(src, dec, seed=3).collect()
    assert len(got) == 40                                      # one pair per contract with matches
    for r in got:
        if r.label == 1:
            assert r.codehash1 == r.codehash2 and r.selector1 == r.selector2
        else:
            assert r.codehash1 != r.codehash2
    again = pairs.pos_neg_pairs(src.repartition(7), dec.repartition(3), seed=3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    labels = {r.label for r in got}
    assert labels == {0, 1}


def test_single_owner_has_no_negative(spark):
    src = spark.createDataFrame([("a", 1, "x")], "codehash string, selector int, text string")
    got = pairs.pos_neg_pairs(src, src, seed=1).collect()
    assert all(r.label == 1 for r in got)


def test_unpivot_ids_interleave(spark):
    src, dec = _views(spark, 5, 3)
    m = pairs.match_pairs(src, dec)
    u = pairs.unpivot_pairs(m, start_id=100).collect()
    ids = sorted(r.id for r in u)
    assert ids == list(range(100, 100 + 2 * m.count()))
    assert all((r.id % 2 == 0) == (r.type == "contract") for r in u)


def test_distance_symmetric_and_candidates_with_hot_group(spark):
    texts = [("hot", i, "alpha beta gamma %d delta %d" % (i, i * 7)) for i in range(300)]
    texts += [("cold%d" % g, i, "word%d other%d thing %d" % (g, i, g * i)) for g in range(5) for i in range(4)]
    df = spark.createDataFrame(texts, "g string, id long, text string")
    fp = {r.id: (r.fp_hi, r.fp_lo) for r in simhash.simhash(df.filter("g = 'hot'"), "id", "text").collect()}
    a, b = fp[1], fp[2]
    one = spark.createDataFrame([(a[0], a[1], b[0], b[1])], "ah long, al long, bh long, bl long")
    r = one.select(simhash.distance(F.col("ah"), F.col("al"), F.col("bh"), F.col("bl")).alias("x"),
                   simhash.distance(F.col("bh"), F.col("bl"), F.col("ah"), F.col("al")).alias("y")).collect()[0]
    assert r.x == r.y
    cands = simhash.review_candidates(df, ["g"], "id", "text", seed=5).collect()
    for c in cands:
        assert c.id_a < c.id_b and c.distance > 10 and 1 <= c.n_tries <= 26
    counts = {r.g: r.n_pairs for r in simhash.group_pair_counts(df, ["g"]).collect()}
    assert counts["hot"] == 300 * 299 // 2 and counts["cold0"] == 6


def test_candidates_and_packing_do_not_depend_on_partitioning(spark):
    from pairforge.operators import features as Z
    from pairforge.operators.index import dense_index
    texts = [("g%d" % (i % 4), i, ("lorem ipsum %d dolor %d sit amet " % (i, i * i)) * (1 + i % 5)) for i in range(120)]
    df = spark.createDataFrame(texts, "g string, id long, text string")
    a = simhash.review_candidates(df.repartition(2), ["g"], "id", "text", seed=9).collect()
    b = simhash.review_candidates(df.repartition(9), ["g"], "id", "text", seed=9).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 4
    ids = df.select("id", Z.hashed_ids(F.split("text", " ")).alias("ids"))
    p1 = Z.pack_blocks(dense_index(ids.repartition(3), ["id"], "idx"), "idx", "ids", block=16, batch_rows=25).collect()
    p2 = Z.pack_blocks(dense_index(ids.repartition(8), ["id"], "idx", num_partitions=5), "idx", "ids", block=16,
                       batch_rows=25).collect()
    assert sorted(map(tuple, p1)) == sorted(map(tuple, p2)) and len(p1) > 10


def test_partner_needs_both_sides(spark):
    src, dec = _views(spark, 12, 3)
    extra = spark.createDataFrame([("zzz", s, "only decompiled") for s in range(50)],
                                  "codehash string, selector int, text string")
    got = pairs.pos_neg_pairs(src, dec.unionByName(extra), seed=4).collect()
    assert got and all(r.codehash2 != "zzz" for r in got)


def test_fingerprints_count_every_shingle_by_code_points(spark):
    import hashlib
    texts = ["The \U00010400\U00010401 cat, the cat!", "", "ab", "aaaaaaaa", "!?", None]
    df = spark.createDataFrame([*enumerate(texts), (0, "more of it")], "id int, text string")

    def shingles(text):
        c = "".join(x for x in text.lower() if x.isalnum() or x == "_")
        return [int(hashlib.md5(c[i:i + 4].encode()).hexdigest()[16:], 16) for i in range(max(len(c) - 3, 1))]
    for r in simhash.simhash(df, "id", "text").collect():
        found = [v for k, t in [*enumerate(texts), (0, "more of it")] if k == r.id and t is not None for v in shingles(t)]
        want = sum(1 << i for i in range(64) if sum((v >> i & 1) * 2 - 1 for v in found) > 0)
        assert (r.fp_hi, r.fp_lo) == (want >> 32, want & (1 << 32) - 1)
    assert "explode" not in simhash.simhash(df, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
