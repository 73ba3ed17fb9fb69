"""Near-duplicate fingerprints and review candidates on ``documents``
(a (lang, source) key stands in for a function signature)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.functions.hashing import dhash_sql
from pairforge.operators import simhash as S
from pairforge.plans.registry import query
from pairforge.session import scratch_path
from pairforge.sources import records, reviews
from pairforge.sources.tables import load

SEED = 42


def _fp_sql(src: str) -> str:
    sums = ",\n".join(
        f"sum((({'lo' if i < 32 else 'hi'} >> {i % 32}) & 1) * 2 - 1) AS s{i}" for i in range(64))
    pack_lo = " + ".join(f"(CASE WHEN s{i} > 0 THEN {1 << i} ELSE 0 END)" for i in range(32))
    pack_hi = " + ".join(f"(CASE WHEN s{i + 32} > 0 THEN {1 << i} ELSE 0 END)" for i in range(32))
    return f"""
c AS (SELECT doc_id, regexp_replace(lower(text), '[^\\pL\\pN_]', '', 'g') AS s FROM {src}),
sh AS (SELECT doc_id, md5(substr(s, i, 4)) AS h
       FROM (SELECT doc_id, s, unnest(range(1, greatest(length(s) - 3, 1) + 1)) AS i FROM c)),
b AS (SELECT doc_id, ('0x' || substr(h, 25, 8))::BIGINT AS lo, ('0x' || substr(h, 17, 8))::BIGINT AS hi FROM sh),
agg AS (SELECT doc_id, {sums} FROM b GROUP BY doc_id),
fp AS (SELECT doc_id, CAST({pack_hi} AS BIGINT) AS fp_hi, CAST({pack_lo} AS BIGINT) AS fp_lo FROM agg)"""


@query("simhash", sql=f"WITH {_fp_sql('documents')} SELECT doc_id, fp_hi, fp_lo FROM fp")
def simhash_q(spark, sf_dir):
    """64-bit simhash of every whole document."""
    docs = load(spark, sf_dir, "documents", spread=True)
    return S.simhash(docs, "doc_id", "text")


@query("group_pairs", sql="""
SELECT lang, source, n_funcs, n_pairs FROM (
  SELECT lang, source, count(*) AS n_funcs, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS n_pairs
  FROM documents GROUP BY lang, source) WHERE n_pairs > 1""")
def group_pairs(spark, sf_dir):
    """Pairs available per key (counted, not enumerated)."""
    docs = load(spark, sf_dir, "documents").select("lang", "source")
    return S.group_pair_counts(docs, ["lang", "source"]).select("lang", "source", "n_funcs", "n_pairs")


_G = ["lang", "source"]


_DRAWS_SQL = f"""{_fp_sql('documents')},
m AS (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1 AS m FROM documents),
k AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source HAVING count(*) * (count(*) - 1) / 2 > 1),
d AS (SELECT lang, source, n, t, {dhash_sql(SEED, 'lang', 'source', 't', "'a'")} % n AS i,
             {dhash_sql(SEED, 'lang', 'source', 't', "'b'")} % (n - 1) AS j0
      FROM k, range(26) r(t)),
d2 AS (SELECT lang, source, t, i, CASE WHEN j0 >= i THEN j0 + 1 ELSE j0 END AS j FROM d),
s AS (SELECT d2.lang, d2.source, d2.t, ma.doc_id AS id_i, mb.doc_id AS id_j,
             bit_count(xor(fa.fp_hi, fb.fp_hi)) + bit_count(xor(fa.fp_lo, fb.fp_lo)) AS distance
      FROM d2 JOIN m ma ON ma.lang = d2.lang AND ma.source = d2.source AND ma.m = d2.i
              JOIN m mb ON mb.lang = d2.lang AND mb.source = d2.source AND mb.m = d2.j
              JOIN fp fa ON fa.doc_id = ma.doc_id JOIN fp fb ON fb.doc_id = mb.doc_id)"""


@query("simhash_pairs", sql=f"""
WITH {_DRAWS_SQL},
f AS (SELECT lang, source, arg_min({{'t': t, 'a': id_i, 'b': id_j, 'd': distance}}, t) AS c
      FROM s WHERE distance > 10 GROUP BY lang, source)
SELECT lang, source, CAST(c.t + 1 AS BIGINT) AS n_tries, least(c.a, c.b) AS id_a, greatest(c.a, c.b) AS id_b,
       CAST(c.d AS BIGINT) AS distance FROM f""")
def simhash_pairs(spark, sf_dir):
    """A16 + J8/J9: one review candidate per key, whole texts fingerprinted."""
    docs = load(spark, sf_dir, "documents", spread=True)
    return S.review_candidates(docs, _G, "doc_id", "text", seed=SEED)


@query("reviewed_pairs", sql=f"""
WITH {_DRAWS_SQL},
far AS (SELECT lang, source, t, least(id_i, id_j) AS a, greatest(id_i, id_j) AS b, distance FROM s WHERE distance > 10),
f1 AS (SELECT lang, source, arg_min({{'a': a, 'b': b, 'd': distance}}, t) AS c FROM far GROUP BY lang, source),
f2 AS (SELECT x.lang, x.source, arg_min({{'a': a, 'b': b, 'd': distance}}, t) AS c
       FROM far x JOIN f1 ON f1.lang = x.lang AND f1.source = x.source WHERE (a, b) <> (f1.c.a, f1.c.b) GROUP BY x.lang, x.source),
runs AS (SELECT 1 AS run, * FROM f1 UNION ALL SELECT 2, * FROM f2),
docs AS (SELECT doc_id, regexp_replace(text, '{T.LINE_BREAKS}', '', 'g') AS line FROM documents)
SELECT run, lang, source, c.a AS id_a, c.b AS id_b, CAST(c.d AS BIGINT) AS distance, c.d % 2 = 0 AS similar,
       md5(concat_ws('<SPLIT>', c.a, c.b, x.line, y.line)) AS line_md5
FROM runs JOIN docs x ON x.doc_id = c.a JOIN docs y ON y.doc_id = c.b""")
def reviewed_pairs(spark, sf_dir):
    """K6 + J9: two rounds of proposals.  The first round's answers (here: an even distance is
    similar) are recorded, twice under one run, and not proposed again; all answers are exported as
    reviewed-pair lines and read back."""
    docs = load(spark, sf_dir, "documents", spread=True)
    store, lines = scratch_path(spark, "reviews"), scratch_path(spark, "review-lines")
    for run in (1, 2):
        proposed = S.review_candidates(docs, _G, "doc_id", "text", seed=SEED, reviewed=reviews.current(spark, store))
        answers = proposed.select("id_a", "id_b", (F.col("distance") % 2 == 0).alias("similar"), "distance", *_G)
        reviews.record(answers, store, run)
    reviews.record(reviews.current(spark, store).where("run = 1"), store, 1)  # a replay
    known = reviews.current(spark, store)
    text = docs.select("doc_id", "text")
    full = (known.join(text.select(F.col("doc_id").alias("id_a"), F.col("text").alias("func_a")), "id_a")
            .join(text.select(F.col("doc_id").alias("id_b"), F.col("text").alias("func_b")), "id_b")
            .select(F.col("id_a").alias("codehash_a"), F.col("id_b").alias("codehash_b"), "func_a", "func_b"))
    records.write_lines(records.ok_rows(records.encode_review(full)), lines)
    parts = T.split_keep_empty(F.col("value"), T.REVIEW_DELIM)
    back = records.read_lines(spark, lines).select(parts[0].cast("bigint").alias("id_a"), parts[1].cast("bigint").alias("id_b"),
                                                   F.md5("value").alias("line_md5"))
    return known.join(back, ["id_a", "id_b"]).select("run", *_G, "id_a", "id_b", "distance", "similar", "line_md5")
