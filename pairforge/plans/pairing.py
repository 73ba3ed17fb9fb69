"""Pairing queries on ``conversations``: a conversation stands in for a
contract, its even turns for the source-side functions and its odd turns
for the decompiled side; the pair number (turn div 2) is the selector."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash_sql
from pairforge.operators import pairs, splits
from pairforge.plans.registry import query
from pairforge.session import written
from pairforge.sources.tables import load

SEED = 42


def conversation_views(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    base = conv.select(F.col("conv_id").alias("codehash"), F.expr("turn div 2").alias("selector"),
                       "turn", "text")
    src = base.filter(F.col("turn") % 2 == 0).drop("turn")
    dec = base.filter(F.col("turn") % 2 == 1).drop("turn")
    return src, dec


_VIEWS_SQL = """
src AS (SELECT conv_id AS codehash, turn // 2 AS selector, text FROM conversations WHERE turn % 2 = 0),
dec AS (SELECT conv_id AS codehash, turn // 2 AS selector, text FROM conversations WHERE turn % 2 = 1),
matched AS (SELECT s.codehash, s.selector, s.text AS src_text, d.text AS dec_text
            FROM src s JOIN dec d ON s.codehash = d.codehash AND s.selector = d.selector)"""

_POS_NEG_SQL = f"""
picks AS (
  SELECT codehash,
         arg_min({{'selector': selector, 'src_text': src_text, 'dec_text': dec_text}},
                 {dhash_sql(SEED, "'pick'", 'codehash', 'selector')}) AS p,
         ({dhash_sql(SEED, "'coin'", 'codehash')}) % 2 = 1 AS positive
  FROM matched GROUP BY codehash),
dec_idx AS (
  SELECT codehash, selector, text AS dec_text,
         row_number() OVER (PARTITION BY codehash ORDER BY selector) - 1 AS fidx,
         count(*) OVER (PARTITION BY codehash) AS fcnt
  FROM dec),
ranks AS (
  SELECT codehash, fcnt, row_number() OVER (ORDER BY codehash) - 1 AS rank, count(*) OVER () AS n_owners
  FROM dec_idx WHERE fidx = 0 AND codehash IN (SELECT codehash FROM src)),
neg AS (
  SELECT p.codehash, p.p, (r.rank + 1 + ({dhash_sql(SEED, "'partner'", 'p.codehash')}) % (r.n_owners - 1)) % r.n_owners AS prank
  FROM picks p JOIN ranks r ON p.codehash = r.codehash
  WHERE NOT p.positive AND r.n_owners > 1),
pairs AS (
  SELECT 1 AS label, codehash AS codehash1, codehash AS codehash2, p.selector AS selector1,
         p.selector AS selector2, p.src_text AS func1, p.dec_text AS func2
  FROM picks WHERE positive
  UNION ALL
  SELECT 0, n.codehash, q.codehash, n.p.selector, f.selector, n.p.src_text, f.dec_text
  FROM neg n JOIN ranks q ON q.rank = n.prank
  JOIN dec_idx f ON f.codehash = q.codehash
   AND f.fidx = ({dhash_sql(SEED, "'func'", 'n.codehash')}) % q.fcnt)"""


@query("pair_split_counts", sql=f"""
WITH {_VIEWS_SQL},{_POS_NEG_SQL},
ranked AS (SELECT label, row_number() OVER (ORDER BY codehash1) - 1 AS rk, count(*) OVER () AS n FROM pairs)
SELECT CASE WHEN rk < floor(n * 0.7::DOUBLE) THEN 'train'
            WHEN rk < floor(n * 0.7::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'valid' ELSE 'test' END AS split,
       label, count(*) AS n_pairs
FROM ranked GROUP BY 1, 2""")
def pair_split_counts(spark, sf_dir):
    """Flagship: J1 -> J4 -> T1 -> A1 (pairs per split and label), on keys alone."""
    src, dec = conversation_views(spark, sf_dir)
    chosen = written(pairs.choose_pairs(src, dec, seed=SEED), "chosen-pairs")
    sp = splits.ordered_split(chosen, ["codehash1"])
    return sp.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_pairs"))


@query("match_pairs", sql=f"""
WITH {_VIEWS_SQL}
SELECT codehash, selector, length(src_text) AS src_chars, length(dec_text) AS dec_chars,
       md5(src_text || '|' || dec_text) AS pair_md5
FROM matched""")
def match_pairs_q(spark, sf_dir):
    src, dec = conversation_views(spark, sf_dir)
    m = pairs.match_pairs(src, dec)
    return m.select("codehash", "selector", F.length("src_text").cast("bigint").alias("src_chars"),
                    F.length("dec_text").cast("bigint").alias("dec_chars"),
                    F.md5(F.concat_ws("|", "src_text", "dec_text")).alias("pair_md5"))


@query("both_sides_semi", sql="""
SELECT conv_id, turn, length(text) AS n_chars FROM conversations u
WHERE role = 'user' AND length(text) > 0
  AND EXISTS (SELECT 1 FROM conversations a WHERE a.conv_id = u.conv_id AND a.role = 'assistant'
              AND length(a.text) > 0)""")
def both_sides_semi(spark, sf_dir):
    """J2 + P3: user turns of conversations that also have an assistant side."""
    conv = load(spark, sf_dir, "conversations").filter(F.length("text") > 0)
    user = conv.filter(F.col("role") == "user").select(F.col("conv_id").alias("codehash"), "turn", "text")
    asst = conv.filter(F.col("role") == "assistant").select(F.col("conv_id").alias("codehash"))
    out = pairs.both_sides(user, asst)
    return out.select(F.col("codehash").alias("conv_id"), "turn", F.length("text").cast("bigint").alias("n_chars"))


@query("unpivot_pairs", sql=f"""
WITH {_VIEWS_SQL},
k AS (SELECT *, row_number() OVER (ORDER BY codehash, selector) - 1 AS k FROM matched)
SELECT 2 * k AS id, 'contract' AS type, codehash, selector, md5(src_text) AS text_md5 FROM k
UNION ALL
SELECT 2 * k + 1, 'decompiled', codehash, selector, md5(dec_text) FROM k""")
def unpivot_pairs_q(spark, sf_dir):
    src, dec = conversation_views(spark, sf_dir)
    out = pairs.unpivot_pairs(pairs.match_pairs(src, dec), start_id=0)
    return out.select("id", "type", "codehash", "selector", F.md5("text").alias("text_md5"))


@query("pos_neg_pairs", sql=f"""
WITH {_VIEWS_SQL},{_POS_NEG_SQL}
SELECT label, codehash1, codehash2, selector1, selector2, md5(func1) AS func1_md5, md5(func2) AS func2_md5
FROM pairs""")
def pos_neg_pairs_q(spark, sf_dir):
    src, dec = conversation_views(spark, sf_dir)
    pn = pairs.pos_neg_pairs(src, dec, seed=SEED)
    return pn.select("label", "codehash1", "codehash2", "selector1", "selector2",
                     F.md5("func1").alias("func1_md5"), F.md5("func2").alias("func2_md5"))


@query("pretrain_split", sql=f"""
WITH {_VIEWS_SQL},
k AS (SELECT *, row_number() OVER (ORDER BY codehash, selector) - 1 AS k FROM matched),
recs AS (SELECT 2 * k AS id, 'contract' AS type, CAST(codehash AS VARCHAR) AS codehash, src_text AS text FROM k
         UNION ALL SELECT 2 * k + 1, 'decompiled', CAST(codehash AS VARCHAR), dec_text FROM k),
r AS (SELECT *, row_number() OVER (ORDER BY {dhash_sql(SEED, 'id')}, id) - 1 AS rk, count(*) OVER () AS n FROM recs),
s AS (SELECT *, ceil(n * 0.3::DOUBLE) AS held FROM r)
SELECT id, type, codehash, md5(text) AS text_md5,
       CASE WHEN rk < n - held THEN 'train'
            WHEN rk < n - held + (held - ceil(held * 0.33333::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
FROM s""")
def pretrain_split(spark, sf_dir):
    """J3 + W1 -> K2 (JSONL append) -> S4 (typed read) -> T4 (shuffled 70/20/10)."""
    from pairforge.session import scratch_path
    from pairforge.sources import datasets, writers
    src, dec = conversation_views(spark, sf_dir)
    recs = pairs.unpivot_pairs(pairs.match_pairs(src, dec), start_id=0)
    path = scratch_path(spark, "pretrain-jsonl")
    writers.write_jsonl(recs.select("id", "text", "type", F.col("codehash").cast("string").alias("codehash")), path)
    back = datasets.read_pretrain_jsonl(spark, path)
    sp = splits.random_split(back, ["id"], seed=SEED)
    return sp.select("id", "type", "codehash", F.md5("text").alias("text_md5"), "split")
