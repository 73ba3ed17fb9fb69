"""Splits, shuffles, slices and samples over ``documents`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash_sql
from pairforge.operators import index, splits
from pairforge.plans.registry import query
from pairforge.sources.tables import load

SEED = 42


@query("ordered_split", sql="""
SELECT doc_id, CASE WHEN rk < floor(n * 0.7::DOUBLE) THEN 'train'
                    WHEN rk < floor(n * 0.7::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rk, count(*) OVER () AS n FROM documents)""")
def ordered_split(spark, sf_dir):
    """70/20/10 in file order."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return splits.ordered_split(docs, ["doc_id"]).select("doc_id", "split")


@query("random_split", sql=f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {dhash_sql(SEED, 'doc_id')}, doc_id) - 1 AS rk,
                  count(*) OVER () AS n FROM documents),
s AS (SELECT *, ceil(n * 0.3::DOUBLE) AS held FROM r)
SELECT doc_id, CASE WHEN rk < n - held THEN 'train'
                    WHEN rk < n - held + (held - ceil(held * 0.33333::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
FROM s""")
def random_split(spark, sf_dir):
    """Shuffled 70/20/10 with sklearn's rounding."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return splits.random_split(docs, ["doc_id"], seed=SEED).select("doc_id", "split")


@query("percent_split", sql="""
SELECT doc_id, CASE WHEN rk < round_even(n * 5 / 100.0, 0) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rk, count(*) OVER () AS n FROM documents)""")
def percent_split(spark, sf_dir):
    """First 5 % as validation when no validation file is given."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return splits.percent_split(docs, ["doc_id"], percent=5).select("doc_id", "split")


@query("group_split", sql=f"""
SELECT doc_id, source, CASE WHEN {dhash_sql(SEED, 'source')} % 100 < 70 THEN 'train'
                            WHEN {dhash_sql(SEED, 'source')} % 100 < 90 THEN 'valid' ELSE 'test' END AS split
FROM documents""")
def group_split(spark, sf_dir):
    """T5: all rows of a source land in one split."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source")
    return splits.group_split(docs, [F.col("source")], seed=SEED)


@query("seeded_shuffle_topk", sql=f"""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY h, o_orderkey) - 1 AS pos
FROM (SELECT o_orderkey, o_totalprice, {dhash_sql(SEED, 'o_orderkey')} AS h FROM orders
      ORDER BY h, o_orderkey LIMIT 100)""")
def seeded_shuffle_topk(spark, sf_dir):
    """Seeded shuffle, then the first 100 rows with their position."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return index.shuffled_head(orders, SEED, ["o_orderkey"], 100, "pos")


@query("offset_slice", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 500""")
def offset_slice(spark, sf_dir):
    """Rows [500, 1500) in key order."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return index.offset_slice(orders, ["o_orderkey"], 500, 1000)


@query("sample_keys", sql=f"""
SELECT lang, source, count(*) AS n_sampled FROM (
  SELECT lang, source FROM documents ORDER BY {dhash_sql(SEED, 'doc_id')}, doc_id LIMIT 1000)
GROUP BY lang, source""")
def sample_keys(spark, sf_dir):
    """A reproducible sample of 1,000 functions -> their keys (frequent keys weigh more)."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    sample = index.sample_by_hash(docs, SEED, ["doc_id"], 1000)
    return sample.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_sampled"))


@query("sample_functions", sql=f"""
SELECT o_orderstatus, o_custkey % 10 AS customer_group, count(*) AS n_sampled FROM (
  SELECT o_orderstatus, o_custkey FROM orders ORDER BY {dhash_sql(SEED, 'o_orderkey')}, o_orderkey LIMIT 1000)
GROUP BY 1, 2""")
def sample_functions(spark, sf_dir):
    """1,000 rows sampled from a table that holds many times as many, and the keys they have."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    sample = index.sample_by_hash(orders, SEED, ["o_orderkey"], 1000)
    return sample.groupBy("o_orderstatus", (F.col("o_custkey") % 10).alias("customer_group")).agg(
        F.count(F.lit(1)).alias("n_sampled"))


@query("seeded_shuffle", sql=f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {dhash_sql(SEED, 'o_orderkey')}, o_orderkey) - 1 AS shuffle_idx FROM orders""")
def seeded_shuffle(spark, sf_dir):
    """O2 + O3: a full permutation of the orders, every row with its place."""
    return index.seeded_shuffle(load(spark, sf_dir, "orders").select("o_orderkey"), SEED, ["o_orderkey"])


@query("first_per_split", sql="""
SELECT o_orderstatus, o_orderkey FROM (
  SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 100""")
def first_per_split(spark, sf_dir):
    """O4 per split: the first 100 rows of every split (an order's status stands for its split)."""
    orders = load(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey")
    return index.take_first_per_split(orders, "o_orderstatus", ["o_orderkey"], 100)


@query("pick_per_group", sql=f"""
SELECT o_custkey, arg_min(o_orderkey, {dhash_sql(SEED, 'o_orderkey')}) AS picked FROM orders GROUP BY o_custkey""")
def pick_per_group(spark, sf_dir):
    """One random order of every customer."""
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return index.pick_per_group(orders, SEED, ["o_custkey"], ["o_orderkey"], "o_orderkey", "picked")
