"""Keyed pairing of two views of the same units.

Both views are long tables ``(codehash, selector, text)``: one row per
function (or any unit) of a contract (or any owner).  Every operator is an
equi join on keys that are unique per row on at least one side, so no key
concentrates more than one owner's rows in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash
from pairforge.operators.index import dense_index, group_index

KEY = "codehash"
SEL = "selector"


def match_pairs(src: DataFrame, dec: DataFrame, text: str = "text") -> DataFrame:
    """Functions present on both sides, matched by (codehash, selector)."""
    s = src.select(KEY, SEL, F.col(text).alias("src_text"))
    d = dec.select(KEY, SEL, F.col(text).alias("dec_text"))
    return s.join(d, [KEY, SEL], "inner")


def both_sides(src: DataFrame, dec: DataFrame) -> DataFrame:
    """Rows of ``src`` whose owner also has at least one ``dec`` row.
    The key side is de-duplicated first (map-side), so it is one row per
    owner: AQE broadcasts it when small and splits a hot owner otherwise."""
    return src.join(dec.select(KEY).distinct(), KEY, "left_semi")


def unpivot_pairs(matched: DataFrame, start_id: int = 0) -> DataFrame:
    """J3 + W1: each matched pair becomes a 'contract' row (id 2k) and a
    'decompiled' row (id 2k+1), k = rank of (codehash, selector)."""
    numbered = dense_index(matched, [KEY, SEL], "_k")
    both = numbered.select(
        KEY, SEL, "_k",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.lit("contract").alias("type"), F.col("src_text").alias("text")),
            F.struct(F.lit(1).alias("side"), F.lit("decompiled").alias("type"), F.col("dec_text").alias("text")),
        )).alias("r"))
    return both.select(
        (F.lit(start_id) + F.col("_k") * 2 + F.col("r.side")).cast("bigint").alias("id"),
        F.col("r.text").alias("text"), F.col("r.type").alias("type"), KEY, SEL)


PAIR_KEYS = ["label", "codehash1", "codehash2", "selector1", "selector2"]


def choose_pairs(src: DataFrame, dec: DataFrame, seed=42, errors: bool = False) -> DataFrame:
    """J4/J5/O7 on keys: one pair per contract that has matched functions, as
    ``label, codehash1, codehash2, selector1, selector2``.

    * pick: a matched selector chosen by ``min_by`` over a seeded hash;
    * coin: ``dhash % 2 == 1`` -> positive (its own decompiled twin, label 1);
    * otherwise a negative: the partner is another decompiled contract at
      rank ``(r + 1 + h % (n - 1)) % n`` -- never itself, found by an equi
      join on rank (no cross join); candidates are contracts with functions
      on both sides -- and inside it the function with index
      ``h % count``.  With a single decompiled contract no negative exists
      (the original aborts there): such a row has no partner, and is returned
      only with ``errors``, which adds the column ``error``.

    Keys are unique by (codehash, selector) on each side; no text is read.
    """
    keys = src.select(KEY, SEL).join(dec.select(KEY, SEL), [KEY, SEL])
    picks = keys.groupBy(KEY).agg(
        F.min_by(SEL, dhash(seed, F.lit("pick"), F.col(KEY), F.col(SEL))).alias("selector1"))
    picks = picks.withColumn("positive", dhash(seed, F.lit("coin"), F.col(KEY)) % 2 == 1)

    dec_idx = group_index(dec.select(KEY, SEL), [KEY], [SEL], "fidx", size="fcnt")
    # partner candidates: contracts with functions on both sides
    owners = both_sides(dec_idx.filter(F.col("fidx") == 0).select(KEY, "fcnt"), src)
    ranks = dense_index(owners, [KEY], "rank", total="n_owners")

    pos = picks.filter("positive").select(
        F.lit(1).alias("label"), F.col(KEY).alias("codehash1"), F.col(KEY).alias("codehash2"),
        "selector1", F.col("selector1").alias("selector2"))

    drawn = picks.filter(~F.col("positive")).join(ranks.select(KEY, "rank", "n_owners"), KEY)
    neg = (drawn.filter(F.col("n_owners") > 1)
           .withColumn("prank", (F.col("rank") + 1 + dhash(seed, F.lit("partner"), F.col(KEY)) % (F.col("n_owners") - 1))
                       % F.col("n_owners")))
    partners = ranks.select(F.col("rank").alias("prank"), F.col(KEY).alias("codehash2"), "fcnt")
    neg = (neg.join(partners, "prank")
              .withColumn("fidx", dhash(seed, F.lit("func"), F.col(KEY)) % F.col("fcnt")))
    chosen = dec_idx.select(F.col(KEY).alias("codehash2"), "fidx", F.col(SEL).alias("selector2"))
    neg = neg.join(chosen, ["codehash2", "fidx"]).select(
        F.lit(0).alias("label"), F.col(KEY).alias("codehash1"), "codehash2", "selector1", "selector2")
    pairs = pos.unionByName(neg).select(*PAIR_KEYS)
    if not errors:
        return pairs
    alone = drawn.filter(F.col("n_owners") < 2).select(
        F.lit(0).alias("label"), F.col(KEY).alias("codehash1"), "selector1", F.lit("no_negative_partner").alias("error"))
    return pairs.withColumn("error", F.lit(None).cast("string")).unionByName(alone, allowMissingColumns=True)


def with_texts(chosen: DataFrame, src: DataFrame, dec: DataFrame, text: str = "text") -> DataFrame:
    """The chosen pairs with both functions' texts (``func1``, ``func2``); a pair without a
    partner keeps a null there.  Other columns of ``chosen`` stay."""
    first = src.select(F.col(KEY).alias("codehash1"), F.col(SEL).alias("selector1"), F.col(text).alias("func1"))
    second = dec.select(F.col(KEY).alias("codehash2"), F.col(SEL).alias("selector2"), F.col(text).alias("func2"))
    how = "left" if "error" in chosen.columns else "inner"
    joined = chosen.join(first, ["codehash1", "selector1"]).join(second, ["codehash2", "selector2"], how)
    rest = [c for c in chosen.columns if c not in PAIR_KEYS]
    return joined.select(*PAIR_KEYS, "func1", "func2", *rest)


def pos_neg_pairs(src: DataFrame, dec: DataFrame, seed=42, text: str = "text", errors: bool = False) -> DataFrame:
    """The pairs of ``choose_pairs`` with their texts, which are fetched at the end."""
    return with_texts(choose_pairs(src, dec, seed, errors), src, dec, text)
