"""Sequence featurisation.

Token ids come from a hashing vocabulary over words (ids 0-4 are the
special tokens [PAD] [UNK] [CLS] [SEP] [MASK]); a trained BPE vocabulary
(``pairforge.operators.bpe``) can be used instead.  Truncation, assembly and
padding are closed-form array expressions; masked-LM corruption works on Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash, position_hashes

# Ids of the special tokens in the shipped vocabulary.
PAD, UNK, CLS, SEP, MASK = 0, 1, 2, 3, 4
N_SPECIAL = 5
HASH_VOCAB = 30000


def hashed_id(word: Column, vocab_size: int = HASH_VOCAB, offset: int = N_SPECIAL) -> Column:
    """J12 (hashing form): word -> ``offset + md5(word)[:8] mod vocab_size``."""
    return (F.lit(offset) + F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % vocab_size).cast("int")


def hashed_ids(words: Column, vocab_size: int = HASH_VOCAB, offset: int = N_SPECIAL) -> Column:
    """``hashed_id`` over an array of words."""
    return F.transform(words, lambda w: hashed_id(w, vocab_size, offset))


def cap(a: Column, n: int) -> Column:
    """First ``n`` tokens."""
    return F.slice(a, 1, n)


def truncated_pair_lengths(la: Column, lb: Column, max_len: int) -> tuple[Column, Column]:
    """Z3 in closed form: the lengths the drop-one-from-the-longer loop
    (ties drop from B) ends with."""
    la2 = F.least(la, F.greatest(F.lit(max_len) - lb, F.lit((max_len + 1) // 2)))
    lb2 = F.least(lb, F.greatest(F.lit(max_len) - la, F.lit(max_len // 2)))
    return la2, lb2


def truncate_pair(a: Column, b: Column, max_len: int) -> tuple[Column, Column]:
    la2, lb2 = truncated_pair_lengths(F.size(a), F.size(b), max_len)
    return F.slice(a, 1, la2), F.slice(b, 1, lb2)


def _ints(v: int, n: Column) -> Column:
    return F.array_repeat(F.lit(v), n)


def assemble(a: Column, b: Column | None, cls: int = CLS, sep: int = SEP, cls_at_end: bool = False,
             seg_a: int = 0, seg_b: int = 1, seg_cls: int = 1) -> tuple[Column, Column]:
    """``[CLS] A [SEP] B [SEP]`` (or CLS last) and the segment ids.  An
    empty or missing B gives the single-sequence form."""
    toks = F.concat(a, F.array(F.lit(sep)))
    segs = _ints(seg_a, F.size(a) + 1)
    if b is not None:
        has_b = F.size(b) > 0
        toks = F.when(has_b, F.concat(toks, b, F.array(F.lit(sep)))).otherwise(toks)
        segs = F.when(has_b, F.concat(segs, _ints(seg_b, F.size(b) + 1))).otherwise(segs)
    if cls_at_end:
        return F.concat(toks, F.array(F.lit(cls))), F.concat(segs, F.array(F.lit(seg_cls)))
    return F.concat(F.array(F.lit(cls)), toks), F.concat(F.array(F.lit(seg_cls)), segs)


def pad(ids: Column, length: Column | int, value: int = PAD, left: bool = False) -> Column:
    """Pad to ``length`` (never negative)."""
    n = F.greatest((length if isinstance(length, Column) else F.lit(length)) - F.size(ids), F.lit(0))
    fill = _ints(value, n)
    return F.concat(fill, ids) if left else F.concat(ids, fill)


def attention_mask(ids: Column, length: Column | int, left: bool = False) -> Column:
    """1 for real tokens, 0 for padding."""
    return pad(_ints(1, F.size(ids)), length, 0, left)


def pair_features(df: DataFrame, a: str, b: str, max_len: int = 512, first_cap: int = 50,
                  pad_id: int = PAD, left: bool = False, cls_at_end: bool = False) -> DataFrame:
    """Capped, pair-truncated, assembled and padded features."""
    ta, tb = truncate_pair(cap(F.col(a), first_cap), F.col(b), max_len - 3)
    ids, segs = assemble(ta, tb, cls_at_end=cls_at_end)
    return df.withColumn("_ids", ids).withColumn("_segs", segs).select(
        "*", pad(F.col("_ids"), max_len, pad_id, left).alias("input_ids"),
        attention_mask(F.col("_ids"), max_len, left).alias("input_mask"),
        pad(F.col("_segs"), max_len, 0, left).alias("segment_ids")).drop("_ids", "_segs")


def single_ids(a: Column, max_len: int) -> Column:
    """``[CLS] A[:L-2] [SEP]`` (no padding)."""
    return F.concat(F.array(F.lit(CLS)), F.slice(a, 1, max_len - 2), F.array(F.lit(SEP)))


def special_mask(ids: Column, specials=(PAD, UNK, CLS, SEP, MASK)) -> Column:
    """1 where the id is a special token."""
    sp = F.array(*[F.lit(s) for s in specials])
    return F.transform(ids, lambda x: F.when(F.array_contains(sp, x), 1).otherwise(0))


def dynamic_pad(df: DataFrame, ids: str, batch: str, multiple: int = 8, pad_id: int = PAD) -> DataFrame:
    """Pad every row to its batch's longest row, rounded up to a multiple
    of ``multiple``.  A batch is a bounded number of rows."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    target = (F.ceil(longest / F.lit(multiple)) * multiple).cast("int")
    return (df.withColumn("padded_len", target)
              .withColumn("attention_mask", attention_mask(F.col(ids), F.col("padded_len")))
              .withColumn(ids, pad(F.col(ids), F.col("padded_len"), pad_id)))


def effective_length(max_seq_length: int, model_max_length: int = 1024) -> int:
    """The sequence length actually used."""
    return min(max_seq_length, model_max_length)


def block_size(given: int | None, model_max: int = 1024) -> int:
    """The given block size capped by the model maximum, else min(model max, 1024)."""
    return min(given, model_max) if given is not None else min(model_max, 1024)


def pack_blocks(df: DataFrame, idx: str, ids: str, block: int = 512, batch_rows: int = 1000,
                mask_seed=None) -> DataFrame:
    """Concatenate the ids of each batch of ``batch_rows`` rows (in
    ``idx`` order), drop the remainder, cut into blocks of ``block``.

    Every row learns its position in its batch from a running sum over the
    batch's rows (a window over at most ``batch_rows`` row lengths) and is cut
    at the blocks' borders; the pieces are grouped by (batch, block): each
    group holds exactly ``block`` tokens, whatever the document lengths.

    With ``mask_seed`` set, each block also gets its tokens' masking draws
    ``dhash(seed, 'batch/block', position)``, made where the block is.
    """
    b = df.select(F.floor(F.col(idx) / batch_rows).cast("bigint").alias("batch"), F.col(idx), F.col(ids))
    w = Window.partitionBy("batch").orderBy(idx)
    b = (b.withColumn("_len", F.size(ids))
          .withColumn("_off", F.coalesce(F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
          .withColumn("_use", F.floor(F.sum("_len").over(Window.partitionBy("batch")) / block) * block))
    b = b.where("_len > 0")  # a row without ids has no pieces
    end = F.least(F.col("_off") + F.col("_len"), F.col("_use"))
    out = joined_pieces(b.select("batch", block_pieces(F.col(ids), F.col("_off"), end, block)), "batch", "block")
    if mask_seed is not None:
        key = F.concat_ws("/", F.col("batch").cast("string"), F.col("block").cast("string"))
        out = out.withColumn("mask_draws", position_hashes(mask_seed, key, F.size("input_ids")))
    return out


def block_pieces(ids: Column, first: Column, end: Column, block: int) -> Column:
    """The ids at the places from ``first`` to ``end`` (exclusive), cut at multiples of ``block``:
    one row ``p`` of (block, at, ids) for every block that they touch."""
    first, end = first.cast("bigint"), end.cast("bigint")
    number = lambda place: F.floor(place / block).cast("bigint")

    def piece(k: Column) -> Column:
        at = F.greatest(k * block, first)
        size = F.least((k + 1) * block, end) - at
        return F.struct(k.alias("block"), at.alias("at"),
                        F.slice(ids, (at - first + 1).cast("int"), size.cast("int")).alias("ids"))
    touched = F.when(end > first, F.sequence(number(first), number(end - 1)))
    return F.explode(F.transform(touched, piece)).alias("p")


def joined_pieces(pieces: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, input_ids)``: the pieces ``p`` of each block, joined in order of place."""
    rows = pieces.select(*(k for k in keys if k != "block"), "p.*")
    return rows.groupBy(*keys).agg(ids_in_order().alias("input_ids"))


def placed_pieces(df: DataFrame, order_cols, ids: str, start: int = 0, block: int = 512) -> DataFrame:
    """Pieces ``p`` of all rows' ids, with their places when the rows are joined in ``order_cols``
    order, counted from ``start``."""
    from pairforge.operators.index import running_offset
    rows = df.select(*order_cols, F.col(ids).alias("_ids")).withColumn("_len", F.size("_ids"))
    placed = running_offset(rows, order_cols, "_len", "_off")
    first = F.lit(start) + F.col("_off")
    return placed.select(block_pieces(F.col("_ids"), first, first + F.col("_len"), block))


def ids_in_order() -> Column:
    """The ids of grouped ``(at, ids)`` pieces, by place."""
    return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda t: t["ids"]))


def mlm_mask(ids: Column, key: Column, seed=42, prob: float = 0.15, vocab_size: int = HASH_VOCAB + N_SPECIAL,
             specials=(PAD, UNK, CLS, SEP, MASK), draws: Column | None = None) -> tuple[Column, Column]:
    """Masked-LM inputs and labels from a seeded hash per (key, position).

    15 % of non-special positions are chosen; of those 80 % become [MASK],
    10 % a random id, 10 % stay.  Labels are the original id at chosen
    positions and -100 elsewhere.
    """
    # One hash per position (precomputed by pack_blocks when given).
    rs = draws if draws is not None else position_hashes(seed, key, F.size(ids))
    masked = _corruption(int(round(prob * 10000)), vocab_size, specials)(ids, rs)
    return masked["inputs"], masked["labels"]


def _corruption(thresh: int, vocab_size: int, specials):
    """A column function of ids and draws: the masked-LM inputs and labels of whole Arrow batches."""
    @F.pandas_udf("inputs array<int>, labels array<int>")
    def corrupt(ids: pd.Series, draws: pd.Series) -> pd.DataFrame:
        inputs, labels = [], []
        for x, r in zip(ids, draws):
            if x is None or r is None:
                inputs.append(None)
                labels.append(None)
                continue
            x, r = np.asarray(x, dtype=np.int32), np.asarray(r, dtype=np.int64)
            chosen = ~np.isin(x, specials) & (r % 10000 < thresh)
            kind = (r >> 14) % 10
            inputs.append(np.where(chosen & (kind < 8), np.int32(MASK),
                                   np.where(chosen & (kind == 8), (r >> 24) % vocab_size, x)).astype(np.int32))
            labels.append(np.where(chosen, x, np.int32(-100)))
        return pd.DataFrame({"inputs": pd.Series(inputs, dtype=object), "labels": pd.Series(labels, dtype=object)})
    return corrupt
