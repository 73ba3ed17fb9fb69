"""Dense row numbering, ordering, limits and sampling.

``dense_index`` gives every row its 0-based position in a total order
without a single-partition window: the rows are dealt to ranges of the order
keys by fixed cuts (so a hot leading key is spread over several tasks), numbered
inside each range, and each range's offset comes from a table of counts whose
size is bounded by the number of ranges (so broadcasting it is safe at any data
size).  Slices need no numbering: the keys at their ends are selected exactly
(``selection``) and rows compare with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.hashing import dhash
from pairforge.operators import selection


def _cols(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in cols]


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def dense_index(df: DataFrame, order_cols, name: str = "idx", *, total: str | None = None,
                num_partitions: int | None = None, first: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based rank of each row in ``order_cols`` order.

    ``order_cols`` must form a total order (add a unique tie-breaker), so the
    numbering is deterministic whatever the partitioning; null sorts first.
    With ``total`` set, the row count is attached as well.  With ``first`` set,
    only ranges that reach below that rank are numbered; rows of the others get null.

    Cut keys from a bounded sample deal the rows to ranges by a plain
    expression.  Rows are counted per range from the key columns alone, and one
    shuffle by range numbers them.  Nothing is persisted: the range of a row
    depends on its key only, so whatever is recomputed comes back the same.
    """
    order = _cols(order_cols)
    cuts = selection.range_cuts(df, order, _num_partitions(df, num_partitions))
    kind = selection._key_type(df, order)
    tagged = df.withColumn("_pf_range", selection.range_of(selection.key_struct(order), cuts, kind))
    # One row per non-empty range: bounded by the number of cuts, so the broadcast is safe.
    counts = tagged.groupBy("_pf_range").agg(F.count(F.lit(1)).alias("_pf_cnt"))
    w = Window.orderBy("_pf_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select(
        "_pf_range",
        F.coalesce(F.sum("_pf_cnt").over(w), F.lit(0)).alias("_pf_off"),
        F.sum("_pf_cnt").over(Window.partitionBy(F.lit(0))).alias("_pf_total")))
    out = tagged.join(offsets, "_pf_range")
    inside = F.row_number().over(Window.partitionBy("_pf_range").orderBy(*order))
    if first is None:
        out = out.withColumn(name, (F.col("_pf_off") + inside - 1).cast("bigint"))
    else:
        out = (out.where(F.col("_pf_off") < first).withColumn(name, (F.col("_pf_off") + inside - 1).cast("bigint"))
               .unionByName(out.where(F.col("_pf_off") >= first).withColumn(name, F.lit(None).cast("bigint"))))
    if total:
        out = out.withColumn(total, F.col("_pf_total").cast("bigint"))
    return out.drop("_pf_range", "_pf_off", "_pf_total")


def running_offset(df: DataFrame, order_cols, value: str, name: str = "offset", *,
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows before this one in ``order_cols`` order: as
    ``dense_index``, with sums per range for the counts."""
    order = _cols(order_cols)
    cuts = selection.range_cuts(df, order, _num_partitions(df, num_partitions))
    kind = selection._key_type(df, order)
    tagged = df.withColumn("_pf_range", selection.range_of(selection.key_struct(order), cuts, kind))
    sums = tagged.groupBy("_pf_range").agg(F.sum(value).alias("_pf_sum"))  # one row per range
    before = Window.orderBy("_pf_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = F.broadcast(sums.select("_pf_range", F.coalesce(F.sum("_pf_sum").over(before), F.lit(0)).alias("_pf_off")))
    inside = Window.partitionBy("_pf_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = tagged.join(sums, "_pf_range").withColumn(
        name, (F.col("_pf_off") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("bigint"))
    return out.drop("_pf_range", "_pf_off")


def group_index(df: DataFrame, group_cols, order_cols, name: str = "gidx",
                size: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """0-based rank inside each group (``row_number() - 1`` partitioned by
    ``group_cols``), computed skew-safely: a global ``dense_index`` over
    (group, order) minus the group's first index.  The per-group start table
    is an aggregate with map-side combine; its join back is a plain equi
    join that AQE broadcasts when small and skew-splits when a group is hot.
    """
    gnames = list(group_cols)  # column names
    indexed = dense_index(df, _cols(gnames) + _cols(order_cols), "_pf_gi", num_partitions=num_partitions)
    aggs = [F.min("_pf_gi").alias("_pf_gstart")]
    if size:
        aggs.append(F.count(F.lit(1)).alias(size))
    starts = indexed.groupBy(*gnames).agg(*aggs)
    out = indexed.join(starts, gnames)
    return (out.withColumn(name, F.col("_pf_gi") - F.col("_pf_gstart"))
               .drop("_pf_gi", "_pf_gstart"))


def interleaved_ids(df: DataFrame, order_cols, start_id: int = 0, name: str = "pair_idx") -> DataFrame:
    """Pair k gets ids ``start + 2k`` (first view) and ``start + 2k + 1``."""
    return dense_index(df, order_cols, name).withColumn(name, F.col(name) * 2 + F.lit(start_id))


def batch_number(idx_col: str, batch_size: int) -> Column:
    """Batch of N rows from a dense index."""
    return F.floor(F.col(idx_col) / F.lit(batch_size)).cast("bigint")


def seeded_shuffle(df: DataFrame, seed, key_cols, name: str = "shuffle_idx") -> DataFrame:
    """O2/O3: a full random permutation, reproducible from ``seed``."""
    keys = _cols(key_cols)
    return dense_index(df.withColumn("_pf_h", dhash(seed, *keys)), [F.col("_pf_h")] + keys, name).drop("_pf_h")


def shuffled_head(df: DataFrame, seed, key_cols, k: int, name: str = "pos") -> DataFrame:
    """O3 + O4: the first ``k`` rows of the seeded shuffle, with their
    position.  Only a per-task top-k heap is shuffled (TakeOrderedAndProject);
    the numbering window runs over the ``k`` survivors."""
    keys = _cols(key_cols)
    head = (df.withColumn("_pf_h", dhash(seed, *keys))
              .orderBy(F.col("_pf_h"), *keys).limit(k))
    w = Window.orderBy(F.col("_pf_h"), *keys)
    return head.withColumn(name, (F.row_number().over(w) - 1).cast("bigint")).drop("_pf_h")


def take_first(df: DataFrame, order_cols, k: int) -> DataFrame:
    """First ``k`` rows in a total order (TakeOrderedAndProject)."""
    return df.orderBy(*_cols(order_cols)).limit(k)


def take_first_per_split(df: DataFrame, split_col: str, order_cols, k: int) -> DataFrame:
    """O4 per split: the first ``k`` rows of every split (``select(range(k))``
    on each), via the skew-safe in-group index."""
    return group_index(df, [split_col], order_cols, "_pf_k").filter(F.col("_pf_k") < k).drop("_pf_k")


def sample_by_hash(df: DataFrame, seed, key_cols, k: int) -> DataFrame:
    """A reproducible uniform sample of ``k`` rows (top-k by hash)."""
    keys = _cols(key_cols)
    return (df.withColumn("_pf_h", dhash(seed, *keys))
              .orderBy(F.col("_pf_h"), *keys).limit(k).drop("_pf_h"))


def offset_slice(df: DataFrame, order_cols, start: int, n: int, name: str | None = None) -> DataFrame:
    """Rows ``[start, start + n)`` of a total order, between the keys at the two ranks."""
    order = _cols(order_cols)
    kind, key = selection._key_type(df, order), selection.key_struct(order)
    found = selection.rank_keys(df, order, [start, start + n])
    if found[start] is None or n <= 0:
        return (df.withColumn(name, F.lit(None).cast("bigint")) if name else df).where(F.lit(False))
    rows = df.where(key >= selection.key_literal(found[start].key, kind))
    if found[start + n] is not None:
        rows = rows.where(key < selection.key_literal(found[start + n].key, kind))
    return dense_index(rows, order, name).withColumn(name, F.col(name) + start) if name else rows


def pick_per_group(df: DataFrame, seed, group_cols, key_cols, value_col: str, name: str) -> DataFrame:
    """One reproducible random ``value_col`` per group (min_by over a hash)."""
    keys = _cols(key_cols)
    return df.groupBy(*group_cols).agg(
        F.min_by(F.col(value_col), dhash(seed, *keys)).alias(name))
