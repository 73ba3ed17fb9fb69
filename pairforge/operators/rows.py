"""Row-shape operators: filters, renames, casts, last-wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.text import PY_SPACE


def last_wins(df: DataFrame, key_cols, order_cols) -> DataFrame:
    """Keep the row with the greatest ``order_cols`` per key.  Planned
    as a partial + final ``WindowGroupLimit``, so a hot key is cut down to one
    row per task before the shuffle."""
    order = [F.col(c).desc() if isinstance(c, str) else c for c in order_cols]
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def has_value(df: DataFrame, col: str) -> DataFrame:
    """The field is present and not NULL."""
    return df.filter(F.col(col).isNotNull())


def min_length(df: DataFrame, length_col: str, more_than: int = 20) -> DataFrame:
    """Strictly more than ``more_than`` tokens."""
    return df.filter(F.col(length_col) > more_than)


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """The line has a non-space character."""
    return df.filter(F.col(col).rlike("[^" + PY_SPACE[1:]))


def rename_label(df: DataFrame, old: str, new: str = "label") -> DataFrame:
    """P8."""
    return df.withColumnRenamed(old, new) if old != new else df


def remove_splits(df: DataFrame, drop: list[str], split_col: str = "split") -> DataFrame:
    """Drop whole splits."""
    return df.filter(~F.col(split_col).isin(drop))


def rename_split(df: DataFrame, old: str, new: str, split_col: str = "split") -> DataFrame:
    """Rename a split; an existing split of the new name is replaced."""
    kept = df.filter(F.col(split_col) != F.lit(new))
    return kept.withColumn(split_col, F.when(F.col(split_col) == old, F.lit(new)).otherwise(F.col(split_col)))


def regression_label(df: DataFrame, col: str = "label", strict: bool = True) -> DataFrame:
    """P10: label as float32; strict mode fails on a value that is not a number,
    permissive mode leaves NULL plus an ``error``."""
    if strict:
        return df.withColumn(col, F.col(col).cast("float"))
    cast = F.col(col).try_cast("float")
    return df.withColumn("error", F.when(cast.isNull() & F.col(col).isNotNull(), F.lit("label_not_float"))) \
             .withColumn(col, cast)


def join_text_columns(cols: list[str], delim: str = " ") -> Column:
    """``delim.join(cols)``; NULL fields count as empty strings."""
    return F.concat_ws(delim, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def append_text(text: Column, extra: Column) -> Column:
    """``f + ' ' + dfg``."""
    return F.concat(text, F.lit(" "), extra)


def example_id(split: Column, idx: Column) -> Column:
    """``"{split}-{i}"``."""
    return F.concat(split, F.lit("-"), idx.cast("string"))
