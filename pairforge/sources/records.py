"""Delimited pair records (K1, S3a-c, K6) with a quarantine side.

A record line is ``label<CODESPLIT>codehash1<CODESPLIT>codehash2<CODESPLIT>func1<CODESPLIT>func2``
with every line break removed.  The format does not escape the delimiter,
so the writer routes fields containing it to quarantine instead of writing
a corrupt line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import (RECORD_DELIM, delimiters, newline_to_space, py_strip,
                                      remove_line_breaks, split_keep_empty)

PAIR_FIELDS = ("label", "codehash1", "codehash2", "func1", "func2")


def encode_records(df: DataFrame, fields=PAIR_FIELDS, delim: str = RECORD_DELIM,
                   out: str = "value") -> DataFrame:
    """K1: one text line per row plus an ``error`` column (NULL when clean)."""
    raw = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    # line breaks go first: what they split may be the delimiter.  The delimiter has none,
    # so the joined line is cleaned once.
    line = remove_line_breaks(F.concat_ws(delim, *raw))
    # one more in a field, or spelled by a field's end and the next delimiter
    clash = delimiters(line, delim) != len(fields) - 1
    if any(delim.endswith(delim[:k]) for k in range(1, len(delim))):  # it may overlap itself: look into the fields too
        for c in raw:
            clash = clash | remove_line_breaks(c).contains(delim)
    return df.select("*", line.alias(out),
                     F.when(clash, F.lit("delimiter_in_field")).alias("error"))


def decode_lenient(lines: DataFrame, value: str = "value", delim: str = RECORD_DELIM,
                   n_fields: int = 5, names=PAIR_FIELDS, keep=()) -> DataFrame:
    """Strip, split, keep rows with exactly ``n_fields`` fields (all strings), and
    the columns ``keep`` beside them."""
    line = py_strip(F.col(value))
    tmp = lines.filter(delimiters(line, delim) == n_fields - 1).select("*", split_keep_empty(line, delim).alias("_parts"))
    return tmp.select(*keep, *[F.col("_parts")[i].alias(names[i]) for i in range(n_fields)])


def decode_strict(lines: DataFrame, value: str = "value", delim: str = RECORD_DELIM,
                  trim_funcs: bool = False, mode: str = "permissive") -> DataFrame:
    """Label as int, func2 newlines -> spaces.  ``mode``:
    ``permissive`` keeps bad rows with an ``error`` (wrong field count,
    non-integer label) for the quarantine; ``dropmalformed`` drops them;
    ``failfast`` fails the job on the first one."""
    if mode not in ("permissive", "dropmalformed", "failfast"):
        raise ValueError(f"unknown mode {mode}")
    parts = split_keep_empty(F.col(value), delim)
    part = lambda i: F.get(parts, i)  # noqa: E731  (NULL past the end; short rows are flagged)
    label_txt = F.trim(part(0))
    label = label_txt.try_cast("int")
    f1, f2 = part(3), newline_to_space(part(4))
    if trim_funcs:
        f1, f2 = py_strip(f1), py_strip(f2)
    error = (F.when(F.size(parts) < 5, F.lit("too_few_fields"))
              .when(label.isNull(), F.lit("label_not_int")))
    out = lines.select(label.alias("label"), part(1).alias("codehash1"), part(2).alias("codehash2"),
                       f1.alias("func1"), f2.alias("func2"), error.alias("error"))
    if mode == "dropmalformed":
        return out.filter(F.col("error").isNull())
    if mode == "failfast":
        failed = F.raise_error(F.concat(F.lit("malformed pair record: "), F.col("error")))
        return out.withColumn("error", F.when(F.col("error").isNotNull(), failed.cast("string")))
    return out


def ok_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNull()).drop("error")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNotNull())


def write_lines(df: DataFrame, path: str, value: str = "value", mode: str = "append") -> None:
    """K1/K6/K4: text lines, appended."""
    df.select(F.col(value)).write.mode(mode).text(path)


def read_lines(spark, path: str) -> DataFrame:
    return spark.read.text(path)


def join_delimited(cols: list[Column], delim: str) -> Column:
    """``a<SPLIT>b<SPLIT>...``."""
    return F.concat_ws(delim, *cols)


def encode_review(df: DataFrame, fields=("codehash_a", "codehash_b", "func_a", "func_b")) -> DataFrame:
    """K6: a reviewed candidate pair as ``a<SPLIT>b<SPLIT>fa<SPLIT>fb`` (same
    quarantine rule as ``encode_records``)."""
    from pairforge.functions.text import REVIEW_DELIM
    return encode_records(df, fields, REVIEW_DELIM)
