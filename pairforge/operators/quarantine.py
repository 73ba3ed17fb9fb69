"""Quarantine side output and run counters.

Every check adds a status column in the same pass; the good and the bad
rows are two filters of one frame and the counters are one grouped count,
so the job never stops on a bad row and no row is lost.  ``write_by_status``
does both in one scan: rows are written to a folder per status, and the
counters come from the files' footers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def classify(df: DataFrame, checks: list[tuple[str, Column]], status: str = "status") -> DataFrame:
    """First failing check names the status; ``ok`` otherwise."""
    expr = None
    for name, failed in checks:
        expr = (F.when(failed, F.lit(name)) if expr is None else expr.when(failed, F.lit(name)))
    return df.withColumn(status, F.lit("ok") if expr is None else expr.otherwise(F.lit("ok")))


def good(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status) == "ok")


def bad(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status) != "ok")


def counters(df: DataFrame, stage: str, status: str = "status") -> DataFrame:
    """A1: rows per (stage, status)."""
    return df.groupBy(F.lit(stage).alias("stage"), F.col(status).alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


def statuses(checks: list[tuple[str, Column]]) -> list[str]:
    return ["ok"] + [name for name, _ in checks]


def write_by_status(df: DataFrame, checks: list[tuple[str, Column]], path: str, status: str = "status") -> dict[str, int]:
    """K10 + A1 in one scan: the rows to ``path/status=<name>``; returns the rows per status, which
    are in the footers of the written files (neither the input nor a column is read again).
    ``observe`` would count during the write, but its manager, once made, is part of the session
    and can't be serialised, so fitted models no longer run in that session."""
    classify(df, checks, status).write.mode("overwrite").partitionBy(status).parquet(path)
    kind = T.StructType([f for f in df.schema.fields if f.name != status] + [T.StructField(status, T.StringType())])
    found = df.sparkSession.read.schema(kind).parquet(path).groupBy(status).agg(F.count(F.lit(1)).alias("n")).collect()
    return {name: 0 for name in statuses(checks)} | {r[status]: r.n for r in found}


def read_status(df: DataFrame, path: str, name: str, status: str = "status") -> DataFrame:
    """The written rows of one status, with the columns of ``df`` (none for a status without rows)."""
    fields = [f for f in df.schema.fields if f.name != status] + [T.StructField(status, T.StringType())]
    rows = df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
    return rows.where(F.col(status) == name).select(*df.columns)
