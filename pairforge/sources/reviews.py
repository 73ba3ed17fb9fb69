"""Reviewed pairs: a keyed table that grows by runs.

A run's answers go to a folder of their own, which a replay overwrites; of several answers
to one (unordered) pair the latest run's counts.  Proposals leave out every pair that has
an answer (``review_candidates(reviewed=...)``).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.operators.rows import last_wins
from pairforge.session import written


def record(answers: DataFrame, path: str, run: int) -> None:
    """Upsert the answers of a run: ``id_a``, ``id_b`` in any order, and any further columns.  Rows
    without both ids are no pairs; of equal pairs in one run one is kept (the smallest answer)."""
    rest = [c for c in answers.columns if c not in ("id_a", "id_b", "run")]
    pair = answers.where("id_a is not null and id_b is not null").select(
        F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), *rest)
    kept = pair.groupBy("id_a", "id_b").agg(F.min(F.struct(*rest)).alias("_r")).select("id_a", "id_b", "_r.*")
    # written first: the answers may come from the table they go to
    written(kept, "answers").write.mode("overwrite").parquet(os.path.join(path, f"run={run}"))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """Every reviewed pair with its latest answer and the run that gave it; None before the first."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return last_wins(table, ["id_a", "id_b"], ["run"])
