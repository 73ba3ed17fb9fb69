"""A table cache keyed by its parameters.

``cached_table(spark, key, build)`` reads the parquet table stored for
``key`` under the shared checkpoint folder, or builds it with ``build()``,
writes it there and reads it back.  Reading the written table also cuts the
lineage of iterative jobs.  The key of a table that depends on files holds
their ``content_stamp``.  Every build writes a folder of its own and then adds
its name to the list of finished ones, so builders don't disturb each other.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.session import ensure_checkpoint_dir


def cache_path(spark: SparkSession, key: dict) -> str:
    digest = hashlib.sha256(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()[:20]
    return os.path.join(ensure_checkpoint_dir(spark), "pairforge-cache", f"{key.get('kind', 'table')}-{digest}")


def content_stamp(table: DataFrame) -> str:
    """Changes with the names, sizes or times of the files that hold the table."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{row.n}-{row.h}"


def _finished(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.schema("folder string").parquet(os.path.join(path, "finished")).agg(F.min("folder")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def cached_table(spark: SparkSession, key: dict, build) -> DataFrame:
    path = cache_path(spark, key)
    folder = _finished(spark, path)
    if folder is None:
        folder = f"build-{uuid.uuid4().hex[:12]}"
        build().write.parquet(os.path.join(path, folder))
        spark.createDataFrame([(folder,)], "folder string").coalesce(1).write.mode("append").parquet(
            os.path.join(path, "finished"))
    return spark.read.parquet(os.path.join(path, folder))
