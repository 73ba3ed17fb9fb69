"""The driver's parquet tables (one file per table under an sf folder)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one table.  ``spread=True`` is for CPU-heavy per-row work: see
    ``spread_partitions``."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return spread_partitions(df) if spread else df


#: splits (of spark.sql.files.maxPartitionBytes at most) that ``spread_partitions`` deals anew
SPREAD_SPLITS = 8


def spread_partitions(df: DataFrame) -> DataFrame:
    """Round-robin a scan of at most SPREAD_SPLITS splits (one small file, one row
    group) so CPU-bound text work uses every core.  What is shuffled is bounded
    by that many splits on any cluster; every larger input is read as it lies."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- no RDD view (e.g. a remote session): leave the scan as it is
        return df
    return df.repartition(slots) if parts < slots and parts <= SPREAD_SPLITS else df
