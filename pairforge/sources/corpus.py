"""Contract corpus and decompiled-source readers.

S1 reads a folder tree of one-JSON-document-per-file contracts with an
explicit schema; a malformed file becomes a row with ``_bad`` set instead of
failing the job.  Small files should be converted once to parquet (see
``to_parquet``) and all later work done on that.
"""

from __future__ import annotations

import contextlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.session import written

CONTRACT_SCHEMA = T.StructType([
    T.StructField("codehash", T.StringType()),
    T.StructField("bytecode", T.StringType()),
    T.StructField("source", T.StructType([
        T.StructField("SourceCodes", T.ArrayType(T.StructType([T.StructField("Code", T.StringType())]))),
    ])),
    T.StructField("_bad", T.StringType()),
])


READ_OPTIONS = {"multiLine": True, "recursiveFileLookup": True, "columnNameOfCorruptRecord": "_bad"}

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: tasks that list a batch's paths, for each slot
LISTING_TASKS = 8
OPEN_COST = "spark.sql.files.openCostInBytes"
#: bytes that opening a small file counts as; Spark's 4 MB put a few files in a task, which takes longer than they do
OPEN_BYTES = 64 << 10


@contextlib.contextmanager
def small_files(spark: SparkSession):
    """Settings for many small files: paths are listed by a bounded number of tasks (Spark's default
    is a task per path, 10,000 at most), and a task reads as many files as one slot's share."""
    wanted = {LISTING: LISTING_TASKS * spark.sparkContext.defaultParallelism, OPEN_COST: OPEN_BYTES}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_contracts(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """``(codehash, bytecode, source, _bad, file_path)`` for every ``*.json`` below ``path``
    (a folder, or a list of files)."""
    df = spark.read.schema(CONTRACT_SCHEMA).options(**READ_OPTIONS).option("pathGlobFilter", glob).json(path)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"))


def file_status() -> Column:
    """unreadable / no_source / ok of a contract file.  (Spark refuses a query that reads
    only the corrupt-record column, so the status always looks at ``source`` too.)"""
    return (F.when(F.col("_bad").isNotNull(), "unreadable")
             .when(F.col("source").isNull() | F.col("codehash").isNull(), "no_source").otherwise("ok"))


def corpus_status(contracts: DataFrame) -> DataFrame:
    """A1 counters for S1 per status of the files."""
    return contracts.groupBy(file_status().alias("status")).agg(F.count(F.lit(1)).alias("n"))


def contract_sources(contracts: DataFrame) -> DataFrame:
    """P1 + P2 + X7: drop unreadable rows and rows without source, keep the
    last file per codehash, explode the source files in order and join them
    into one text per contract: ``(codehash, text)``.  ``bytecode`` is never read."""
    return last_file(joined_sources(contracts)).drop("file_path")


def source_text() -> Column:
    """The source files of a contract file in order, joined into one text."""
    files = F.coalesce(F.col("source.SourceCodes"), F.array())
    return F.array_join(F.transform(files, lambda f: F.coalesce(f["Code"], F.lit(""))), "\n")


def joined_sources(contracts: DataFrame) -> DataFrame:
    """P1 + P2: ``(codehash, text, file_path)`` of every good file."""
    return contracts.filter(file_status() == "ok").select("codehash", source_text().alias("text"), "file_path")


def last_file(sources: DataFrame) -> DataFrame:
    """The last file of each contract, in order of path."""
    w = Window.partitionBy("codehash").orderBy(F.col("file_path").desc())
    return sources.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def file_manifest(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``(file, size, modified)`` of the files below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


DONE = "file string, size bigint, modified timestamp, status string"


def read_new_files(spark: SparkSession, path: str, out: str, glob: str = "*.json", batch_files: int = 1000) -> int:
    """Take in the files below ``path`` that ``out`` hasn't got yet, in batches of at most
    ``batch_files`` paths: a manifest of the folder without the files already done.  Spark packs
    a batch's small files into tasks by size.  A batch writes the good files' sources to
    ``out/sources`` and then every file with its status (malformed ones too) to ``out/done``, so
    a batch that was broken off is read again, and its sources come from the same paths.
    Returns the number of batches."""
    with small_files(spark):
        return _read_batches(spark, path, out, glob, batch_files)


def _read_batches(spark: SparkSession, path: str, out: str, glob: str, batch_files: int) -> int:
    done = read_or_empty(spark, os.path.join(out, "done"), DONE)
    todo = file_manifest(spark, path, glob).join(done.select("file", "modified"), ["file", "modified"], "left_anti")
    # the folder is listed once, however many batches follow
    todo = written(todo.select("file", "size", "modified"), "manifest")
    batches, last = 0, None
    while True:
        left = todo if last is None else todo.where(F.col("file") > last)
        batch = left.select("file").orderBy("file").limit(batch_files).collect()
        if not batch:
            return batches
        last = batch[-1].file
        contracts = read_contracts(spark, [r.file for r in batch], glob)
        # the batch's files are opened once; what follows reads the written table
        files = written(contracts.select("codehash", source_text().alias("text"), "file_path", file_status().alias("status")), "files")
        files.where("status = 'ok'").drop("status").write.mode("append").parquet(os.path.join(out, "sources"))
        listed = left.where(F.col("file") <= last)
        # the statuses of one batch's paths: small enough to broadcast
        status = files.groupBy("file_path").agg(F.max("status").alias("status"))
        (listed.join(F.broadcast(status), F.col("file") == F.col("file_path"), "left")
         .select("file", "size", "modified", F.coalesce("status", F.lit("unreadable")).alias("status"))
         .write.mode("append").parquet(os.path.join(out, "done")))
        batches += 1


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A written table, or one without rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_decompiled(spark: SparkSession, path: str) -> DataFrame:
    """One whole text per ``<codehash>.sol`` file below ``path``."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.sol")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.sol$", 1)
    return df.select(name.alias("codehash"), F.col("value").alias("text"))


def to_parquet(df: DataFrame, path: str, shard_col: str | None = None) -> None:
    """Append a table, optionally sharded by ``codehash[2:6]``."""
    w = df
    if shard_col:
        w = df.withColumn("shard", F.substring(F.col(shard_col), 3, 4))
        w.write.mode("append").partitionBy("shard").parquet(path)
    else:
        w.write.mode("append").parquet(path)
