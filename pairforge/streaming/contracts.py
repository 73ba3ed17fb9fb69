"""Contracts that arrive as files, with the last file of each winning across batches
(R1, R2 with X1-X7).

A micro-batch extracts the functions of the contracts it brings and writes them, with the
owners (codehash, winning file) and the files' statuses, to folders of its own, which a
replay overwrites.  The state is the log of owners: a file that comes before the one a
contract already has (in order of path) changes nothing, a later one replaces all its
functions.  Nothing written is changed: ``current_functions`` reads the functions of each
contract's winning file, so what was replaced is retracted, and the result is that of the
batch job over all files, whatever the order in which they came.  Ids go on from batch to
batch; a replay keeps those it had.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.operators.extract import extract_functions, last_definition
from pairforge.operators.index import dense_index
from pairforge.sources.corpus import (CONTRACT_SCHEMA, LISTING, LISTING_TASKS, READ_OPTIONS, file_status, last_file,
                                      read_or_empty, source_text)
from pairforge.session import written

OWNERS = "codehash string, file_path string, n bigint, batch string"
STATUSES = "file_path string, status string, batch string"
FUNCTIONS = ("id bigint, codehash string, file_path string, pos int, name string, signature string, selector string, "
             "n_tokens bigint, text string, batch string")


def take_in(spark: SparkSession, source_dir: str, out: str, checkpoint: str, glob: str = "*.json",
            files_per_batch: int = 1000, side: str = "contract") -> int:
    """Run the stream over the files present (availableNow); returns the number of micro-batches."""
    stream = (spark.readStream.schema(CONTRACT_SCHEMA).options(**READ_OPTIONS).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_batch).json(source_dir)
              .select("*", F.col("_metadata.file_path").alias("file_path")))
    seen = []

    def take(batch: DataFrame, batch_id: int) -> None:
        name = f"{batch_id:09d}"
        session = batch.sparkSession
        before = read_or_empty(session, os.path.join(out, "owners"), OWNERS).where(F.col("batch") < name)
        known = before.groupBy("codehash").agg(F.max("file_path").alias("known"))
        # the batch's files are opened once; what follows reads the written table
        files = written(batch.select("file_path", "codehash", file_status().alias("status"),
                                     source_text().alias("text")), "files")
        news = last_file(files.where("status = 'ok'").select("codehash", "text", "file_path"))
        news = written(news.join(known, "codehash", "left").where(
            F.col("known").isNull() | (F.col("file_path") > F.col("known"))).drop("known"), "contracts")
        functions = last_definition(extract_functions(news, "codehash", "text", side))
        functions = written(functions.join(news.select("codehash", "file_path"), "codehash"), "functions")
        start = read_or_empty(session, os.path.join(out, "functions"), FUNCTIONS).where(
            F.col("batch") < name).agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
        numbered = dense_index(functions, ["codehash", "pos"], "_k").withColumn("id", F.col("_k") + start)
        columns = [c.split()[0] for c in FUNCTIONS.split(", ")[:-1]]
        numbered.select(*columns).write.mode("overwrite").parquet(os.path.join(out, "functions", f"batch={name}"))
        statuses = files.select("file_path", "status")
        statuses.write.mode("overwrite").parquet(os.path.join(out, "files", f"batch={name}"))
        counts = functions.groupBy("codehash").agg(F.count(F.lit(1)).alias("n"))
        owners = news.select("codehash", "file_path").join(counts, "codehash", "left").select(
            "codehash", "file_path", F.coalesce("n", F.lit(0)).alias("n"))
        owners.write.mode("overwrite").parquet(os.path.join(out, "owners", f"batch={name}"))  # the state, last
        seen.append(batch_id)

    # Spark lists a batch's paths again, by default in a task per path (10,000 tasks at most)
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, LISTING_TASKS * spark.sparkContext.defaultParallelism)
    try:
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(LISTING, before)
    return len(seen)


def current_functions(spark: SparkSession, out: str) -> DataFrame:
    """The functions of every contract's winning file."""
    owners = read_or_empty(spark, os.path.join(out, "owners"), OWNERS)
    winners = owners.groupBy("codehash").agg(F.max(F.struct("file_path", "batch")).alias("w")).select("codehash", "w.*")
    functions = read_or_empty(spark, os.path.join(out, "functions"), FUNCTIONS)
    return functions.join(winners, ["codehash", "file_path", "batch"], "left_semi")


def file_statuses(spark: SparkSession, out: str) -> DataFrame:
    """A1: files per status over all batches."""
    files = read_or_empty(spark, os.path.join(out, "files"), STATUSES)
    return files.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
