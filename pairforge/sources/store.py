"""The function store (S8, K5): functions looked up by signature.

A store is a folder of generations.  ``append`` writes one: rows are dealt to files by
ranges of (signature, codehash), so a signature that most contracts have is spread over
several files and every other one lies in one or two; files are sorted and carry a bloom
filter on the signature.  What a file holds (first and last signature, rows) goes into the
manifest as the last step, in one file: a generation that isn't listed there doesn't
exist, so an append that fails or is repeated under the same ``key`` leaves no trace.
``lookup`` asks the manifest which files can hold the signatures and reads only those.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "generation string, file string, first string, last string, n bigint"
#: rows of a file, about
FILE_ROWS = 200_000


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of the finished generations; none for a store that isn't there yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(os.path.join(path, "manifest"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


def append(functions: DataFrame, path: str, key: str | None = None, file_rows: int = FILE_ROWS) -> str:
    """K5: add rows with the columns ``codehash`` and ``signature`` as a new generation and
    return its name.  With ``key`` set, rows already added under that key aren't added again.
    Rows without a signature can't be looked up and are left out."""
    spark = functions.sparkSession
    known = manifest(spark, path)
    if key is not None and known.where(F.col("generation").startswith(f"{key}-")).limit(1).count():
        return known.where(F.col("generation").startswith(f"{key}-")).agg(F.min("generation")).first()[0]
    rows = functions.where(F.col("signature").isNotNull())
    n = rows.count()
    generation = f"{key or 'batch'}-{uuid.uuid4().hex[:12]}"
    folder = os.path.join(path, "data", generation)
    (rows.repartitionByRange(max(1, -(-n // file_rows)), "signature", "codehash")
     .sortWithinPartitions("signature", "codehash")
     .write.option("parquet.bloom.filter.enabled#signature", "true")
     .option("parquet.bloom.filter.expected.ndv#signature", str(file_rows)).parquet(folder))
    held = spark.read.schema(rows.schema).parquet(folder)
    listing = held.groupBy(F.input_file_name().alias("file")).agg(
        F.min("signature").alias("first"), F.max("signature").alias("last"), F.count(F.lit(1)).alias("n"))
    if n:
        (listing.select(F.lit(generation).alias("generation"), "file", "first", "last", "n")
         .coalesce(1).write.mode("append").parquet(os.path.join(path, "manifest")))
    return generation


def files_of(spark: SparkSession, path: str, signatures: list[str]) -> list[str]:
    """The files whose range holds one of the signatures."""
    known = manifest(spark, path)
    wanted = spark.createDataFrame([(s,) for s in signatures], "signature string")
    near = known.join(F.broadcast(wanted), F.col("signature").between(F.col("first"), F.col("last")), "left_semi")
    return sorted(r.file for r in near.select("file").distinct().collect())


def lookup(spark: SparkSession, path: str, signatures: list[str], columns: list[str] | None = None) -> DataFrame:
    """All stored functions of the given signatures."""
    files = files_of(spark, path, signatures)
    if not files:
        some = manifest(spark, path).select("file").limit(1).collect()
        if not some:
            raise FileNotFoundError(f"no functions stored in {path}")
        files = [some[0].file]  # for its schema: the filter below reads no rows of it
    found = spark.read.parquet(*files).where(F.col("signature").isin(*signatures))
    return found.select(*columns) if columns else found


def compact(spark: SparkSession, path: str, into: str, file_rows: int = FILE_ROWS) -> str:
    """All generations as one in the store ``into`` (ranges of several generations overlap, so a
    look-up reads some files of each)."""
    files = [r.file for r in manifest(spark, path).select("file").collect()]
    return append(spark.read.parquet(*files), into, "compacted", file_rows)
