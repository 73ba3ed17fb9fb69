"""A corpus of contract files, taken in as a batch job and as a stream.

The files are made from ``conversations`` (see ``extraction``): one file per contract,
a second one for some contracts that replaces it (other words, and a second source file
with a function that holds a long string literal), files that are no JSON and files
without source.  Both jobs must give the functions of each contract's last file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.operators import extract as X
from pairforge.plans.extraction import _SRC_SQL, derived_contracts, extract_sql
from pairforge.plans.registry import query
from pairforge.session import scratch_path
from pairforge.sources import corpus
from pairforge.streaming import contracts

#: pairs of letters in the long string literal
LONG_PAIRS = 3000
REPLACED, BROKEN, EMPTY = ("0", "1", "2"), "7", "8"  # last digit of the codehash
#: on a local disk Hadoop would write a checksum file beside each file and start a process (chmod) for both
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_LONG = ("contract D { function data(uint a) public returns (bytes memory) { x = \"" + "7{" * LONG_PAIRS
         + "\"; y = x; z = y; return z; } }")


def write_corpus(spark, sf_dir, folder: str) -> DataFrame:
    """One file per row of ``value``, below a folder per wave; returns the files' waves.  A
    folder per contract would have to be made, committed and listed one by one."""
    src, _ = derived_contracts(spark, sf_dir)
    last = F.substring("codehash", -1, 1)

    def contract(codes, wave):
        source = F.struct(F.transform(F.array(*codes), lambda c: F.struct(c.alias("Code"))).alias("SourceCodes"))
        return F.to_json(F.struct("codehash", F.lit("0x6080").alias("bytecode"), source.alias("source"))), wave
    files = ((F.lit(True), contract([F.col("text")], "1")),
             (last.isin(*REPLACED), contract([F.replace("text", F.lit("total"), F.lit("supply")), F.lit(_LONG)], "2")),
             (last == BROKEN, (F.concat(F.lit("{ broken "), "codehash"), "3")),
             (last == EMPTY, (F.to_json(F.struct(F.concat("codehash", F.lit("x")).alias("codehash"))), "3")))
    # a contract's files are made together, so that contracts are derived once and tasks have like shares
    made = F.array(*(F.when(wanted, F.struct(F.lit(wave).alias("wave"), value.alias("value"))) for wanted, (value, wave) in files))
    rows = src.select(F.explode(F.filter(made, lambda f: f.isNotNull())).alias("f")).select("f.wave", "f.value")
    # tasks move their own files into place; the folder is read only after the whole job succeeded
    (rows.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2)
     .options(**PLAIN_FILES).partitionBy("wave").text(folder))
    return rows.select("wave")


_CORPUS_SQL = f"""{_SRC_SQL.replace('src AS (', 'first_files AS (', 1)},
src AS (SELECT codehash, CASE WHEN right(codehash, 1) IN ('0', '1', '2')
                              THEN replace(text, 'total', 'supply') || chr(10) || '{_LONG}' ELSE text END AS text FROM first_files)"""
_FUNCTIONS_SQL = f"""
SELECT 'function' AS kind, * FROM ({extract_sql(_CORPUS_SQL)})
UNION ALL SELECT 'file', status, count(*), '', '', 0, '' FROM (
  SELECT unnest(['ok'] || CASE WHEN right(codehash, 1) IN ('0', '1', '2') THEN ['ok'] WHEN right(codehash, 1) = '{BROKEN}' THEN ['unreadable']
                               WHEN right(codehash, 1) = '{EMPTY}' THEN ['no_source'] ELSE [] END) AS status
  FROM (SELECT DISTINCT '0x' || md5(CAST(conv_id AS VARCHAR)) AS codehash FROM conversations WHERE turn % 2 = 0)) GROUP BY status"""


def _rows(functions, statuses):
    found = functions.select(F.lit("function").alias("kind"), "codehash", F.col("pos").cast("bigint").alias("pos"), "name",
                             "signature", "n_tokens", F.md5("text").alias("text_md5"))
    blank = F.lit("")
    return found.unionByName(statuses.select(
        F.lit("file").alias("kind"), F.col("status").alias("codehash"), F.col("n").alias("pos"), blank.alias("name"),
        blank.alias("signature"), F.lit(0).cast("bigint").alias("n_tokens"), blank.alias("text_md5")))


@query("corpus_files", sql=_FUNCTIONS_SQL)
def corpus_files(spark, sf_dir):
    """S1 + P1 + P2 + X1-X7 + A1: contract files taken in through the manifest in bounded batches,
    the last file of a contract kept, functions extracted, files counted by status."""
    folder, out = scratch_path(spark, "corpus"), scratch_path(spark, "corpus-tables")
    write_corpus(spark, sf_dir, folder)
    corpus.read_new_files(spark, folder, out, glob="*.txt", batch_files=10_000)
    sources = corpus.last_file(spark.read.parquet(f"{out}/sources"))
    functions = X.last_definition(X.extract_functions(sources, "codehash", "text", "contract"))
    done = spark.read.schema(corpus.DONE).parquet(f"{out}/done")
    return _rows(functions, done.groupBy("status").agg(F.count(F.lit(1)).alias("n")))


@query("corpus_stream", sql=_FUNCTIONS_SQL)
def corpus_stream(spark, sf_dir):
    """R1 + R2 with X1-X7: the same files as a stream; a contract's later file replaces what an
    earlier batch extracted, and the result is the batch job's."""
    folder, out = scratch_path(spark, "corpus"), scratch_path(spark, "corpus-stream")
    files = write_corpus(spark, sf_dir, folder).count()
    contracts.take_in(spark, folder, out, f"{out}-checkpoint", "*.txt", files_per_batch=max(1, -(-files // 3)))
    return _rows(contracts.current_functions(spark, out), contracts.file_statuses(spark, out))
