"""Training-corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents; rows without doc_id end at the first stage; rows that
repeat a doc_id are copies and share its fate; no rows lead to no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import beside, save
from pairforge.llm.decontamination import contamination
from pairforge.llm.language_id import UNKNOWN, identify
from pairforge.llm.near_dedup import near_duplicates
from pairforge.llm.packing import pack
from pairforge.llm.phrase_dedup import repeated_words
from pairforge.llm.quality import words
from pairforge.sources.tables import load


def _only(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The documents whose doc_id is (or, left_anti, is not) among the ids."""
    wanted = beside(ids.select(F.col("doc_id").alias("_id")))
    rows = docs.where("doc_id is not null")
    return rows.join(wanted, rows["doc_id"] == wanted["_id"], how)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language (no letters) go."""
    return _only(docs, identify(docs).where(F.col("lang_pred") != UNKNOWN))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word similarity 0.8 or more) the document
    with the smallest doc_id stays.  40 bands of 5 miss a pair at 0.8 with 1.2e-7."""
    return _only(docs, near_duplicates(docs, threshold_pct=80, bands=40).where("kept"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a smaller doc_id holds are cut from the
    text (its other words are joined by one space); a document of which nothing
    is left goes.  Other texts stay as they are."""
    found = repeated_words(docs, window=50).where("n_removed > 0").groupBy("doc_id").agg(
        F.first("spans").alias("_spans"), (F.first("n_removed") < F.first("n_words")).alias("_some"))
    # the document's columns stay in one struct: their names can't clash with those made here
    rows = docs.where("doc_id is not null").select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"))
    rows = rows.join(beside(found.withColumnRenamed("doc_id", "_id")), F.col("_row.doc_id") == F.col("_id"), "left")
    ranges = F.transform(F.sequence(F.lit(0), F.size("_spans") - 2, F.lit(2)),
                         lambda k: F.struct(F.get("_spans", k).alias("a"), F.get("_spans", k + 1).alias("b")))
    rows = rows.withColumn("_words", F.when(F.col("_spans").isNotNull(), words(F.col("_row.text"))))
    rows = rows.withColumn("_ranges", F.when(F.col("_spans").isNotNull(), ranges))
    kept = F.array_join(F.filter("_words", lambda w, i: ~F.exists(
        "_ranges", lambda r: (i >= r["a"]) & (i < r["b"]))), " ")
    rows = rows.withColumn("_text", F.when(F.col("_spans").isNotNull(), kept).otherwise(F.col("_row.text")))

    def column(name):
        own = F.col(f"_row.`{name}`")
        if name == "text":
            own = F.col("_text")
        elif name == "n_chars":
            own = F.when(F.col("_spans").isNotNull(), F.length("_text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)
    return rows.where("_spans is null or _some").select(*(column(c) for c in docs.columns))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = contamination(docs, load(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _only(docs, found, "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the remaining documents, placed in sequences of 2048."""
    return pack(docs, sequence=2048)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_repeated_passages),
    ("benchmarks", without_benchmarks),
    ("packing", packed),
]

#: trained profiles, near copies and token ids are beyond SQL: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
