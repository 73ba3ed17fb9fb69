"""Dataset loaders for training and evaluation files.

Splits live in one DataFrame with a ``split`` column.  Readers are chosen by
file extension; json files holding one top-level array are read in
multi-line mode.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.operators import rows

#: a quoted field may hold line breaks and doubled quotes, and keeps its outer spaces
CSV = {"header": True, "multiLine": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

PRETRAIN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("type", T.StringType()), T.StructField("codehash", T.StringType()),
])


def _ext(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()


def read_by_extension(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    ext = _ext(path)
    if ext == "csv":
        r = spark.read.options(**CSV)
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    if ext in ("json", "jsonl"):
        r = spark.read.schema(schema) if schema else spark.read
        if ext == "json" and _starts_with_array(spark, path):
            r = r.option("multiLine", True)
        return r.json(path)
    if ext == "txt":
        return spark.read.text(path).withColumnRenamed("value", "text")
    if ext == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file type {ext!r} for {path}")


def _starts_with_array(spark: SparkSession, path: str) -> bool:
    head = spark.read.text(path).where(r"value rlike '\\S'").limit(1).collect()
    return bool(head) and head[0][0].lstrip().startswith("[")


def load_splits(spark: SparkSession, files: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """``{'train': p, 'validation': p, 'test': p}`` -> one frame with ``split``.
    Validation and test must use the train file's extension."""
    base = _ext(files["train"]) if "train" in files else None
    out = None
    for split, path in files.items():
        if base and _ext(path) != base:
            raise ValueError(f"{split} file {path} does not have the train extension .{base}")
        df = read_by_extension(spark, path, schema).withColumn("split", F.lit(split))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def eval_split(df: DataFrame, split_col: str = "split") -> str:
    """Validation, else test, else error (one tiny distinct query)."""
    present = {r[0] for r in df.select(split_col).distinct().collect()}
    for name in ("validation", "valid", "test"):
        if name in present:
            return name
    raise ValueError("no validation or test split")


def load_lm_text(spark: SparkSession, path: str) -> DataFrame:
    """Column ``text`` if present, else the first column, as ``text``."""
    df = read_by_extension(spark, path)
    col = "text" if "text" in df.columns else df.columns[0]
    return df.select(F.col(col).cast("string").alias("text"))


def read_pretrain_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.schema(PRETRAIN_SCHEMA).json(path)


def in_file_order(df: DataFrame) -> list[Column]:
    """Columns that order the rows of a frame just read as they lie in its files, by file name."""
    return [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]


def first_texts(spark: SparkSession, path: str, count: int) -> DataFrame:
    """The first ``count`` records' ``text`` in file order."""
    df = spark.read.json(path)
    placed = df.select("text", *(c.alias(f"_o{k}") for k, c in enumerate(in_file_order(df))))
    return placed.orderBy("_o0", "_o1", "_o2").limit(count).select("text")


def read_pair_examples(spark: SparkSession, path: str, split: str) -> DataFrame:
    """The reader of the pair tasks: ``(guid, text_a, text_b, label)`` of a file of pair records;
    ``guid`` (P14) counts the file's well-formed records in order.  Test labels are kept."""
    from pairforge.operators.index import dense_index
    from pairforge.sources.records import decode_lenient
    lines = spark.read.text(path)
    lines = lines.select("value", *(c.alias(f"_o{k}") for k, c in enumerate(in_file_order(lines))))
    order = [f"_o{k}" for k in range(3)]
    parts = decode_lenient(lines, keep=order)
    numbered = dense_index(parts, order, "_k")
    return numbered.select(rows.example_id(F.lit(split), F.col("_k")).alias("guid"), F.col("func1").alias("text_a"),
                           F.col("func2").alias("text_b"), "label")


def pair_records(spark: SparkSession, path: str) -> DataFrame:
    """S3 (strict): ``label int`` + 4 string fields and an ``error`` column."""
    from pairforge.sources.records import decode_strict
    return decode_strict(spark.read.text(path))


def classification_frame(df: DataFrame, label_col: str = "label", drop: list[str] | None = None) -> DataFrame:
    """Drop columns and name the label column ``label``."""
    out = df.drop(*(drop or []))
    return rows.rename_label(out, label_col, "label")
