"""Sinks (K2-K9).  All append or overwrite whole folders through the
DataFrame writer; nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.text import drop_non_ascii, fixed_point


#: rows of one csv file at most
CSV_ROWS = 10_000


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """K2 (and K3 with ``partitionBy('split')``): every row is written, no tail is lost."""
    df.write.mode(mode).json(path)


def write_split_json(df: DataFrame, path: str, split_col: str = "split") -> None:
    """K3."""
    df.write.mode("overwrite").partitionBy(split_col).json(path)


def write_split_text(df: DataFrame, path: str, text_col: str = "text", split_col: str = "split") -> None:
    """K4: one clean line per row, a folder per split."""
    df.select(split_col, text_col).write.mode("overwrite").partitionBy(split_col).text(path)


def write_split_files(df: DataFrame, folder: str, ext: str, names: list[str], split_col: str = "split") -> dict[str, str]:
    """K3/K4 as one folder of files per split, ``<folder>/<split>.<ext>`` (json, csv or txt, whose
    rows are the column ``text``): the layout that readers choose by extension."""
    from pairforge.sources.datasets import CSV
    out = {}
    for name in names:
        out[name] = f"{folder}/{name}.{ext}"
        part = df.where(F.col(split_col) == name).drop(split_col)
        if ext == "txt":
            part.select("text").write.mode("overwrite").text(out[name])
        elif ext == "csv":
            # a csv file with line breaks in its fields is read by one task
            part.write.mode("overwrite").options(**CSV).option("maxRecordsPerFile", CSV_ROWS).csv(out[name])
        else:
            part.write.mode("overwrite").json(out[name])
    return out


def prediction_text(task: str, pred: Column, label_names: list[str] | None = None) -> Column:
    """K7 line body: regression ``%3.3f``; multi-label names of the 1s; single-label name."""
    if task == "regression":
        return fixed_point(pred)
    names = F.array(*[F.lit(n) for n in (label_names or [])])
    if task == "multi_label_classification":
        return F.array_join(F.filter(names, lambda x, i: pred[i] == 1), ",")
    return F.element_at(names, (pred + 1).cast("int"))


def write_predictions(df: DataFrame, path: str, index_col: str = "index", pred_col: str = "prediction") -> None:
    """K7: tab-separated with header ``index  prediction``."""
    (df.select(F.col(index_col).alias("index"), F.col(pred_col).alias("prediction"))
       .write.mode("overwrite").option("sep", "\t").option("header", True).csv(path))


def scored_lines(fields: list[str], logits: str = "logits", delim: str = "<CODESPLIT>") -> Column:
    """K8: the original fields (non-ASCII dropped) and every logit, joined by the delimiter."""
    parts = [drop_non_ascii(F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields]
    parts.append(F.array_join(F.transform(F.col(logits), lambda x: x.cast("string")), delim))
    return F.concat_ws(delim, *parts)


def metrics_rows(metrics: DataFrame, run: str, split: str) -> DataFrame:
    """K9: a one-row metrics frame -> long ``(run, split, metric, value)`` rows
    (sorted by metric when read back)."""
    cols = [c for c in metrics.columns]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return metrics.select(F.lit(run).alias("run"), F.lit(split).alias("split"),
                          F.expr(f"stack({len(cols)}, {stack}) AS (metric, value)"))


def write_metric_lines(metrics: DataFrame, path: str) -> None:
    """K9 as text: the rows of ``metrics_rows`` as sorted ``key = value`` lines, appended, in one
    folder per run and split.  One task writes a run's few lines."""
    line = F.concat_ws(" = ", "metric", F.format_string("%.6f", "value"))
    (metrics.select("run", "split", "metric", line.alias("line")).coalesce(1).sortWithinPartitions("run", "split", "metric")
     .select("run", "split", "line").write.mode("append").partitionBy("run", "split").text(path))


def read_metric_lines(spark, path: str) -> DataFrame:
    """(run, split, line_no, metric, value): what ``write_metric_lines`` wrote, in order."""
    lines = spark.read.schema("value string, run string, split string").text(path)
    placed = lines.select("run", "split", "value", F.col("_metadata.file_path").alias("_f"),
                          F.monotonically_increasing_id().alias("_o"))
    w = Window.partitionBy("run", "split").orderBy("_f", "_o")
    parts = F.split("value", " = ", 2)
    return placed.select("run", "split", (F.row_number().over(w) - 1).cast("bigint").alias("line_no"),
                         parts[0].alias("metric"), parts[1].cast("double").alias("value"))


def read_predictions(spark, path: str) -> DataFrame:
    """K7 read back."""
    return spark.read.option("sep", "\t").option("header", True).schema("index bigint, prediction string").csv(path)


def json_lines(*columns: str) -> Column:
    """F8: one row as JSON text; null fields are left out, as the writer does."""
    return F.to_json(F.struct(*columns))


def append_metrics(metrics: DataFrame, path: str, run: str, split: str) -> None:
    metrics_rows(metrics, run, split).write.mode("append").parquet(path)
