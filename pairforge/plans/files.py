"""Files there and back: every reader and writer of dataset, record, prediction and metric
files, reached by queries that write a table's rows and aggregate what they read."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.functions.hashing import dhash_sql
from pairforge.operators import features as Z
from pairforge.operators import index, labels, pairs, registry, rows, splits
from pairforge.operators import metrics as M
from pairforge.plans.pairing import _POS_NEG_SQL, _VIEWS_SQL, conversation_views
from pairforge.plans.registry import query
from pairforge.session import scratch_path, written
from pairforge.sources import datasets, records, writers
from pairforge.sources.tables import load

SEED = 42
_LB = T.LINE_BREAKS
_SP = T.PY_SPACE


def _bucket_split(key: str) -> str:
    return (f"CASE WHEN {dhash_sql(SEED, key)} % 100 < 70 THEN 'train' WHEN {dhash_sql(SEED, key)} % 100 < 90 "
            "THEN 'valid' ELSE 'test' END")


@query("task_files", sql=f"""
WITH {_VIEWS_SQL},{_POS_NEG_SQL},
lines AS (
  SELECT label, codehash1, {_bucket_split('codehash1')} AS split,
         regexp_replace(regexp_replace(concat_ws('<CODESPLIT>', label, codehash1, codehash2, coalesce(func1, ''), coalesce(func2, '')),
                                       '{_LB}', '', 'g'), '\\A{_SP}+|{_SP}+\\z', '', 'g') AS line
  FROM pairs WHERE NOT (coalesce(func1, '') LIKE '%<CODESPLIT>%' OR coalesce(func2, '') LIKE '%<CODESPLIT>%')),
parts AS (SELECT *, string_split(line, '<CODESPLIT>') AS p FROM lines)
SELECT split || '-' || (row_number() OVER (PARTITION BY split ORDER BY codehash1) - 1) AS guid, split, p[1] AS label,
       CAST(label AS BIGINT) AS label_id, md5(p[4]) AS text_a_md5, md5(p[5]) AS text_b_md5
FROM parts WHERE len(p) = 5""")
def task_files(spark, sf_dir):
    """V2 + K1 + S3a + P14 + F16: the pairs as record files of three splits, in order of their
    first contract, read through the task registry with example ids and label ids."""
    src, dec = conversation_views(spark, sf_dir)
    pn = splits.group_split(pairs.pos_neg_pairs(src, dec, seed=SEED), ["codehash1"], seed=SEED)
    lines = written(records.ok_rows(records.encode_records(pn)).select("split", "codehash1", "value"), "record-lines")
    folder = scratch_path(spark, "task-files")
    names = ["train", "valid", "test"]
    ordered = lines.repartitionByRange("codehash1").sortWithinPartitions("codehash1")
    files = writers.write_split_files(ordered.select("split", F.col("value").alias("text")), folder, "txt", names)
    read = registry.task("clone").read(spark, files)
    return read.select("guid", "split", "label", "label_id", F.md5("text_a").alias("text_a_md5"), F.md5("text_b").alias("text_b_md5"))


@query("strict_records", sql=f"""
WITH t AS (SELECT conv_id, turn, role, regexp_replace(text, '{_LB}', '', 'g') AS b FROM conversations),
f AS (SELECT *, CASE WHEN conv_id % 5 = 0 THEN 'too_few_fields' WHEN conv_id % 7 = 0 THEN 'label_not_int' END AS error FROM t)
SELECT 'plain' AS form, coalesce(error, 'ok') AS status, count(*) AS n, CAST(sum(CASE WHEN error IS NULL THEN turn % 2 END) AS BIGINT) AS n_positive,
       CAST(sum(CASE WHEN error IS DISTINCT FROM 'too_few_fields' THEN length(' ' || b || '  ') END) AS BIGINT) AS n_chars FROM f GROUP BY error
UNION ALL
SELECT 'trimmed', coalesce(error, 'ok'), count(*), CAST(sum(CASE WHEN error IS NULL THEN turn % 2 END) AS BIGINT),
       CAST(sum(CASE WHEN error IS DISTINCT FROM 'too_few_fields' THEN length(regexp_replace(b, '\\A{_SP}+|{_SP}+\\z', '', 'g')) END) AS BIGINT)
FROM f GROUP BY error""")
def strict_records(spark, sf_dir):
    """S3b + S3c + F2 + K10: record lines, some of them short or with a label that is no number,
    read strictly; bad ones keep their reason, and the trimmed form strips both functions."""
    conv = load(spark, sf_dir, "conversations")
    body = F.concat(F.lit(" "), T.remove_line_breaks(F.col("text")), F.lit("  "))
    label = F.when(F.col("conv_id") % 7 == 0, F.lit("one")).otherwise((F.col("turn") % 2).cast("string"))
    ids = [F.concat(F.lit("0x"), F.col(c).cast("string")) for c in ("conv_id", "turn")]
    whole = records.join_delimited([label, *ids, F.coalesce("role", F.lit("")), body], T.RECORD_DELIM)
    short = records.join_delimited([label, *ids], T.RECORD_DELIM)
    path = scratch_path(spark, "strict-records")
    records.write_lines(conv.select(F.when(F.col("conv_id") % 5 == 0, short).otherwise(whole).alias("value")), path)

    def counted(form, read):
        return read.groupBy(F.lit(form).alias("form"), F.coalesce("error", F.lit("ok")).alias("status")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("error").isNull(), F.col("label"))).alias("n_positive"),
            F.sum(F.length("func2")).alias("n_chars"))
    plain = counted("plain", datasets.pair_records(spark, path))
    return plain.unionByName(counted("trimmed", records.decode_strict(records.read_lines(spark, path), trim_funcs=True)))


@query("split_files", sql=f"""
WITH s AS (SELECT doc_id, lang, source, text, {_bucket_split('doc_id')} AS split FROM documents),
v AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT lang AS label FROM s WHERE split = 'train'))
SELECT CASE split WHEN 'valid' THEN 'validation' ELSE split END AS split, doc_id, lang AS label, label_id, split = 'valid' AS is_eval,
       md5(coalesce(source, '') || ' ' || text) AS sentence_md5, 'single_label_classification' AS task_type
FROM s LEFT JOIN v ON v.label = s.lang WHERE split <> 'test'""")
def split_files(spark, sf_dir):
    """K3 + S6 + P7-P9 + P11 + P15 + U3 + F16 + Z13: the documents as csv files per split, loaded by
    extension; splits renamed and dropped, a column dropped, the label column renamed and numbered
    by the train split's vocabulary, text columns joined."""
    docs = splits.group_split(load(spark, sf_dir, "documents"), ["doc_id"], seed=SEED)
    frame = docs.select("split", "doc_id", F.col("lang").alias("language"), F.lit("unused").alias("note"), "source", "text")
    files = writers.write_split_files(frame, scratch_path(spark, "split-files"), "csv", ["train", "valid", "test"])
    df = datasets.load_splits(spark, files, frame.drop("split").schema)
    df = rows.remove_splits(rows.rename_split(df, "valid", "validation"), ["test"])
    df = datasets.classification_frame(df, "language", ["note"])
    vocab = labels.label_vocab(df.where("split = 'train'"))
    df = labels.label_to_id(df, vocab).withColumn("is_eval", F.col("split") == datasets.eval_split(df))
    return df.select("split", "doc_id", "label", "label_id", "is_eval",
                     F.md5(rows.join_text_columns(["source", "text"])).alias("sentence_md5"),
                     F.lit(labels.task_type(df)).alias("task_type"))


#: records of the first-texts sample
FIRST = 50


@query("lm_text_files", sql=f"""
WITH c AS (SELECT doc_id, text, regexp_replace(text, '{_LB}', '', 'g') AS line FROM documents),
t AS (SELECT 'txt' AS kind, line AS x FROM c UNION ALL SELECT 'json', text FROM c UNION ALL SELECT 'csv', text FROM c
      UNION ALL SELECT 'first', text FROM (SELECT text FROM c ORDER BY doc_id LIMIT {FIRST}))
SELECT kind, count(*) AS n_rows, CAST(sum(length(x)) AS BIGINT) AS n_chars, CAST(sum(length(x)) // {Z.block_size(None)} AS BIGINT) AS n_blocks,
       md5(string_agg(md5(x), '' ORDER BY md5(x))) AS texts_md5
FROM t GROUP BY kind""")
def lm_text_files(spark, sf_dir):
    """K4 + S7 + S5 + Z11: the texts as lines, JSON and csv (whose only column has another name),
    loaded as language-model text; the first records in file order; whole blocks of the default size."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn("split", F.lit("train"))
    folder = scratch_path(spark, "lm-text")
    texts = ordered.select("split", "text")
    lines = writers.write_split_files(texts.withColumn("text", T.remove_line_breaks(F.col("text"))), folder, "txt", ["train"])
    as_json = writers.write_split_files(texts, folder, "json", ["train"])["train"]
    as_csv = writers.write_split_files(texts.withColumnRenamed("text", "body"), folder, "csv", ["train"])["train"]
    parts = [(kind, datasets.load_lm_text(spark, path)) for kind, path in (("txt", lines["train"]), ("json", as_json), ("csv", as_csv))]
    parts.append(("first", datasets.first_texts(spark, as_json, FIRST)))
    out = None
    for kind, frame in parts:
        digests = F.array_join(F.array_sort(F.collect_list(F.md5("text"))), "")
        one = frame.groupBy(F.lit(kind).alias("kind")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars"),
            F.floor(F.sum(F.length("text")) / Z.block_size(None)).alias("n_blocks"), F.md5(digests).alias("texts_md5"))
        out = one if out is None else out.unionByName(one)
    return out


#: samples that count at most, and rows shown
MAX_SAMPLES, SHOWN = 1000, 3


@query("result_files", sql=f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1000)::BIGINT) AS z FROM embeddings),
p AS (SELECT *, list_position(z, list_max(z)) - 1 AS best, CASE WHEN z[1] > 0 THEN 1 ELSE 0 END AS pred, label % 2 AS truth FROM e),
m AS (SELECT count(*) AS n, count_if(pred = truth) / count(*) AS acc,
             2.0 * count_if(pred = 1 AND truth = 1) / (2 * count_if(pred = 1 AND truth = 1) + count_if(pred <> truth)) AS f1,
             avg((z[1] - truth) * (z[1] - truth)) AS mse FROM p),
lines AS (
  SELECT unnest([{{'k': 'acc', 'v': acc}}, {{'k': 'acc_and_f1', 'v': (acc + f1) / 2}}, {{'k': 'f1', 'v': f1}}, {{'k': 'mse', 'v': mse}},
                 {{'k': 'samples', 'v': least(n, {MAX_SAMPLES})::DOUBLE}}]) AS l FROM m)
SELECT 'prediction' AS kind, vec_id AS key, CAST(best AS VARCHAR) AS value FROM p
UNION ALL SELECT 'scored', vec_id, md5(concat_ws('<CODESPLIT>', vec_id, 'n' || label, array_to_string(z, '<CODESPLIT>'))) FROM p
UNION ALL SELECT 'json', vec_id, '{{"vec_id":' || vec_id || ',"label":' || label || ',"score":' || z[1] || '}}' FROM p
UNION ALL SELECT 'metric', row_number() OVER (ORDER BY l.k) - 1, l.k || ' ' || CAST(round(l.v, 6) AS DECIMAL(18, 4)) FROM lines
UNION ALL SELECT 'shown', vec_id, CAST(best AS VARCHAR) FROM (SELECT * FROM p ORDER BY {dhash_sql(SEED, 'vec_id')}, vec_id LIMIT {SHOWN})""")
def result_files(spark, sf_dir):
    """K7-K9 + F8 + F9 + F15 + F17 + P10 + A14 + V3 + O8: predictions, scored lines and metrics as
    files and read back; JSON text per row; three rows to look at."""
    emb = load(spark, sf_dir, "embeddings")
    z = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    p = emb.select("vec_id", "label", z.alias("logits")).withColumn("best", M.argmax(F.col("logits")))
    squeezed = M.squeeze(F.array(F.element_at("logits", 1)))  # a regression's only output
    p = p.select("*", squeezed.alias("score"), F.when(squeezed > 0, 1).otherwise(0).alias("pred"), (F.col("label") % 2).alias("truth"))
    folder = scratch_path(spark, "results")
    writers.write_predictions(p.select(F.col("vec_id").alias("index"), F.col("best").alias("prediction")), f"{folder}/predictions")
    scored = p.select("vec_id", F.concat(F.lit("né"), F.col("label").cast("string")).alias("name"), "logits")
    records.write_lines(scored.select(writers.scored_lines(["vec_id", "name"]).alias("value")), f"{folder}/scored")
    both = registry.evaluate(p, registry.task("clone").metric, "pred", "truth")
    truth = rows.regression_label(p.withColumn("truth", F.col("truth").cast("string")), "truth", strict=False)
    truth = records.ok_rows(truth).withColumn("truth", F.col("truth").cast("double"))
    mse = registry.evaluate(truth, registry.DEFAULT_METRIC["regression"], "score", "truth")
    samples = p.agg(M.sample_count(F.count(F.lit(1)), MAX_SAMPLES).alias("samples"))
    for part in (both, mse, samples):
        writers.append_metrics(part, f"{folder}/metrics", "run-1", "test")
    writers.write_metric_lines(spark.read.parquet(f"{folder}/metrics"), f"{folder}/lines")
    lines = writers.read_metric_lines(spark, f"{folder}/lines")
    key = F.substring_index("value", T.RECORD_DELIM, 1).cast("bigint")
    out = [writers.read_predictions(spark, f"{folder}/predictions").select(F.lit("prediction").alias("kind"), F.col("index").alias("key"), F.col("prediction").alias("value")),
           records.read_lines(spark, f"{folder}/scored").select(F.lit("scored").alias("kind"), key.alias("key"), F.md5("value").alias("value")),
           p.select(F.lit("json").alias("kind"), F.col("vec_id").alias("key"), writers.json_lines("vec_id", "label", "score").alias("value")),
           lines.select(F.lit("metric").alias("kind"), F.col("line_no").alias("key"),
                        F.concat_ws(" ", "metric", F.col("value").cast("decimal(18,4)")).alias("value")),
           index.sample_by_hash(p, SEED, ["vec_id"], SHOWN).select(F.lit("shown").alias("kind"), F.col("vec_id").alias("key"), F.col("best").cast("string").alias("value"))]
    union = out[0]
    for part in out[1:]:
        union = union.unionByName(part)
    return union
