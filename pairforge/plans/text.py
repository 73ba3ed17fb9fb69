"""Record codec, text normalisation, sharding, dedupe and filters on
``documents``/``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.operators import rows
from pairforge.plans.registry import query
from pairforge.sources import records
from pairforge.sources.tables import load

_LB = T.LINE_BREAKS
_SP = T.PY_SPACE


@query("pair_record_roundtrip", sql=f"""
WITH rec AS (
  SELECT regexp_replace(concat_ws('<CODESPLIT>', CAST(n_chars > 1000 AS INT), 'doc' || doc_id, source, text, lang),
                        '{_LB}', '', 'g') AS value
  FROM documents
  WHERE NOT (source LIKE '%<CODESPLIT>%' OR text LIKE '%<CODESPLIT>%' OR lang LIKE '%<CODESPLIT>%')),
parts AS (SELECT string_split(regexp_replace(value, '\\A{_SP}+|{_SP}+\\z', '', 'g'), '<CODESPLIT>') AS p FROM rec)
SELECT CAST(p[1] AS INT) AS label, p[2] AS codehash1, p[3] AS codehash2, md5(p[4]) AS func1_md5,
       length(p[4]) AS func1_chars, p[5] AS func2
FROM parts WHERE len(p) = 5""")
def pair_record_roundtrip(spark, sf_dir):
    """K1 encode (line breaks removed, delimiter clash quarantined) then S3a decode."""
    docs = load(spark, sf_dir, "documents")
    pre = docs.select((F.col("n_chars") > 1000).cast("int").alias("label"),
                      F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("codehash1"),
                      F.col("source").alias("codehash2"), F.col("text").alias("func1"),
                      F.col("lang").alias("func2"))
    lines = records.ok_rows(records.encode_records(pre)).select("value")
    dec = records.decode_lenient(lines)
    return dec.select(F.col("label").cast("int").alias("label"), "codehash1", "codehash2",
                      F.md5("func1").alias("func1_md5"), F.length("func1").cast("bigint").alias("func1_chars"), "func2")


@query("text_normalize", sql=f"""
SELECT doc_id, length(t) AS n_chars, md5(t) AS text_md5
FROM (SELECT doc_id,
             regexp_replace(regexp_replace(regexp_replace(text, '{_LB}', ' ', 'g'), '{T.ASCII_WS_RUN}', ' ', 'g'),
                            '\\A{_SP}+|{_SP}+\\z', '', 'g') AS t
      FROM documents)""")
def text_normalize(spark, sf_dir):
    """X2 + F1-F3: line breaks -> space, whitespace runs -> one space, strip."""
    docs = load(spark, sf_dir, "documents")
    t = T.py_strip(T.collapse_whitespace(F.regexp_replace("text", T.LINE_BREAKS, " ")))
    return docs.select("doc_id", t.alias("t")).select(
        "doc_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("text_md5"))


@query("shard_histogram", sql="""
SELECT substr('0x' || sha256(text), 3, 4) AS shard, count(*) AS n_docs FROM documents GROUP BY 1""")
def shard_histogram(spark, sf_dir):
    """Rows per output shard ``codehash[2:6]`` (codehash = 0x + sha256)."""
    docs = load(spark, sf_dir, "documents")
    key = T.shard_key(F.concat(F.lit("0x"), F.sha2("text", 256)))
    return docs.groupBy(key.alias("shard")).agg(F.count(F.lit(1)).alias("n_docs"))


@query("last_wins_dedupe", sql="""
SELECT lang, source, doc_id, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id DESC) AS rn FROM documents)
WHERE rn = 1""")
def last_wins_dedupe(spark, sf_dir):
    """The last row per key wins."""
    docs = load(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars")
    return rows.last_wins(docs, ["lang", "source"], ["doc_id"])


@query("min_token_filter", sql=f"""
SELECT doc_id, n_tokens FROM (
  SELECT doc_id, len(regexp_extract_all(text, '{T.TOKEN_RX}')) AS n_tokens FROM documents)
WHERE n_tokens > 20""")
def min_token_filter(spark, sf_dir):
    """More than 20 tokens (whitespace runs count as tokens)."""
    docs = load(spark, sf_dir, "documents", spread=True)
    out = docs.select("doc_id", T.token_count(F.col("text")).cast("bigint").alias("n_tokens"))
    return rows.min_length(out, "n_tokens", 20)


@query("json_field_filter", sql="""
SELECT event_id, event_type, json_extract(props, '$.k')::BIGINT AS k
FROM events WHERE json_extract(props, '$.k') IS NOT NULL AND json_extract(props, '$.k')::BIGINT >= 50""")
def json_field_filter(spark, sf_dir):
    """F7 + P1: parse a JSON field, keep rows where it is present, filter on it."""
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    out = rows.has_value(ev.select("event_id", "event_type", k.alias("k")), "k")
    return out.filter(F.col("k") >= 50)
