"""Run bookkeeping and incremental queries: quarantine counters
and the streamed append (R1) over ``events``."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.operators import quarantine as Q
from pairforge.plans.registry import query
from pairforge.session import scratch_path
from pairforge.sources.tables import load
from pairforge.streaming.incremental import incremental_append

_SP = T.PY_SPACE


_TEXT_STATUS_SQL = f"""CASE WHEN regexp_replace(text, '\\A{_SP}+|{_SP}+\\z', '', 'g') = '' THEN 'empty'
              WHEN contains(text, '<CODESPLIT>') THEN 'delimiter_in_field'
              WHEN len(regexp_extract_all(text, '{T.TOKEN_RX}')) <= 20 THEN 'too_short'
              ELSE 'ok' END"""


def _text_checks():
    return [("empty", T.py_strip(F.col("text")) == ""),
            ("delimiter_in_field", F.col("text").contains(T.RECORD_DELIM)),
            ("too_short", T.token_count(F.col("text")) <= 20)]


@query("quarantine_counts", sql=f"""
SELECT 'documents' AS stage, status, count(*) AS n FROM (SELECT {_TEXT_STATUS_SQL} AS status FROM documents) GROUP BY status
UNION ALL
SELECT 'pages', status, count(*) FROM (
  SELECT CASE WHEN NOT contains(html, '</html>') THEN 'no_close_tag'
              WHEN length(html) - length(replace(html, '{{', '')) <> length(html) - length(replace(html, '}}', ''))
                THEN 'unbalanced_braces'
              ELSE 'ok' END AS status FROM pages) GROUP BY status""")
def quarantine_counts(spark, sf_dir):
    """K10 + A1: one pass classifies each row; counters per stage and status."""
    docs = load(spark, sf_dir, "documents")
    d = Q.classify(docs, _text_checks())
    pages = load(spark, sf_dir, "pages")
    n_open = F.length("html") - F.length(F.replace(F.col("html"), F.lit("{"), F.lit("")))
    n_close = F.length("html") - F.length(F.replace(F.col("html"), F.lit("}"), F.lit("")))
    p = Q.classify(pages, [
        ("no_close_tag", ~F.col("html").contains("</html>")),
        ("unbalanced_braces", n_open != n_close),
    ])
    return Q.counters(d, "documents").unionByName(Q.counters(p, "pages"))


@query("quarantine_tables", sql=f"""
WITH s AS (SELECT doc_id, text, {_TEXT_STATUS_SQL} AS status FROM documents),
names AS (SELECT unnest(['ok', 'empty', 'delimiter_in_field', 'too_short']) AS status)
SELECT status, count(doc_id) AS n_observed, count(doc_id) AS n_written, CAST(coalesce(sum(doc_id), 0) AS BIGINT) AS id_sum,
       CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars
FROM names LEFT JOIN s USING (status) GROUP BY status""")
def quarantine_tables(spark, sf_dir):
    """K10 + A1 in one scan: documents written to a folder per status; the counts from the
    files' footers beside what the folders hold."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "by-status")
    checks = _text_checks()
    counts = Q.write_by_status(docs, checks, path)
    out = None
    for name in Q.statuses(checks):
        one = Q.read_status(docs, path, name).agg(
            F.lit(counts[name]).cast("bigint").alias("n_observed"), F.count(F.lit(1)).alias("n_written"),
            F.coalesce(F.sum("doc_id"), F.lit(0)).cast("bigint").alias("id_sum"),
            F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("n_chars"))
        one = one.select(F.lit(name).alias("status"), "*")
        out = one if out is None else out.unionByName(one)
    return out


#: files of one micro-batch at most
STREAM_FILES = 64


@query("stream_append", sql="""
SELECT event_type, count(*) AS n_events, CAST(sum(json_extract(props, '$.k')::BIGINT) AS BIGINT) AS sum_k
FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY event_type""")
def stream_append(spark, sf_dir):
    """Events arrive as files of two streams that append to one table; each
    micro-batch is parsed (F7), filtered (P1), numbered and appended; the
    appended table is then aggregated.  It equals the batch result."""
    events = load(spark, sf_dir, "events")
    out = scratch_path(spark, "events-appended")

    def parse(df):
        k = F.get_json_object("props", "$.k").cast("bigint")
        return df.select("event_id", "event_type", k.alias("k")).filter(F.col("k").isNotNull())

    for name, part in (("even", "pmod(event_id, 2) = 0"), ("odd", "pmod(event_id, 2) <> 0 or event_id is null")):
        landing = scratch_path(spark, f"events-{name}")
        events.where(part).write.parquet(landing)
        incremental_append(spark, landing, events.schema, out, f"{out}-checkpoint-{name}", parse, ["event_id"],
                           glob="*.parquet", files_per_batch=STREAM_FILES)
    appended = spark.read.parquet(out)
    return appended.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                              F.sum("k").cast("bigint").alias("sum_k"))
