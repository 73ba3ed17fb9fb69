"""The function store as a query: written in two parts, one of them twice, and looked up."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.plans.registry import query
from pairforge.session import scratch_path
from pairforge.sources import store
from pairforge.sources.tables import load

#: signatures that are looked up
LOOKUPS = 20


@query("signature_store", sql=f"""
WITH f AS (SELECT '0x' || md5(CAST(doc_id AS VARCHAR)) AS codehash, regexp_extract(text, '{T.WORD_RX}') AS w, text
           FROM documents WHERE regexp_matches(text, '{T.WORD_RX}')),
s AS (SELECT codehash, w || '()' AS signature, text FROM f),
wanted AS (SELECT DISTINCT signature FROM s ORDER BY md5(signature) LIMIT {LOOKUPS})
SELECT signature, codehash, length(text) AS n_chars, md5(text) AS text_md5 FROM s WHERE signature IN (SELECT signature FROM wanted)""")
def signature_store(spark, sf_dir):
    """K5 + S8: functions (a document stands for a function named by its first word) are stored in
    two parts, the second of them sent twice under one key; then 20 signatures are looked
    up in the files that the manifest names."""
    docs = load(spark, sf_dir, "documents")
    word = F.regexp_extract("text", T.WORD_RX, 0)
    functions = docs.select("doc_id", F.concat(F.lit("0x"), F.md5(F.col("doc_id").cast("string"))).alias("codehash"),
                            F.when(word != "", F.concat(word, F.lit("()"))).alias("signature"), "text")
    path = scratch_path(spark, "function-store")
    even = F.col("doc_id") % 2 == 0
    store.append(functions.where(even).drop("doc_id"), path, "even")
    for _ in range(2):  # a repeated append changes nothing
        store.append(functions.where(~even).drop("doc_id"), path, "odd")
    known = functions.where("signature is not null").select("signature").distinct()
    wanted = [r.signature for r in known.orderBy(F.md5("signature")).limit(LOOKUPS).collect()]
    found = store.lookup(spark, path, wanted)
    return found.select("signature", "codehash", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))
