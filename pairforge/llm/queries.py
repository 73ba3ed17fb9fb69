"""Registered queries of the training-data operators, one per operator, over
whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.sources.tables import load

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn=None, *, sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register(fn) if fn else register


@_query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.near_dedup import near_duplicates
    return near_duplicates(load(spark, sf_dir, "documents"), threshold_pct=85)


@_query
def op7_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.phrase_dedup import repeated_words
    return (repeated_words(load(spark, sf_dir, "documents"), window=50)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


@_query
def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.suffix_dedup import repeated_bytes
    return (repeated_bytes(load(spark, sf_dir, "documents"), length=50)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


@_query
def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.packing import pack
    return pack(load(spark, sf_dir, "documents"), sequence=2048)


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.language_id import identify
    return identify(load(spark, sf_dir, "documents"))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.quality import judge
    return judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@_query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.html_text import main_text
    return main_text(load(spark, sf_dir, "pages"))


@_query
def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.decontamination import contamination
    return contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.warc import archived
    return archived(load(spark, sf_dir, "pages"), min_bytes=0)


@_query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths: the source and the digits of doc_id make the
    directories, and every tenth file of one is named as its licence file."""
    from pairforge.llm.licences import scan_licences
    number = F.col("doc_id")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), (F.floor(number / 1000)).cast("string"),
                       F.pmod(F.floor(number / 100), F.lit(10)).cast("string"),
                       F.when(F.pmod(number, F.lit(10)) == 0, F.lit("LICENSE"))
                       .otherwise(F.concat(number.cast("string"), F.lit(".txt"))))
    return scan_licences(load(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


@_query
def op12_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.spot_signatures import fingerprints
    return fingerprints(load(spark, sf_dir, "documents"))


# CRC-32 in SQL: the 256-entry table by eight steps of the polynomial, then one
# look-up per byte of each distinct word.
_STEP = "CASE WHEN {x} & 1 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"
_OP13_SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT i, i AS x, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, {_STEP.format(x="x")}, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(x ORDER BY i) AS crcs FROM steps WHERE k = 8),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents WHERE doc_id IS NOT NULL),
target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
raw AS (SELECT doc_id, unnest(ws) AS w FROM words),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(w)), lambda i:
           ('0x' || substr(hex(encode(w)), 2 * i::INT + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT w FROM raw UNION SELECT w FROM target), crc_table),
s AS (SELECT bucket, count(*) AS n FROM raw JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t_all),
gains AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (s_all + 10000) / ((s.n::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM raw JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rk, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rk <= 10 * n // 100 THEN rk END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""


@_query(sql=_OP13_SQL)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.importance import importance
    return importance(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), buckets=10000, max_n=1,
                      seed=2024, min_words=20, percent=10).select("doc_id", "n_features", "weight", "score", "rank")


_OP11_K, _OP11_ROUNDS = 40, 5
_DISTANCE = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"


def _op11_sql() -> str:
    """The rounds unrolled: assignment a<i> to centroids c<i>, then centroids c<i + 1>."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             f"""c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS cluster, v AS c
  FROM (SELECT v, sha256('2:' || vec_id) AS h FROM kept ORDER BY h LIMIT {_OP11_K}))"""]
    for i in range(_OP11_ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT vec_id, v, cluster, {_DISTANCE} AS d FROM kept, c{i}) GROUP BY vec_id)""")
        if i < _OP11_ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY k) AS m FROM (
      SELECT cluster, k, sum(x)::BIGINT AS s, count(*) AS n
      FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS k FROM a{i}) GROUP BY cluster, k)
    GROUP BY cluster) USING (cluster))""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{_OP11_ROUNDS} JOIN c{_OP11_ROUNDS} USING (cluster)"""


@_query(sql=_op11_sql())
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.llm.centroids import cluster
    return cluster(load(spark, sf_dir, "embeddings"), k=_OP11_K, rounds=_OP11_ROUNDS, dims=64, scale=256, seed=2)
