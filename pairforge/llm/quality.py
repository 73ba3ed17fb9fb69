"""Quality by the log-likelihood ratio of hashed n-grams, with base rules.

Words and word pairs are hashed into buckets.  A bucket's weight is the log
ratio of its shares among the trusted documents (smoothed towards all
documents) and among all documents; a document's score is the mean weight of its n-grams.  Weights are
whole millionths, so sums don't depend on the order of rows and the threshold
decides every document the same way each time.

DataFrame functions only.  The weights are one row per bucket (a fixed
number), joined by broadcast.

Defined cases (see also ``common``): null text has no words and fails the
base rules; without trusted documents every weight is 0; no rows: an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import beside, documents, save

BUCKETS = 16_384
#: smallest mean log ratio of a kept document: labelled clean documents lie above, labelled junk below
THRESHOLD = -0.06
MILLION = 1_000_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_WHITE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), "")


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(at: DataFrame) -> DataFrame:
    """Adds n_repeat_words: the words in 3-word windows that occur twice or more.

    The windows' hashes are sorted with their places; places whose neighbour has
    the same hash are the repeated ones, and each covers three words or up to
    the next."""
    trios = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).otherwise(
        F.array().cast("array<bigint>"))
    at = at.withColumn("_trios", trios)
    ranked = F.when(F.size(F.array_distinct("_trios")) < F.size("_trios"), F.sort_array(
        F.transform("_trios", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>"))
    at = at.withColumn("_ranked", ranked)
    places = F.sort_array(F.transform(
        F.filter("_ranked", lambda x, k: (x["h"] == F.get("_ranked", k - 1)["h"])
                 | (x["h"] == F.get("_ranked", k + 1)["h"])), lambda x: x["i"]))
    at = at.withColumn("_places", places)
    steps = F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3))))
    return at.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, s: a + s))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _WHITE, "") != "")
    at = documents(docs, "text").select("doc_id", text.alias("text"), words(F.col("text")).alias("words"),
                                        lines.alias("lines"))
    counted = _repeat_words(at).select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        _length_without(F.col("text"), _WHITE).cast("bigint").alias("word_chars"),
        (F.length("text") - _length_without(F.col("text"), _SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words")
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _grams(rows: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """One row per word and word pair: the kept columns and its bucket."""
    rows = rows.select(*keep, words(F.col("text")).alias("words"))
    singles = F.transform("words", lambda w: F.xxhash64(w))
    pairs = F.when(F.size("words") >= 2, F.transform(
        F.sequence(F.lit(0), F.size("words") - 2),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1)))).otherwise(F.array().cast("array<bigint>"))
    return (rows.select(*keep, F.explode(F.concat(singles, pairs)).alias("gram"))
            .select(*keep, F.pmod("gram", F.lit(buckets)).alias("bucket")))


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight in millionths) from all documents and the trusted doc_ids."""
    marked = documents(docs, "text").join(
        beside(trusted.where("doc_id is not null").select(F.col("doc_id").cast("bigint"), F.lit(1).alias("trusted"))
               .distinct()), "doc_id", "left")
    # one row per bucket: written, as the totals and the weights both read it
    counts = save(_grams(marked.select("text", F.coalesce("trusted", F.lit(0)).alias("trusted")), buckets, "trusted")
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")), "quality-counts")
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw, target = totals["raw"] or 0, totals["target"] or 0
    # the raw share is the prior of the target share: rare buckets lean to neither side
    share = (F.col("raw") + 1) / F.lit(raw + buckets)
    weight = F.log((F.col("target") + buckets * share) / (F.lit(target + buckets) * share)) if target else F.lit(0.0)
    return counts.select("bucket", F.round(weight * MILLION).cast("bigint").alias("weight"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, score (mean log
    ratio, null without words) and kept.

    ``docs``: doc_id, text; ``labels``: doc_id, quality, toxic.  Trusted are the
    documents of quality 1 that are not toxic."""
    weights = bucket_weights(docs, labels.where("quality = 1 and coalesce(toxic, 0) = 0"), buckets)
    scores = (_grams(documents(docs, "text"),
                     buckets, "doc_id").join(F.broadcast(weights), "bucket", "left")
              .groupBy("doc_id").agg((F.sum(F.coalesce("weight", F.lit(0))) / F.count("*") / MILLION).alias("score")))
    return (base_rules(docs).join(scores, "doc_id", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))))
