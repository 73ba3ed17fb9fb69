"""Vocabulary queries on ``documents``: pre-token counts, BPE training,
encoding and encoded-length statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.operators import bpe
from pairforge.operators import features as Z
from pairforge.operators import metrics as M
from pairforge.operators import vocabulary as V
from pairforge.operators.pairs import match_pairs
from pairforge.plans.pairing import _VIEWS_SQL, conversation_views
from pairforge.plans.registry import query
from pairforge.session import scratch_path
from pairforge.sources.cache import cached_table, content_stamp
from pairforge.sources.tables import load, table_path

# Size of the shipped vocabulary (5 specials + 256 bytes + 185 merges).
VOCAB_SIZE = 446
MIN_FREQUENCY = 2
# Length of the looked-up pair features.
PAIR_LEN = 64


# DuckDB has no look-ahead: a mark (U+E000, in no text) before the last white-space
# character in front of a word ends the run there.
_MARK = "chr(57344)"
_RULE = "||".join([f"'{bpe.CONTRACTIONS.replace(chr(39), chr(39) * 2)}| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{bpe.SPACE}\\p{{L}}\\p{{N}}'",
                   _MARK, f"']+|[{bpe.SPACE}]+'"])


@query("pretoken_counts", sql=f"""
SELECT pretoken, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(regexp_replace(text, '([{bpe.SPACE}])([^{bpe.SPACE}])',
                                                      {_MARK} || '\\1\\2', 'g'), {_RULE})) AS pretoken FROM documents)
GROUP BY pretoken HAVING count(*) >= {MIN_FREQUENCY}""")
def pretoken_counts(spark, sf_dir):
    """Pre-token frequencies with the minimum frequency applied."""
    docs = load(spark, sf_dir, "documents", spread=True)
    return bpe.pretoken_counts(docs, "text", MIN_FREQUENCY)


def trained_merges(spark, sf_dir, vocab_size: int = VOCAB_SIZE) -> list[tuple[str, str]]:
    """Merges learnt from all documents, cached per (files of the input, parameters)."""
    def build():
        docs = load(spark, sf_dir, "documents", spread=True)
        words = bpe.pretoken_counts(docs, "text", 1)
        return bpe.merges_frame(spark, bpe.train_bpe(words, vocab_size, MIN_FREQUENCY))
    key = {"kind": "bpe", "input": table_path(sf_dir, "documents"),
           "stamp": content_stamp(load(spark, sf_dir, "documents")), "vocab_size": vocab_size,
           "min_frequency": MIN_FREQUENCY, "version": 2}
    table = cached_table(spark, key, build)
    return [(r.left, r.right) for r in table.orderBy("rank").collect()]


@query("bpe_train")
def bpe_train(spark, sf_dir):
    """Ranked merges (rank, left, right, token text)."""
    merges = trained_merges(spark, sf_dir)
    return bpe.merges_frame(spark, merges).withColumn("text", bpe.symbol_text(F.col("token")))


def trained_vocabulary(spark, sf_dir) -> V.Vocabulary:
    """The trained vocabulary, written to files and read back as a given one would be."""
    merges = trained_merges(spark, sf_dir)
    tokens = spark.createDataFrame([(t, i) for i, t in enumerate(bpe.vocabulary(merges))], "token string, id int")
    # the special tokens' texts stand for themselves in the files
    specials = len(bpe.SPECIAL_TOKENS)
    tokens = tokens.withColumn("token", F.when(F.col("id") < specials, F.hex(F.encode("token", "UTF-8"))).otherwise(F.col("token")))
    folder = scratch_path(spark, "vocabulary")
    V.write_vocabulary(V.Vocabulary(tokens, bpe.merges_frame(spark, merges)), folder)
    return V.read_vocabulary(spark, folder)


def _encoded(spark, sf_dir, vocab=None):
    """(doc_id, ids) of every document."""
    docs = load(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    return V.encode(docs, "doc_id", bpe.pretokens(F.col("text")), vocab or trained_vocabulary(spark, sf_dir))


@query("bpe_encode")
def bpe_encode(spark, sf_dir):
    """Every document encoded with the trained vocabulary, through its files."""
    e = _encoded(spark, sf_dir)
    return e.select("doc_id", F.size("ids").alias("n_tokens"),
                    F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), " ")).alias("ids_md5"))


@query("bpe_decode", sql="""
SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM documents""")
def bpe_decode(spark, sf_dir):
    """Z1 there and back: the documents encoded with the vocabulary read from its files, then
    decoded; the texts are those that went in."""
    vocab = trained_vocabulary(spark, sf_dir)
    back = V.decode(_encoded(spark, sf_dir, vocab), "doc_id", "ids", vocab, one_row_each=True)
    return back.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("bpe_length_stats")
def bpe_length_stats(spark, sf_dir):
    """A3 on encoded lengths (min, max, mean, quartiles) per language."""
    langs = load(spark, sf_dir, "documents").select("doc_id", "lang")
    e = _encoded(spark, sf_dir).select("doc_id", F.size("ids").alias("n")).join(langs, "doc_id")
    s = M.length_stats(e, "n", ["lang"])
    return s.select("lang", F.col("n").alias("n_docs"), "min_len", "max_len",
                    F.round("avg_len", 6).alias("avg_len"), F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"))


_WORD_VOCAB_SQL = f"""
counts AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{T.WORD_RX}')) AS w FROM documents) GROUP BY w),
vocab AS (SELECT w, row_number() OVER (ORDER BY n DESC, w) + 4 AS id FROM counts WHERE n >= {MIN_FREQUENCY})"""


def word_vocabulary(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", spread=True)
    return V.frequent_words(docs, T.words(F.col("text")), MIN_FREQUENCY, Z.N_SPECIAL)


@query("vocab_lookup", sql=f"""
WITH {_WORD_VOCAB_SQL},
words AS (SELECT item_id, w, i FROM (
  SELECT item_id, unnest(l) AS w, unnest(range(len(l))) AS i
  FROM (SELECT item_id, regexp_extract_all(text, '{T.WORD_RX}') AS l FROM benchmark))),
ids AS (SELECT item_id, list(coalesce(id, {Z.UNK}) ORDER BY i) AS ids FROM words LEFT JOIN vocab USING (w) GROUP BY item_id)
SELECT b.item_id, coalesce(len(ids), 0) AS n_ids, coalesce(len(list_filter(ids, lambda x: x = {Z.UNK})), 0) AS n_unknown,
       md5(array_to_string(coalesce(ids, []), ' ')) AS ids_md5
FROM benchmark b LEFT JOIN ids USING (item_id)""")
def vocab_lookup(spark, sf_dir):
    """Benchmark words looked up in the documents' word vocabulary, unknown words as [UNK]."""
    items = load(spark, sf_dir, "benchmark")
    e = V.lookup_ids(items, ["item_id"], T.words(F.col("text")), word_vocabulary(spark, sf_dir), Z.UNK)
    return e.select("item_id", F.size("ids").cast("bigint").alias("n_ids"),
                    F.size(F.filter("ids", lambda x: x == Z.UNK)).cast("bigint").alias("n_unknown"),
                    F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), " ")).alias("ids_md5"))


@query("vocab_pair_features", sql=f"""
WITH {_WORD_VOCAB_SQL}, {_VIEWS_SQL},
places AS (
  SELECT codehash, selector, side, w, i FROM (
    SELECT codehash, selector, side, unnest(l) AS w, unnest(range(len(l))) AS i FROM (
      SELECT codehash, selector, 'a' AS side, regexp_extract_all(src_text, '{T.WORD_RX}') AS l FROM matched
      UNION ALL SELECT codehash, selector, 'b', regexp_extract_all(dec_text, '{T.WORD_RX}') FROM matched))),
ids AS (SELECT codehash, selector, side, list(coalesce(id, {Z.UNK}) ORDER BY i) AS ids
        FROM places LEFT JOIN vocab USING (w) GROUP BY codehash, selector, side),
ab AS (SELECT m.codehash, m.selector, coalesce(x.ids, [])[1:50] AS a, coalesce(y.ids, []) AS b FROM matched m
       LEFT JOIN ids x ON x.codehash = m.codehash AND x.selector = m.selector AND x.side = 'a'
       LEFT JOIN ids y ON y.codehash = m.codehash AND y.selector = m.selector AND y.side = 'b'),
tr AS (SELECT *, least(len(a), greatest({PAIR_LEN - 3} - len(b), {(PAIR_LEN - 2) // 2})) AS la,
                 least(len(b), greatest({PAIR_LEN - 3} - len(a), {(PAIR_LEN - 3) // 2})) AS lb FROM ab),
f AS (SELECT codehash, selector, [2] || a[1:la] || [3] || CASE WHEN lb > 0 THEN b[1:lb] || [3] ELSE [] END AS ids FROM tr)
SELECT codehash, selector, len(ids) AS n_real,
       md5(array_to_string(list_transform(range({PAIR_LEN} - len(ids)), lambda x: 0) || ids, ' ')) AS ids_md5 FROM f""")
def vocab_pair_features(spark, sf_dir):
    """Z2-Z6 on looked-up ids: matched pairs as [CLS] A [SEP] B [SEP], cut to 64 and padded on the left."""
    src, dec = conversation_views(spark, sf_dir)
    m = match_pairs(src, dec)
    key = ["codehash", "selector"]
    vocab = word_vocabulary(spark, sf_dir)
    a, b = (V.lookup_ids(m, key, T.words(F.col(c)), vocab, Z.UNK).withColumnRenamed("ids", name)
            for c, name in (("src_text", "a"), ("dec_text", "b")))
    f = Z.pair_features(a.join(b, key), "a", "b", max_len=PAIR_LEN, first_cap=50, left=True)
    return f.select(*key, F.aggregate("input_mask", F.lit(0), lambda acc, x: acc + x).cast("bigint").alias("n_real"),
                    F.md5(F.array_join(F.transform("input_ids", lambda x: x.cast("string")), " ")).alias("ids_md5"))
