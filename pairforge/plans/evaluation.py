"""Labels, metrics and prediction output over ``labels``, ``events``,
``embeddings``, ``lineitem``, ``orders``, ``documents``, ``part``, ``nation``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.functions.text import fixed_point
from pairforge.operators import labels as L
from pairforge.operators import metrics as M
from pairforge.operators import rows, splits
from pairforge.operators.index import batch_number, dense_index
from pairforge.plans.registry import query
from pairforge.sources.tables import load


@query("label_vocab", sql="""
SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id
FROM (SELECT DISTINCT CAST(event_type AS VARCHAR) AS label FROM events WHERE event_type <> '-1')""")
def label_vocab(spark, sf_dir):
    """A4 + U3: sorted label list with ids."""
    ev = load(spark, sf_dir, "events").select(F.col("event_type").alias("label"))
    return L.label_vocab(ev).select("label", "label_id")


@query("label_diff", sql="""
WITH r AS (SELECT n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS rk, count(*) OVER () AS n FROM documents),
s AS (SELECT CAST(n_chars AS VARCHAR) AS label,
             CASE WHEN rk < floor(n * 0.7::DOUBLE) THEN 'train'
                  WHEN rk < floor(n * 0.7::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'valid' ELSE 'test' END AS split
      FROM r)
SELECT DISTINCT split, label FROM s
WHERE split <> 'train' AND label NOT IN (SELECT label FROM s WHERE split = 'train')""")
def label_diff(spark, sf_dir):
    """Labels (document lengths as regression-style labels) that occur
    in valid/test but never in train."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("label"))
    sp = splits.ordered_split(docs, ["doc_id"])
    return L.unseen_labels(sp, "label").select("split", "label")


@query("multi_hot", sql="""
WITH vocab AS (SELECT list(event_type ORDER BY event_type) AS v FROM (SELECT DISTINCT event_type FROM events)),
u AS (SELECT user_id, list(DISTINCT event_type) AS labels FROM events GROUP BY user_id),
h AS (SELECT user_id, list_transform(v, lambda x: CASE WHEN list_contains(labels, x) THEN 1 ELSE 0 END) AS hot, v
      FROM u, vocab)
SELECT user_id, array_to_string(hot, ',') AS hot,
       array_to_string(list_filter(v, lambda x, i: hot[i] = 1), ',') AS decoded
FROM h""")
def multi_hot(spark, sf_dir):
    """per user, the set of event types as a multi-hot row and back."""
    ev = load(spark, sf_dir, "events").select("user_id", "event_type")
    vocab = L.require_classes(L.label_vocab(ev, "event_type", drop=(), total="n_labels"))
    u = L.label_sets(ev, "user_id", "event_type", vocab)
    hot = L.dense_hot(F.col("ids"), F.col("n_labels"))
    return u.select("user_id", F.array_join(F.transform(hot, lambda x: x.cast("string")), ",").alias("hot"),
                    F.array_join("names", ",").alias("decoded"))


@query("binary_metrics", sql="""
WITH c AS (SELECT count(*) AS n, count_if(toxic = quality) AS ok,
                  count_if(toxic = 1 AND quality = 1) AS tp, count_if(toxic = 1 AND quality <> 1) AS fp,
                  count_if(toxic <> 1 AND quality = 1) AS fn FROM labels),
m AS (SELECT n, ok / n AS acc, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM c)
SELECT n, round(acc, 6) AS acc, round(f1, 6) AS f1, round((acc + f1) / 2, 6) AS acc_and_f1 FROM m""")
def binary_metrics(spark, sf_dir):
    """Prediction ``toxic`` against truth ``quality``."""
    lab = load(spark, sf_dir, "labels").select(F.col("toxic").alias("pred"), F.col("quality").alias("label"))
    m = M.acc_and_f1(lab)
    return m.select("n", F.round("acc", 6).alias("acc"), F.round("f1", 6).alias("f1"),
                    F.round("acc_and_f1", 6).alias("acc_and_f1"))


@query("argmax_metrics", sql="""
SELECT vec_id, pred, label, CAST(pred = label AS INT) AS correct FROM (
  SELECT vec_id, label, CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS INT) AS pred
  FROM embeddings)""")
def argmax_metrics(spark, sf_dir):
    """F11 + J10: argmax of the first 10 logits joined to the truth by row id."""
    emb = load(spark, sf_dir, "embeddings")
    preds = emb.select("vec_id", M.argmax(F.slice("embedding", 1, 10)).alias("pred"))
    truth = emb.select("vec_id", "label")
    out = preds.join(truth, "vec_id")
    return out.select("vec_id", "pred", "label", (F.col("pred") == F.col("label")).cast("int").alias("correct"))


@query("micro_f1", sql="""
WITH cells AS (SELECT CAST(e.embedding[r.i + 1] > 0 AS INT) AS p, CAST(e.label = r.i AS INT) AS y
               FROM embeddings e, range(10) r(i)),
c AS (SELECT CAST(count_if(p = 1 AND y = 1) AS BIGINT) AS tp, CAST(count_if(p = 1 AND y = 0) AS BIGINT) AS fp,
             CAST(count_if(p = 0 AND y = 1) AS BIGINT) AS fn FROM cells)
SELECT tp, fp, fn, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS micro_f1
FROM c""")
def micro_f1(spark, sf_dir):
    """Thresholded first-10 logits against the one-hot label."""
    emb = load(spark, sf_dir, "embeddings")
    pred = M.threshold_hot(F.slice("embedding", 1, 10))
    truth = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == F.col("label"), 1).otherwise(0))
    c = emb.agg(*M.micro_counts(pred, truth))
    return c.select("tp", "fp", "fn", F.round(M.micro_f1_from_counts(F.col("tp"), F.col("fp"), F.col("fn")), 6)
                    .alias("micro_f1"))


@query("mse", sql="""
SELECT l_returnflag, count(*) AS n, round(avg(pow(l_discount - l_tax, 2)), 9) AS mse
FROM lineitem GROUP BY l_returnflag""")
def mse_q(spark, sf_dir):
    """Regression error of ``l_discount`` against ``l_tax`` per flag."""
    li = load(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                          F.round(M.mse(F.col("l_discount"), F.col("l_tax")), 9).alias("mse"))


_LOSS_SQL = """
SELECT vec_id, (m + ln(list_sum(list_transform(l, lambda x: exp(x - m))))) - l[label + 1] AS loss
FROM (SELECT vec_id, label, CAST(embedding[1:10] AS DOUBLE[]) AS l, list_max(CAST(embedding[1:10] AS DOUBLE[])) AS m
      FROM embeddings)"""


def _losses(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings")
    logits = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    return emb.select("vec_id", M.cross_entropy(logits, F.col("label")).alias("loss"))


@query("perplexity", sql=f"""
SELECT count(*) AS n, round(avg(loss), 6) AS mean_loss, round(exp(avg(loss)), 6) AS perplexity
FROM ({_LOSS_SQL})""")
def perplexity(spark, sf_dir):
    """Exp of the mean cross-entropy of the first-10 logits."""
    ls = _losses(spark, sf_dir)
    return ls.agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("ml")).select(
        "n", F.round("ml", 6).alias("mean_loss"), F.round(M.perplexity(F.col("ml")), 6).alias("perplexity"))


@query("mean_batch_loss", sql=f"""
SELECT count(*) AS n_batches, round(avg(bl), 6) AS mean_batch_loss FROM (
  SELECT b, avg(loss) AS bl FROM (
    SELECT floor((row_number() OVER (ORDER BY vec_id) - 1) / 32) AS b, loss FROM ({_LOSS_SQL})) GROUP BY b)""")
def mean_batch_loss(spark, sf_dir):
    """Mean over batches of 32 rows of each batch's mean loss."""
    ls = dense_index(_losses(spark, sf_dir), ["vec_id"], "idx")
    per = ls.groupBy(batch_number("idx", 32).alias("b")).agg(F.avg("loss").alias("bl"))
    return per.agg(F.count(F.lit(1)).alias("n_batches"), F.round(F.avg("bl"), 6).alias("mean_batch_loss"))


_RUNS_SQL = """
SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS epoch,
       count_if(o_orderstatus = 'F') / count(*) AS acc
FROM orders GROUP BY 1"""


def _runs(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    epoch = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("bigint")
    return o.groupBy(epoch.alias("epoch")).agg(
        (F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("acc"))


@query("best_run", sql=f"""
SELECT epoch AS best_epoch, round(acc, 6) AS best_acc FROM ({_RUNS_SQL}) ORDER BY acc DESC, epoch LIMIT 1""")
def best_run(spark, sf_dir):
    """Best epoch (month) by accuracy (share of finished orders); ties -> first."""
    b = M.best_run(_runs(spark, sf_dir))
    return b.select("best_epoch", F.round("best_acc", 6).alias("best_acc"))


@query("running_best", sql=f"""
SELECT epoch, round(acc, 6) AS acc, round(prev_best, 6) AS prev_best,
       CAST(acc > coalesce(prev_best, '-inf'::DOUBLE) AS INT) AS improved
FROM (SELECT epoch, acc, max(acc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best
      FROM ({_RUNS_SQL}))""")
def running_best(spark, sf_dir):
    """Running best over earlier epochs."""
    r = M.running_best(_runs(spark, sf_dir))
    return r.select("epoch", F.round("acc", 6).alias("acc"), F.round("prev_best", 6).alias("prev_best"), "improved")


@query("length_stats", sql=f"""
SELECT lang, count(*) AS n, min(w) AS min_len, max(w) AS max_len, round(avg(w), 6) AS avg_len,
       round(quantile_cont(w, 0.25), 6) AS q1, round(quantile_cont(w, 0.75), 6) AS q3
FROM (SELECT lang, len(regexp_extract_all(text, '{T.WORD_RX}')) AS w FROM documents) GROUP BY lang""")
def length_stats(spark, sf_dir):
    """A3: word-length statistics per language."""
    docs = load(spark, sf_dir, "documents", spread=True).select("lang", T.word_count(F.col("text")).cast("bigint").alias("w"))
    s = M.length_stats(docs, "w", ["lang"])
    return s.select("lang", "n", "min_len", "max_len", F.round("avg_len", 6).alias("avg_len"),
                    F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"))


@query("join_text_columns", sql="""
SELECT p_partkey, concat_ws(' ', coalesce(p_name, ''), coalesce(p_brand, ''), coalesce(p_type, '')) AS sentence
FROM part""")
def join_text_columns(spark, sf_dir):
    """Several text columns joined into one ``sentence``."""
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", rows.join_text_columns(["p_name", "p_brand", "p_type"]).alias("sentence"))


@query("prediction_lines", sql="""
WITH names AS (SELECT list(n_name ORDER BY n_nationkey) AS v, count(*) AS k FROM nation),
p AS (SELECT vec_id, CAST(embedding[1:k] AS DOUBLE[]) AS l, v FROM embeddings, names)
SELECT vec_id AS idx,
       printf('%3.3f', l[1]) AS regression,
       v[list_position(l, list_max(l))] AS single_label,
       array_to_string(list_filter(v, lambda x, i: l[i] > 0), ',') AS multi_label
FROM p""")
def prediction_lines(spark, sf_dir):
    """K7 + F10-F12: prediction text for regression, single- and multi-label."""
    names = dense_index(load(spark, sf_dir, "nation").select("n_name", "n_nationkey"), ["n_nationkey"], "label_id")
    emb = load(spark, sf_dir, "embeddings")
    # one logit per class: the values beyond the last class find no name
    logits = (emb.select(F.col("vec_id").alias("idx"), F.posexplode("embedding").alias("at", "x"))
              .select("idx", F.col("at").cast("bigint").alias("label_id"), F.col("x").cast("double").alias("x"))
              .join(names, "label_id"))
    named = F.struct("label_id", F.col("n_name").alias("name"))
    per_row = logits.groupBy("idx").agg(
        F.min_by("x", "label_id").alias("first"), F.max_by("n_name", F.struct("x", -F.col("label_id"))).alias("single_label"),
        F.array_sort(F.collect_list(F.when(F.col("x") > 0, named))).alias("positive"))
    return per_row.select("idx", fixed_point(F.col("first")).alias("regression"), "single_label",
                          F.array_join(F.col("positive.name"), ",").alias("multi_label"))
