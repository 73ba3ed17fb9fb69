import collections
import random

from pyspark.sql import functions as F

from pairforge.operators import bpe
from pairforge.operators import vocabulary as V

TEXTS = ["the theme of the thesis is there", "then they thought that these were the same",
         "ein kleines Beispiel für die Übung", "números 123 y 4567, otra vez 123"] * 3


def _words(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    return bpe.pretoken_counts(df, "text", 1)


def test_batched_rounds_equal_one_merge_per_round(spark):
    words = _words(spark)
    batched = bpe.train_bpe(words, 261 + 25, 2, top_k=50)
    single = bpe.train_bpe(words, 261 + 25, 2, top_k=50, max_per_round=1)
    assert batched == single and len(batched) > 0


def test_split_rule_is_the_byte_level_one(spark):
    from tokenizers.pre_tokenizers import ByteLevel
    texts = ["  foo don't", "if x:\n\n    return 'tis\t\ty  ", "\u00a0a\u2003 b", "we'll  12ab!? \u00e9t\u00e9", "   ", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rule = ByteLevel(add_prefix_space=False)
    for r in df.select("text", bpe.pretokens(F.col("text")).alias("got")).collect():
        assert "".join(r.got) == r.text
        assert r.got == [r.text[a:b] for _, (a, b) in rule.pre_tokenize_str(r.text)]


def test_batched_rounds_on_runs_of_one_symbol(spark):
    words = spark.createDataFrame([(" " * 8, 100), ("xy", 150), ("aaaa", 90), ("aab", 70), ("\t\t\t", 65)], "pretoken string, n bigint")
    batched = bpe.train_bpe(words, 261 + 9, 2, top_k=3)
    assert batched == bpe.train_bpe(words, 261 + 9, 2, max_per_round=1) and len(batched) > 4


def test_encode_round_trips_bytes(spark):
    words = _words(spark)
    merges = bpe.train_bpe(words, 261 + 20, 2)
    vocab = bpe.vocabulary(merges)
    given = V.Vocabulary(spark.createDataFrame([(t, i) for i, t in enumerate(vocab)], "token string, id int"),
                         bpe.merges_frame(spark, merges))
    df = spark.createDataFrame([(t,) for t in TEXTS[:4]], "text string")
    for r in V.encode(df, "text", bpe.pretokens(F.col("text")), given).collect():
        hexed = "".join(vocab[i] for i in r.ids)
        assert bytes.fromhex(hexed).decode("utf-8") == r.text
        assert len(r.ids) < len(r.text.encode("utf-8"))


def test_merges_by_rank_equal_one_pass_per_merge():
    merges = [("A", "A"), ("A", "B"), ("AA", "AB"), ("B", "C"), ("AB", "C")]
    for word in ("A A A", "A A A B C", "C B A", "A B A B C", "A A A A B C B C", "", "A"):
        want = word.split()
        for left, right in merges:
            out = []
            for symbol in want:
                out = [*out[:-1], left + right] if out and out[-1] == left and symbol == right else [*out, symbol]
            want = out
        assert bpe.merge_symbols(word.split(), bpe._ranks(merges)) == want


def test_a_round_keeps_no_earlier_plan(spark, monkeypatch):
    words, plans = _words(spark).persist(), []
    inner = bpe._summed

    def summed(rows):
        plans.append(len(rows._jdf.queryExecution().toString()))
        return inner(rows)
    monkeypatch.setattr(bpe, "_summed", summed)
    bpe.train_bpe(words, 261 + 24, 2, checkpoint_every=100, max_per_round=2)
    words.unpersist()
    assert len(plans) > 6 and max(plans[2:]) < 1.1 * min(plans[2:])


def _brute(words, n_merges, min_frequency=2):
    """One merge at a time, all pairs counted anew."""
    words, merges = [([f"{b:02X}" for b in w.encode()], n) for w, n in words], []
    while len(merges) < n_merges:
        counts = collections.Counter()
        for symbols, n in words:
            for pair in zip(symbols, symbols[1:]):
                counts[pair] += n
        best = min(counts.items(), key=lambda x: (-x[1], " ".join(x[0])), default=(None, 0))
        if best[1] < min_frequency:
            break
        merges.append(best[0])
        words = [(bpe.merge_symbols(symbols, bpe._ranks(merges[-1:])), n) for symbols, n in words]
    return merges


def test_training_equals_one_merge_at_a_time(spark):
    """Runs of a symbol, symbols made from other parts once more, words with one byte, repeated rows."""
    rnd = random.Random(3)
    for k in range(4):
        rows = [("".join(rnd.choice("aab" if k % 2 else "abcdé ") for _ in range(rnd.randint(1, 12))), rnd.randint(1, 40)) for _ in range(60)]
        words = spark.createDataFrame(rows, "pretoken string, n bigint")
        got = bpe.train_bpe(words, 261 + 14, 2, checkpoint_every=3)
        assert got == _brute(rows, 14) and got


def test_words_are_kept_as_numbers(spark, monkeypatch):
    """Each round made strings of all words' symbols and merged them word by word."""
    seen, inner = [], bpe.written

    def written(df, name):
        seen.append((name, df.schema.simpleString(), df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(seq")))
        return inner(df, name)
    monkeypatch.setattr(bpe, "written", written)
    bpe.train_bpe(_words(spark), 261 + 6, 2, checkpoint_every=1)
    kept = [s for s in seen if s[0] == "bpe-words"]
    assert len(kept) > 1 and {s[1:] for s in kept} == {("struct<symbols:binary,cnt:bigint>", 0)}


def test_a_made_symbol_is_merged_after_it_was_made():
    numbers = {"61": 0, "62": 1, "63": 2, "6162": 3}
    groups = bpe._together([("61", "62"), ("63", "63"), ("6162", "63")], numbers)
    assert [g.tolist() for g in groups] == [[[0, 1, 3], [2, 2, 4]], [[3, 2, 5]]] and numbers["6363"] == 4
