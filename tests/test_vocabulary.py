"""Dictionary coding against the public tokenizers library, on its own vocabularies and trained ones."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairforge.functions import arrays as A
from pairforge.operators import bpe, vocabulary as V
from pairforge.operators import features as Z

TEXTS = ["the theme of the thesis is there", "then they thought that these were the same", "", None,
         "ein kleines Beispiel für die Übung", "números 123 y 4567, otra vez 123\n\n  x", " " * 40, "日本語のテキスト",
         "a" * 3000, "abcab" * 400, "aaab" * 7 + " don't we'll"]


def _vocabulary(spark, merges):
    tokens = [(t, i) for i, t in enumerate(bpe.vocabulary(merges))]
    return V.Vocabulary(spark.createDataFrame(tokens, "token string, id int"), bpe.merges_frame(spark, merges), 1)


def _library(vocab: V.Vocabulary):
    from tokenizers import Tokenizer, models, pre_tokenizers
    ids = {r.t: r.id for r in vocab.tokens.select(V.hex_to_alphabet(F.col("token")).alias("t"), "id").where("id > 4").collect()}
    rows = vocab.merges.select("rank", *(V.hex_to_alphabet(F.col(c)).alias(c) for c in ("left", "right"))).collect()
    tokenizer = Tokenizer(models.BPE(vocab=ids, merges=[(r.left, r.right) for r in sorted(rows)]))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    return tokenizer


def _encoded(spark, texts, vocab):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    return V.encode(df, "k", bpe.pretokens(F.col("text")), vocab)


def test_equals_the_library_and_decodes(spark):
    words = bpe.pretoken_counts(spark.createDataFrame([(t,) for t in TEXTS * 3], "text string"), "text", 1)
    vocab = _vocabulary(spark, bpe.train_bpe(words, 261 + 60, 2))
    rnd = random.Random(4)
    texts = TEXTS + ["".join(rnd.choice("abtheris nü9.\n") for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    coded = _encoded(spark, texts, vocab)
    got = {r.k: r.ids for r in coded.collect()}
    library = _library(vocab)
    assert got == {k: library.encode(t or "").ids for k, t in enumerate(texts)}
    back = {r.k: r.text for r in V.decode(coded, "k", "ids", vocab).collect()}
    assert back == {k: t or "" for k, t in enumerate(texts)}


def test_shipped_vocabulary_file(spark, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = public.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = TEXTS[:-3] + ["An unusually antidisestablishmentarian sentence, isn't it?  Tabs\t\tand 12345 numbers."]
    want = {k: library.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(texts)}
    vocab = V.read_vocabulary(spark, path)
    assert {r.k: r.ids for r in _encoded(spark, texts, vocab).collect()} == want
    monkeypatch.setattr(V, "BROADCAST_TOKENS", 10)  # a vocabulary too large to broadcast gives the same
    assert {r.k: r.ids for r in _encoded(spark, texts[:3], vocab).collect()} == {k: want[k] for k in range(3)}


def test_files_round_trip_and_unknown(spark, tmp_path):
    merges = [("61", "62"), ("6162", "63")]
    tokens = spark.createDataFrame([("61", 7), ("62", 8), ("63", 9), ("6162", 10), ("616263", 11), ("20", 12), ("C3", 13)],
                                   "token string, id int")
    vocab = V.Vocabulary(tokens, bpe.merges_frame(spark, merges), None)
    V.write_vocabulary(vocab, str(tmp_path))
    again = V.read_vocabulary(spark, str(tmp_path))
    assert sorted(map(tuple, again.tokens.collect())) == sorted(map(tuple, tokens.collect()))
    assert sorted(map(tuple, again.merges.collect())) == sorted(map(tuple, vocab.merges.collect()))
    got = {r.k: r.ids for r in _encoded(spark, ["abcab", "abz é"], again._replace(unk_id=1)).collect()}
    assert got == {0: [11, 10], 1: [10, 1, 12, 13, 1]}
    with pytest.raises(FileNotFoundError):
        V.read_vocabulary(spark, str(tmp_path / "nothing"))


def test_word_lookup_with_unknown(spark):
    df = spark.createDataFrame([(1, "b a b c"), (2, "a  z"), (3, ""), (4, None)], "k int, t string")
    words = F.filter(F.split("t", " "), lambda w: w != "")
    vocab = V.frequent_words(df, words, min_frequency=2)
    assert {r.word: r.id for r in vocab.collect()} == {"a": 5, "b": 6}
    got = {r.k: r.ids for r in V.lookup_ids(df, ["k"], words, vocab, Z.UNK).collect()}
    assert got == {1: [6, 5, 6, 1], 2: [5, 1], 3: [], 4: []}


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_words_are_merged_together_as_one_by_one():
    """By whole arrays as pair by pair, with runs of one symbol, ranks out of order and a merge that comes twice."""
    rnd = random.Random(7)
    for _ in range(300):
        symbols, merges = ["61", "62", "63"], []
        for _ in range(rnd.randint(0, 12)):
            merges.append((rnd.choice(symbols), rnd.choice(symbols)))
            symbols.append("".join(merges[-1]))
        if rnd.random() < 0.3:
            rnd.shuffle(merges)
        merges += rnd.sample(merges, len(merges) // 3)
        names, ranks = V.numbered_symbols([(k, a, b, a + b) for k, (a, b) in enumerate(merges)])
        words = ["".join(rnd.choice("abcc") for _ in range(rnd.randint(0, 25))) for _ in range(8)] + ["a" * 9, "", "z"]
        lengths, found = V.merge_words(*A.byte_strings(pa.array(words)), ranks)
        want = [bpe.merge_symbols([f"{b:02X}" for b in w.encode()], bpe._ranks(merges)) for w in words]
        assert [names[s] for s in found] == [s for w in want for s in w] and list(lengths) == [len(w) for w in want]


def test_encoding_shuffles_no_texts(spark):
    """Places, words and texts went through two shuffles: several times the input on disk."""
    vocab = _vocabulary(spark, [("61", "62"), ("6162", "63")])
    coded = _encoded(spark, TEXTS, vocab)
    assert "hashpartitioning" not in _plan(coded) and "Generate" not in _plan(coded)
    assert coded.count() == len(TEXTS)


def test_rows_of_one_key_become_one_row(spark, monkeypatch):
    """As a vocabulary that is joined gives them: place by place, in order of their ids; null is a key."""
    vocab = _vocabulary(spark, [("61", "62"), ("6162", "63"), ("20", "61")])
    rows = [(1, "abc ab"), (1, "ab"), (1, "é abc z"), (2, "abc"), (None, "a b"), (None, "b a c"), (3, None), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "k int, text string").repartition(3)
    got = sorted(map(str, V.encode(df, "k", bpe.pretokens(F.col("text")), vocab).collect()))
    monkeypatch.setattr(V, "BROADCAST_TOKENS", 10)
    assert len(got) == 5 and got == sorted(map(str, V.encode(df, "k", bpe.pretokens(F.col("text")), vocab).collect()))


def test_unknown_symbols_without_an_unknown_id(spark):
    """A symbol without an id has none, and one with two ids has both."""
    tokens = spark.createDataFrame([("61", 7), ("6162", 9), ("6162", 3), ("63", None)], "token string, id int")
    for unk, want in ((None, [3, 9, None, 7, None]), (1, [3, 9, 1, 7, 1])):
        vocab = V.Vocabulary(tokens, bpe.merges_frame(spark, [("61", "62")]), unk)
        assert [r.ids for r in _encoded(spark, ["abcax"], vocab).collect()] == [want]


def test_decoding_rows_by_themselves_gives_what_joining_tokens_does(spark):
    """Through a shuffle of every token, the query's disk was several times its input."""
    tokens = spark.createDataFrame([("61", 7), ("C3", 9), ("A9", 3), ("62", 3), ("[UNK]", 1), (None, 8), ("63", None)], "token string, id int")
    vocab = V.Vocabulary(tokens, bpe.merges_frame(spark, [("61", "62")]), 1)
    rows = [(1, [7, 9, 3, 7]), (2, []), (3, None), (4, [5, None, 7, -1, 8]), (None, [9, 7]), (5, [7, 1])]
    df = spark.createDataFrame(rows, "k int, ids array<int>").repartition(3)
    alone, joined = V.decode(df, "k", "ids", vocab, one_row_each=True), V.decode(df, "k", "ids", vocab)
    assert "hashpartitioning" in _plan(joined) and "hashpartitioning" not in _plan(alone) and "Generate" not in _plan(alone)
    assert sorted(map(str, alone.collect())) == sorted(map(str, joined.collect()))
    assert alone.schema == joined.schema
