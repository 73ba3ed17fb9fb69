"""Encoding with a given vocabulary (Z1, J12): files, dictionary coding, decoding.

A vocabulary is two tables: tokens ``(token, id)`` and ranked merges ``(rank, left,
right, token)``; a token is its bytes in hex.  ``read_vocabulary`` reads both from a
``tokenizer.json`` or from ``vocab.json`` and ``merges.txt`` in the byte-level alphabet.

Texts are coded where they are read: a task takes slices of its rows, merges each distinct
pre-token of a slice once, all of them together by whole arrays (``merge_words``), and puts
their ids in their places.  No text, word or place is shuffled; only rows whose key comes
again are brought together.

A vocabulary of more than ``BROADCAST_TOKENS`` entries is not sent to the tasks.  Texts are then
coded through the table of their distinct pre-tokens (``encode_words``), and the words' ids are
joined back to their places.  A word is merged without rounds: every substring that some merge
makes is an instance ``(rank, start, middle, end)``, found by a join of the word's substrings with
the merges.  A merge that uses a token always ranks behind the one that makes it, so
walking the instances once in order of rank, from left to right, and removing the boundary
in the middle where both parts are symbols of that moment, is byte-pair encoding.
Instances that don't overlap can't touch each other: a word falls into segments at the
places that no instance spans, and each segment is walked by itself.

All steps after the substrings keep the words' partitioning.
"""

from __future__ import annotations

import json
import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.functions import arrays as A
from pairforge.session import written

#: entries of a vocabulary that are sent to every executor (about 100 bytes each)
BROADCAST_TOKENS = 500_000
#: longer pre-tokens are keyed by a digest, so that rows stay small
KEY_CHARS = 32


class Vocabulary(NamedTuple):
    tokens: DataFrame          # token string (hex bytes, or a special token's text), id int
    merges: DataFrame          # rank int, left string, right string, token string
    unk_id: int | None = None


def byte_alphabet() -> tuple[str, str]:
    """The byte-level alphabet's characters beyond Latin-1 and the bytes they stand for:
    printable bytes stand for themselves, the others follow from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(256 + k) for k in range(len(hidden))), "".join(map(chr, hidden))


def alphabet_to_hex(token: Column) -> Column:
    """A token in the byte-level alphabet as the hex of its bytes."""
    letters, bytes_ = byte_alphabet()
    return F.hex(F.encode(F.translate(token, letters, bytes_), "ISO-8859-1"))


def hex_to_alphabet(token: Column) -> Column:
    letters, bytes_ = byte_alphabet()
    return F.translate(F.decode(F.unhex(token), "ISO-8859-1"), bytes_, letters)


def _text(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.text(path, wholetext=True).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_vocabulary(spark: SparkSession, path: str, unk: str = "[UNK]") -> Vocabulary:
    """The vocabulary in a ``tokenizer.json`` file or in a folder that holds one, or
    ``vocab.json`` and ``merges.txt``.  What passes the driver is a file of the size of the
    vocabulary."""
    whole = path if path.endswith(".json") else os.path.join(path, "tokenizer.json")
    text = _text(spark, whole)
    if text is not None:
        model = json.loads(text)["model"]
        ids, merges = model["vocab"], model["merges"]
        unk = model.get("unk_token") or unk
    else:
        ids = json.loads(_text(spark, os.path.join(path, "vocab.json")) or "null")
        if ids is None:
            raise FileNotFoundError(f"no vocabulary in {path}")
        lines = (_text(spark, os.path.join(path, "merges.txt")) or "").split("\n")
        merges = [line.rstrip("\r") for line in lines if line.strip() and not line.startswith("#version")]
    pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
    tokens = spark.createDataFrame(list(ids.items()), "token string, id int")
    merged = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "rank int, left string, right string")
    merged = merged.select("rank", *(alphabet_to_hex(F.col(c)).alias(c) for c in ("left", "right")))
    return Vocabulary(tokens.select(alphabet_to_hex(F.col("token")).alias("token"), "id"),
                      merged.withColumn("token", F.concat("left", "right")), ids.get(unk))


def write_vocabulary(vocab: Vocabulary, path: str) -> None:
    """``vocab.json`` and ``merges.txt`` below ``path``, each written by one task (they have
    the size of the vocabulary)."""
    spark = vocab.tokens.sparkSession
    entries = vocab.tokens.select(hex_to_alphabet(F.col("token")).alias("token"), "id")
    one = entries.groupBy().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("token", "id")))).alias("m"))
    one.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite").text(os.path.join(path, "vocab.json"))
    lines = vocab.merges.select("rank", F.concat_ws(" ", hex_to_alphabet(F.col("left")), hex_to_alphabet(F.col("right"))).alias("value"))
    head = spark.createDataFrame([(-1, "#version: 0.2")], "rank int, value string")
    (head.unionByName(lines).coalesce(1).sortWithinPartitions("rank").select("value")
     .write.mode("overwrite").text(os.path.join(path, "merges.txt")))


def _beside(table: DataFrame, entries: int) -> DataFrame:
    return F.broadcast(table) if entries <= BROADCAST_TOKENS else table


def word_key(word: Column) -> Column:
    return F.when(F.length(word) <= KEY_CHARS, word).otherwise(F.concat(F.lit("\x00"), F.sha2(word, 256)))


def _walked(segment: Column, first: Column, end: Column, instances: Column) -> Column:
    """Boundaries (symbol starts) that are left of a segment after all its merges."""
    def step(starts: Column, m: Column) -> Column:
        inside = F.filter(starts, lambda b: (b >= m["start"]) & (b < m["end"]))
        closed = (m["end"] == end) | F.array_contains(starts, m["end"])
        return F.when((inside == F.array(m["start"], m["middle"])) & closed,
                      F.array_remove(starts, m["middle"])).otherwise(starts)
    return F.aggregate(instances, F.sequence(first, end - 1), step)


def encode_words(words: DataFrame, vocab: Vocabulary, word: str = "pretoken") -> DataFrame:
    """``(word, ids array<int>)`` of distinct non-empty words, keyed by ``word_key``.  A symbol
    that the vocabulary doesn't have gets the unknown id (null without one)."""
    size = vocab.merges.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("token")).alias("longest")).first()
    longest = (size.longest or 2) // 2
    text = F.hex(F.encode(F.col(word), "UTF-8"))
    keyed = words.select(word_key(F.col(word)).alias("word"), text.alias("hex")).withColumn(
        "n", (F.length("hex") / 2).cast("int"))
    # co-located by word from here on: what follows is narrow
    keyed = keyed.groupBy("word").agg(F.first("hex").alias("hex"), F.first("n").alias("n"))

    def piece(start: Column, length: Column) -> Column:
        return F.struct(start.alias("start"), (start + length).alias("end"),
                        F.substring("hex", start * 2 + 1, length * 2).alias("piece"))
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.col("n") - s)), lambda k: piece(s, k))))
    spans = keyed.select("word", F.explode(pieces).alias("p")).select("word", "p.*")
    merges = vocab.merges.select(F.col("token").alias("piece"), "rank", (F.length("left") / 2).cast("int").alias("cut"))
    one_byte = F.col("end") == F.col("start") + 1
    spans = spans.join(_beside(merges, size.n), "piece", "left").where(one_byte | F.col("rank").isNotNull())
    in_order = Window.partitionBy("word").orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    spans = spans.withColumn("segment", F.sum("opens").over(in_order))
    instance = F.struct("rank", "start", (F.col("start") + F.col("cut")).alias("middle"), "end")
    segments = spans.groupBy("word", "segment").agg(
        F.min("start").alias("first"), F.max("end").alias("last"),
        F.array_sort(F.collect_list(F.when(one_byte, F.struct("start", "piece")))).alias("bytes"),
        F.array_sort(F.collect_list(F.when(F.col("rank").isNotNull(), instance))).alias("instances"))
    segments = segments.select("word", "first", "last", F.array_join("bytes.piece", "").alias("hex"),
                               _walked(F.col("hex"), F.col("first"), F.col("last"), F.col("instances")).alias("starts"))
    symbol = F.transform("starts", lambda b, i: F.struct(b.alias("at"), F.substring(
        "hex", (b - F.col("first")) * 2 + 1, (F.coalesce(F.get("starts", i + 1), F.col("last")) - b) * 2).alias("token")))
    symbols = segments.select("word", F.explode(symbol).alias("s")).select("word", "s.*")
    ids = symbols.join(_beside(vocab.tokens, vocab.tokens.count()), "token", "left")
    ids = ids.withColumn("id", F.coalesce("id", F.lit(vocab.unk_id).cast("int")))
    whole = F.array_sort(F.collect_list(F.struct("at", "id")))
    return ids.groupBy("word").agg(F.transform(whole, lambda s: s["id"]).alias("ids"))


class Ranks(NamedTuple):
    """Merges as arrays: ``pairs`` are the sorted keys of the pairs of symbols; an entry is a pair's
    number (high) and one of its ranks (low), and ``made`` the symbol that it makes."""
    pairs: np.ndarray
    entries: np.ndarray
    made: np.ndarray


def numbered_symbols(merges) -> tuple[list[str], Ranks]:
    """Symbols by number (the bytes first) and the merges ``(rank, left, right, token)`` in numbers."""
    numbers = {f"{b:02X}": b for b in range(256)}
    rows = [(rank, *(numbers.setdefault(s, len(numbers)) for s in symbols)) for rank, *symbols in merges]
    rank, left, right, made = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    pairs, number = np.unique(A.pair_keys(left, right), return_inverse=True)
    entries = A.pair_keys(number, rank)
    order = np.argsort(entries)
    return list(numbers), Ranks(pairs, entries[order], made[order])


def merge_words(lengths: np.ndarray, symbols: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, symbols) of the words after all merges, one after the other by rank.  All words
    take a step together, each its own next merge; words without one leave."""
    if not len(ranks.entries):
        return lengths, symbols
    owner, done = A.owners(lengths), np.full(len(lengths), -1, dtype=np.int64)
    symbols, ended, none = symbols.astype(np.int64), [], np.iinfo(np.int64).max
    while len(symbols):
        known, pair = A.found_in(ranks.pairs, A.pair_keys(symbols[:-1], symbols[1:]))
        at = np.flatnonzero(known & (owner[:-1] == owner[1:]))
        # a pair's first rank after the word's last merge
        wanted = A.pair_keys(pair[at], done[owner[at]] + 1)
        entry = np.minimum(np.searchsorted(ranks.entries, wanted), len(ranks.entries) - 1)
        later = (ranks.entries[entry] >= wanted) & (ranks.entries[entry] >> 32 == pair[at])
        at, entry = at[later], entry[later]
        rank, least = ranks.entries[entry] & 0xFFFFFFFF, np.full(len(lengths), none)
        np.minimum.at(least, owner[at], rank)
        now = rank == least[owner[at]]
        places = A.every_other(at[now])
        made = ranks.made[entry[now]][np.searchsorted(at[now], places)]
        symbols, owner = A.merged(symbols, owner, places, made)
        done = np.where(least < none, least, done)
        going = least[owner] < none
        ended.append((owner[~going], symbols[~going]))
        symbols, owner = symbols[going], owner[going]
    if not ended:
        return np.zeros(len(lengths), dtype=np.int64), symbols
    owner, symbols = (np.concatenate(x) for x in zip(*ended))
    return np.bincount(owner, minlength=len(lengths)), symbols[np.argsort(owner, kind="stable")]


def _small(vocab: Vocabulary) -> bool:
    return max(vocab.tokens.count(), vocab.merges.count()) <= BROADCAST_TOKENS


def _coded(df: DataFrame, key: str, pretokens: Column, vocab: Vocabulary, by_place: bool = False) -> DataFrame:
    """``(key, ids)`` of every row by itself; ``by_place``: an array of ids for each pre-token."""
    names, ranks = numbered_symbols([tuple(r) for r in vocab.merges.select("rank", "left", "right", "token").collect()])
    known: dict[str, list] = {}
    for token, number in vocab.tokens.select("token", "id").collect():
        known.setdefault(token, []).append(vocab.unk_id if number is None else number)
    symbol_ids = [sorted(known.get(s, [vocab.unk_id]), key=lambda x: (x is None, x)) for s in names]

    def code(batches):
        ids_of = pa.array(symbol_ids, pa.list_(pa.int32()))
        for part in A.sliced(batches):
            lists = part.column(1)
            rows = A.bounds_of(np.diff(np.asarray(lists.offsets)))
            places = pc.fill_null(lists.flatten(), "").dictionary_encode()
            lengths, symbols = merge_words(*A.byte_strings(places.dictionary), ranks)
            symbols = ids_of.take(pa.array(symbols))
            bounds = np.asarray(symbols.offsets)[A.bounds_of(lengths)]
            words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), symbols.flatten()).take(places.indices)
            if by_place:
                ids = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), words)
            else:
                bounds = np.asarray(words.offsets)[rows]
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.flatten())
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])
    kind = T.ArrayType(T.IntegerType())
    schema = T.StructType([df.schema[key], T.StructField("ids", T.ArrayType(kind) if by_place else kind)])
    words = F.coalesce(pretokens, F.array().cast("array<string>"))
    return df.select(F.col(key), words.alias("words")).mapInArrow(code, schema)


def encode(df: DataFrame, key: str, pretokens: Column, vocab: Vocabulary) -> DataFrame:
    """``(key, ids array<int>)`` of every key; ``pretokens`` is the array of a row's pre-tokens.
    No pre-tokens, or none at all (null): no ids.  Rows of one key (null too) become one row, place
    by place.  The keys alone are counted first: rows of keys that come once stay where they are."""
    if not _small(vocab):
        return _encode_by_table(df, key, pretokens, vocab)
    again = df.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_again")
    again = written(again, "repeated-keys")
    if again.isEmpty():
        return _coded(df, key, pretokens, vocab)
    same = df[key].eqNullSafe(again["_again"])
    once = _coded(df.join(again, same, "left_anti"), key, pretokens, vocab)
    rows = _coded(df.join(again, same, "left_semi"), key, pretokens, vocab, by_place=True)
    places = F.transform("ids", lambda ids, pos: F.struct(pos.alias("pos"), ids.alias("ids")))
    parts = F.array_sort(F.flatten(F.collect_list(places)))
    return once.unionByName(rows.groupBy(key).agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")))


def _encode_by_table(df: DataFrame, key: str, pretokens: Column, vocab: Vocabulary) -> DataFrame:
    """``encode`` with a vocabulary of any size.  The dictionary is written once; places are joined
    with it."""
    places = df.select(F.col(key), F.posexplode_outer(pretokens).alias("pos", "pretoken"))
    words = places.where("pretoken <> ''").select("pretoken").distinct()
    coded = written(encode_words(words, vocab), "word-ids")
    keyed = places.select(key, "pos", word_key(F.col("pretoken")).alias("word"))
    joined = keyed.join(coded, "word", "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("pos", "ids"))))
    return joined.groupBy(key).agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def decode(df: DataFrame, key: str, ids: str, vocab: Vocabulary, one_row_each: bool = False) -> DataFrame:
    """``(key, text)``: the tokens' bytes in order, as UTF-8 (partial characters become U+FFFD);
    ids that the vocabulary doesn't have are left out.  Rows of one key become one row, place by
    place.  ``one_row_each``: no key comes twice (as from ``encode``), so rows stay where they are."""
    text = F.make_valid_utf8(F.unhex("hex").cast("string")).alias("text")
    if one_row_each and _small(vocab):
        return _named(df, key, ids, vocab).select(key, text)
    names = _beside(vocab.tokens, vocab.tokens.count())
    rows = df.select(key, F.posexplode_outer(ids).alias("pos", "id")).join(names, "id", "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("pos", "token"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["token"]), "").alias("hex")).select(key, text)


def _named(df: DataFrame, key: str, ids: str, vocab: Vocabulary) -> DataFrame:
    """``(key, hex)``: the tokens of every row's ids, one after the other."""
    tokens: dict[int, list[str]] = {}
    for token, number in vocab.tokens.where("token is not null and id is not null").select("token", "id").collect():
        tokens.setdefault(number, []).append(token)
    numbers = sorted(tokens)
    names = ["".join(sorted(tokens[number])) for number in numbers] + [""]

    def name(batches):
        known = np.array(numbers, dtype=np.int64)
        for part in A.sliced(batches):
            lists = part.column(1)
            rows = A.bounds_of(np.diff(np.asarray(lists.offsets)))
            wanted = np.asarray(pc.fill_null(lists.flatten().cast(pa.int64()), -1))
            there, at = A.found_in(known, wanted) if len(known) else (np.zeros(len(wanted), dtype=bool), wanted)
            lengths, data = A.byte_strings(pa.array(names).take(pa.array(np.where(there, at, len(known)))))
            bounds = A.bounds_of(lengths)[rows].astype(np.int32)
            hexed = pa.StringArray.from_buffers(len(part), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
            yield pa.RecordBatch.from_arrays([part.column(0), hexed], names=[key, "hex"])
    schema = T.StructType([df.schema[key], T.StructField("hex", T.StringType())])
    return df.select(key, F.coalesce(ids, F.array().cast(df.schema[ids].dataType)).alias("ids")).mapInArrow(name, schema)


def frequent_words(df: DataFrame, words: Column, min_frequency: int = 2, first_id: int = 5) -> DataFrame:
    """A word-level vocabulary ``(word, id)``: words with at least ``min_frequency``
    occurrences, numbered from ``first_id`` by falling frequency (ties: smaller word first)."""
    from pairforge.operators.index import dense_index
    counts = df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    kept = written(counts.where(F.col("n") >= min_frequency), "word-counts")
    return dense_index(kept, [-F.col("n"), "word"], "k").select("word", (F.col("k") + first_id).cast("int").alias("id"))


def lookup_ids(df: DataFrame, key: list[str], words: Column, vocab: DataFrame, unk_id: int) -> DataFrame:
    """``(*key, ids array<int>)`` by a join with the vocabulary ``(word, id)``; words that
    it doesn't have get ``unk_id``."""
    places = df.select(*key, F.posexplode_outer(words).alias("pos", "word"))
    found = places.join(vocab, "word", "left")
    entry = F.struct("pos", F.coalesce("id", F.lit(unk_id)).alias("id"))
    parts = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), entry)))
    return found.groupBy(*key).agg(F.transform(parts, lambda p: p["id"]).alias("ids"))
