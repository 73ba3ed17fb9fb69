"""CRC matrices against zlib, importance scores and draws against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from pairforge.llm import importance as I

SCHEMA = "doc_id bigint, text string, score string, rank int, bucket string"
RX = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, target, buckets=10000, max_n=1, seed=2024, min_words=20, percent=10):
    def features(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = RX.findall(lowered)
        return len(words), [" ".join(words[k:k + n]) for n in range(1, max_n + 1) for k in range(len(words) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    docs = [(d, t) for d, t in docs if d is not None]
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in features(text)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text)[1]:
            t[bucket(f)] += 1
    S, T = float(sum(s) + buckets), float(sum(t) + buckets)
    gain = [math.floor(1000 * math.log((b + 1.0) * S / ((a + 1.0) * T))) for a, b in zip(s, t)]
    rows = []
    for d, text in docs:
        n, fs = features(text)
        h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        rows.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    pool = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0], r[3], r[2]))
    for k, r in enumerate(pool[:percent * len(pool) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def test_crc_rows_equal_zlib():
    rng = np.random.default_rng(1)
    words = [b"", b"a", b"abc", "größe".encode(), b"z" * 511, b"z" * 512, b"z" * 513]
    words += [rng.bytes(int(n)) for n in rng.integers(0, 60, 500)] + [rng.bytes(int(n)) for n in (514, 768, 1024, 70_001, 70_001)]
    assert I.crc32_rows(words).tolist() == [zlib.crc32(w) for w in words]
    assert I.crc32_rows([]).tolist() == []


def _result(spark, docs, target, **options):
    frame = spark.createDataFrame([(d, t, "s", 1, "b") for d, t in docs], SCHEMA).repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in I.importance(frame, goal, **options).collect()), key=repr)


@pytest.mark.parametrize("max_n", [1, 2])
def test_equals_plain_python(spark, monkeypatch, max_n):
    monkeypatch.setattr(I, "SLICE_BYTES", 200)
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(60)] + ["Größe", "ÉTÉ", "İx", "a-b", "x y", " z"]
    docs = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(0, 60))))) for k in range(200)]
    docs += [(500, None), (501, ""), (502, "!!! ???"), (503, "word " * 30_000), (504, "x" * 100_000),
             (None, "no id"), (3, docs[3][1]), (3, docs[3][1]), (-7, docs[5][1])]
    target = [" ".join(rng.choice(vocabulary[:10], 40)), None, ""]
    got = _result(spark, docs, target, buckets=97, max_n=max_n, percent=30)
    want = plain(docs, target, buckets=97, max_n=max_n, percent=30)
    ties = [r for r in want if r[0] == 3]  # copies of one row share its scores; their order is free
    assert [r for r in got if r[0] != 3] == [r for r in want if r[0] != 3]
    assert sorted(r[:5] for r in got if r[0] == 3) == sorted(r[:5] for r in ties)
    assert sorted(str(r[5]) for r in got if r[0] == 3) == sorted(str(r[5]) for r in ties)


def test_empty_tables(spark):
    assert _result(spark, [], ["some target"]) == []
    docs = [(k, "alpha beta " * 15) for k in range(10)]
    got = _result(spark, docs, [])
    assert got == plain(docs, []) and sum(r[5] is not None for r in got) == 1
