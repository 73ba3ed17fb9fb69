"""Fingerprints, edited texts and likeness against plain Python; search against all pairs."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from pairforge.llm import spot_signatures as S

SCHEMA = "doc_id bigint, text string, part string, visitor string, n int"
RX = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return RX.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def anchors_of(texts, limit=S.ANCHORS):
    seen = Counter(w for t in texts for w in set(words(t)))
    def order(w):
        h = xxhash.xxh3_64_intdigest(w.encode())
        return -seen[w], h - (1 << 64) * (h >> 63)
    top = sorted(seen, key=order)[:min(limit, len(seen) // 8)]
    return set(top)


def signatures(text, anchors):
    """The signatures as tuples of words, by the definition."""
    ws = words(text)
    if not ws:
        return {(text,)} if text else set()
    out, last = set(), None
    for i, w in enumerate(ws):
        if i == 0 or w in anchors or i - last == S.GAP:
            last = i
            chain = [v for v in ws[i + 1:] if v not in anchors][:S.CHAIN]
            out.add((w if w in anchors else None, *chain))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def plain(rows):
    rows = sorted(((d, t or "") for d, t in rows if d is not None))
    anchors = anchors_of([t for _, t in rows])
    out = []
    for k, (d, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        own, other, nxt = (signatures(x, anchors) for x in (t, e, following))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), round(jaccard(own, other), 9),
                    round(jaccard(own, nxt), 9), len(own)))
    return sorted(out)


def _texts(rng, n):
    vocabulary = ["the", "of", "and", "är"] * 40 + [f"w{k}" for k in range(300)] + ["Ünï", "日本語", "A-b"]
    return [" ".join(rng.choice(vocabulary, int(rng.integers(0, 120)))) for _ in range(n)]


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, "p", "v", 1) for d, t in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("per_range", [1, 5, 1000])
def test_equals_plain_python(spark, monkeypatch, per_range):
    monkeypatch.setattr(S, "PER_RANGE", per_range)
    rng = np.random.default_rng(4)
    texts = _texts(rng, 150)
    rows = [(7 * k - 200, t) for k, t in enumerate(texts)]
    rows += [(2000, None), (2001, ""), (2002, "!!! ???"), (2003, "!!! ???"), (2004, texts[3]), (2005, texts[3]),
             (2006, "only"), (2007, "x " * 40_000), (2008, "nothing common here " * 3 + " ".join(f"u{k}" for k in range(200))),
             (None, "no id"), (2009, "y" * 50_000)]
    got = S.fingerprints(_frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9), r.n_spots)
                  for r in got) == plain(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2004].fingerprint == by_id[2005].fingerprint and by_id[2004].near_next == 1
    assert by_id[2000].fingerprint == "" and by_id[2000].near_next == 1
    for r in got:
        assert len(r.fingerprint) == 8 * r.n_spots
        own, other = S.from_string(r.fingerprint), S.from_string(r.edited_fingerprint)
        assert S.pruned_jaccard(own, other) == r.near_edited


def test_repeated_ids_one_row_and_none(spark):
    assert S.fingerprints(_frame(spark, [])).collect() == []
    assert S.fingerprints(_frame(spark, [(None, "x")])).collect() == []
    one = S.fingerprints(_frame(spark, [(5, "abcdef")], 1)).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(5, hashlib.sha256(b"abcabc").hexdigest())]
    rows = [(1, "a b c"), (1, "a b c"), (1, "a b c"), (2, "d e f")]
    got = S.fingerprints(_frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 1, 2] and sorted(r.near_next for r in got) == [0, 0, 1, 1]


def test_pruning_loses_nothing():
    rng = np.random.default_rng(6)
    for _ in range(300):
        pool = rng.integers(0, 400, 200).astype(np.uint32)
        a, b = np.unique(rng.choice(pool, 120)), np.unique(np.concatenate([rng.choice(pool, 90)]))
        want = jaccard(set(a.tolist()), set(b.tolist()))
        for least in (0.0, 0.2, 0.35, 0.5):
            assert S.pruned_jaccard(a, b, least) == (want if want >= least else 0.0)
    for threshold in (0.5, 0.8, 0.93):
        classes = [S.length_partition(n, threshold) for n in range(1, 500)]
        for n in range(1, 500):  # lengths that can be like each other lie in neighbouring partitions
            assert abs(classes[int(n * threshold + 0.999999) - 1] - classes[n - 1]) <= 1


def test_search_equals_all_pairs(spark):
    rng = np.random.default_rng(9)
    texts = [t for t in _texts(rng, 60) if t]
    rows = [(k, t) for k, t in enumerate(texts)]
    for k, t in enumerate(texts[:30]):  # near copies of several degrees
        ws = t.split()
        for j in range(int(rng.integers(0, 4))):
            if ws:
                ws[int(rng.integers(len(ws)))] = f"changed{j}"
        rows.append((1000 + k, " ".join(ws)))
    rows += [(3000, None), (3001, "")]
    anchors = anchors_of([t for _, t in rows])
    sets = {d: signatures(t, anchors) for d, t in rows}
    queries = [r for r in rows if r[0] % 2 == 0]
    want = {(q, d) for q, _ in queries for d in sets if q != d and sets[q] and sets[d] and jaccard(sets[q], sets[d]) >= 0.8}
    got = S.search(_frame(spark, rows), _frame(spark, queries), 0.8).collect()
    assert {(r.query_id, r.doc_id) for r in got} == want and len(got) == len(want) and len(want) > 15
