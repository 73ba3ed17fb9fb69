"""Plain Python versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
from collections import defaultdict


def near_duplicates(rows, threshold=85, shingle=5):
    """rows: (doc_id, text) -> {doc_id: (n_shingles, component_id)}"""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        size = min(shingle, len(words))
        sets[doc_id] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()
    holders = defaultdict(list)
    for doc_id, found in sets.items():
        for s in found:
            holders[s].append(doc_id)
    common = defaultdict(int)
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                common[a, b] += 1
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def _first_docs(rows, units, length):
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        seq = units(text)
        for i in range(len(seq) - length + 1):
            first.setdefault(tuple(seq[i:i + length]) if isinstance(seq, list) else seq[i:i + length], doc_id)
    return first


def _gone(doc_id, seq, first, length):
    gone = [False] * len(seq)
    until = 0
    for i in range(len(seq) - length + 1):
        key = tuple(seq[i:i + length]) if isinstance(seq, list) else seq[i:i + length]
        if first[key] < doc_id:
            for k in range(max(i, until), i + length):
                gone[k] = True
            until = i + length
    return gone


def repeated_words(rows, window=50):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    units = lambda text: (text or "").encode().split()
    first = _first_docs(rows, units, window)
    out = {}
    for doc_id, text in rows:
        words = units(text)
        gone = _gone(doc_id, words, first, window)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def repeated_bytes(rows, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    units = lambda text: (text or "").encode()
    first = _first_docs(rows, units, length)
    out = {}
    for doc_id, text in rows:
        data = units(text)
        gone = _gone(doc_id, data, first, length)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
