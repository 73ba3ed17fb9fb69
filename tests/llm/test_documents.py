"""Operators on documents against brute force, on hard small tables."""

import hashlib
import math
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pairforge.llm import common, decontamination, language_id, licences, near_dedup, packing, phrase_dedup, quality
from pairforge.llm import suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, keys string, id string, hub string"


def hard_rows():
    rnd = random.Random(7)
    vocab = ["".join(rnd.choice("abcdefgéß") for _ in range(rnd.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    base, passage = prose(180), prose(70)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, "One TWO"), (7, base), (8, base)]
    for k in range(9, 60):  # near copies around the threshold
        words = base.split()
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words)))
    rows += [(k, prose(60) + " " + passage + "\n" + prose(30)) for k in range(60, 90)]
    rows += [(90, "same " * 3000), (91, "same " * 2000), (92, prose(30_000)), (93, "x" * 20_000), (94, "x" * 15_000)]
    rows += [(k, prose(rnd.randint(1, 120))) for k in range(95, 130)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return hard_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns with clashing names, and one row without an id
    data = [(i, t, "xx" if i % 3 else None, "s", 1, "k", "i", "h") for i, t in rows] + [(None, "no id", "xx", "s", 1, "", "", "")]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates(rows)


def test_near_duplicates_of_a_template_family(spark):
    rnd = random.Random(11)
    base = [f"t{i}" for i in range(100)]
    family = []
    for k in range(150):  # own words in the last part: 0.7 alike, and every tenth has a near copy
        words = base + [f"w{k}x{i}" for i in range(18)]
        family.append((k, " ".join(words)))
        if k % 10 == 0:
            words[rnd.randrange(100)] = "other"
            family.append((1000 + k, " ".join(words)))
    frame = spark.createDataFrame(family, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame).collect()}
    assert got == brute.near_duplicates(family)


def test_near_duplicates_kept(docs):
    assert all(r.kept == (r.doc_id == r.component_id) for r in near_dedup.near_duplicates(docs).collect())


def test_odd_sketch_estimates_difference():
    rnd = np.random.default_rng(3)
    a = rnd.integers(1, 2**63, 400).astype(np.uint64)
    b = a.copy()
    b[:30] = rnd.integers(1, 2**63, 30).astype(np.uint64)  # similarity 370 / 430
    many = common.odd_multipliers(near_dedup.SKETCH_SAMPLES, 9)
    x, y = (near_dedup.odd_sketch(near_dedup.minhash(np.unique(s), many)) for s in (a, b))
    differ = sum(int(v).bit_count() for v in x ^ y)
    assert 0 < differ <= near_dedup.popcount_limit(0.85)
    other = near_dedup.odd_sketch(near_dedup.minhash(np.unique(rnd.integers(1, 2**63, 400).astype(np.uint64)), many))
    assert sum(int(v).bit_count() for v in x ^ other) > near_dedup.popcount_limit(0.85)


def test_repeated_words(docs, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrase_dedup.repeated_words(docs).collect()}
    assert got == brute.repeated_words(rows)


def test_repeated_words_small_shards(docs, rows, monkeypatch):
    shard = phrase_dedup._Shard()
    for doc_id, text in rows:
        shard.add(doc_id, (text or "").encode(), np.empty(0, dtype=np.uint64))
    assert list(shard.located(50, 10)) == []


def test_repeated_bytes(docs, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.repeated_bytes(docs).collect()}
    assert got == brute.repeated_bytes(rows)


def test_repeated_bytes_of_a_hot_seed(spark):
    rnd = random.Random(21)
    noise = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    phrase, passages = noise(24), [noise(40) for _ in range(4)]
    rows = [(k, noise(60) + phrase + noise(60)) for k in range(150)]
    rows += [(k, noise(30) + passages[k % 4] + phrase + passages[k // 4 % 4][:rnd.randint(5, 40)] + noise(30))
             for k in range(150, 260)]
    rows += [(k, "-" * rnd.randint(40, 900) + noise(5)) for k in range(260, 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.repeated_bytes(docs, shard_bytes=1500).collect()}
    assert got == brute.repeated_bytes(rows)
    segments = next(suffix_dedup._segmenter(50, 20)([pa.RecordBatch.from_pydict(
        {"doc_id": [i for i, _ in rows], "text": [x for _, x in rows],
         "keys": [np.unique(suffix_dedup._window_seeds(x.encode(), 50, 20)).view(np.int64).tolist()
                  for _, x in rows]})]))
    segments = spark.createDataFrame(pa.Table.from_batches([segments])).where("size IS NOT NULL").drop("start")
    held = lambda t: t.selectExpr("seed", "length(segment) as n").groupBy("seed").sum("n").agg({"sum(n)": "max"}).first()[0]
    parts, cuts = suffix_dedup.bounded_parts(segments, 50, 20, 1500)
    assert held(segments) > 10_000 and held(parts) <= 1500 and cuts


def test_suffix_blocks_hold_whole_seeds():
    seeds, sizes = np.array([1, 1, 2, 3, 3, 3, 4]), np.array([60, 60, 50, 90, 90, 90, 50])
    assert suffix_dedup.blocks(seeds, sizes, 200) == [(0, 3), (3, 6), (6, 7)]


def test_window_groups_match_prefixes():
    rnd = random.Random(2)
    data = "".join(rnd.choice("ab") for _ in range(300)).encode() * 3
    order, new = suffix_dedup.window_groups(data, 50)
    group = np.empty(len(data), dtype=int)
    group[order] = np.cumsum(new)
    whole = range(len(data) - 49)
    seen = {}
    for i in whole:
        assert seen.setdefault(data[i:i + 50], group[i]) == group[i]
    assert len(set(seen.values())) == len(seen)


def _calls(work) -> int:
    """Function calls, Python's and built-in ones, that the work makes."""
    made = [0]

    def count(frame, event, arg):
        made[0] += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        work()
    finally:
        sys.setprofile(None)
    return made[0]


def _parts(rnd, n):
    """Segments of n texts under a few seeds, and their table."""
    bodies = ["".join(rnd.choice("ab") for _ in range(rnd.randint(50, 58))) + "x" * 50 for _ in range(n)]
    rows = [(k % n % 5, k % n, rnd.randint(0, 9), len(x), x.encode()) for k, x in enumerate(bodies + bodies[:n // 4])]
    return pa.table({c: pa.array([r[k] for r in rows], pa.binary() if c == "segment" else pa.int64())
                     for k, c in enumerate(["seed", "mark", "doc_id", "size", "segment"])})


def test_shard_plans_hold_each_windows_smallest_id():
    table = _parts(random.Random(3), 200)
    rows = table.to_pylist()
    low = {}
    for r in rows:
        for a in range(r["size"] - 49):
            key = r["seed"], r["segment"][a:a + 50]
            low[key] = min(low.get(key, 99), r["doc_id"])
    # small blocks hold one seed each: ids of other seeds' windows stay out of them
    for r in suffix_dedup._sharder(50, 10)(table).to_pylist():
        body = next(x["segment"] for x in rows if (x["seed"], x["mark"]) == (r["seed"], r["mark"]))
        each = [i for n, i in zip(r["plan"][::2], r["plan"][1::2]) for _ in range(n)]
        assert each == [low[r["seed"], body[a:a + 50]] for a in range(len(body) - 49)]
        assert r["low"] == min(each) and all(a != b for a, b in zip(r["plan"][1::2], r["plan"][3::2]))


def test_shard_work_is_not_done_per_segment():
    few, many = (_parts(random.Random(4), n) for n in (200, 4000))
    shard = suffix_dedup._sharder(50, 10_000_000)
    shard(few)
    assert _calls(lambda: shard(many)) < 1.5 * _calls(lambda: shard(few))


def test_cutter_removes_covered_bytes():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abä") for _ in range(rnd.randint(0, 300))) for _ in range(40)]
    ids, found = [k * 3 for k in range(40)], []
    for text in texts:
        room, lists = len(text.encode()) - 49, []
        for _ in range(rnd.randint(0, 4) if room > 0 else 0):
            at = rnd.randrange(room)
            lists.append([at, *(x for n in (1, rnd.randint(1, 9)) if at + 10 <= room for x in (n, rnd.randint(0, 120)))])
        found.append([x for x in lists if len(x) > 1])
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts), pa.array(found, pa.list_(pa.list_(pa.int64())))],
                                       names=["doc_id", "text", "found"])
    got = [r for part in suffix_dedup._cutter(50)([batch.slice(0, 17), batch.slice(17)]) for r in part.to_pylist()]
    for doc_id, text, lists, r in zip(ids, texts, found, got, strict=True):
        data, gone = text.encode(), set()
        for at, *runs in lists:
            for n, owner in zip(runs[::2], runs[1::2]):
                gone |= set(range(at, at + n + 49)) if owner < doc_id else set()
                at += n
        edges = [k for k in range(len(data) + 1) if (k in gone) != (k - 1 in gone)]
        kept = bytes(x for k, x in enumerate(data) if k not in gone)
        assert r == {"doc_id": doc_id, "n_removed": len(gone), "spans": edges,
                     "kept_sha256": hashlib.sha256(kept).hexdigest()}
    assert any(r["spans"] for r in got) and any(not r["spans"] for r in got)


def test_empty_tables(spark, empty):
    assert near_dedup.near_duplicates(empty).count() == 0
    assert phrase_dedup.repeated_words(empty).count() == 0
    assert suffix_dedup.repeated_bytes(empty).count() == 0
    assert packing.pack(empty).count() == 0
    assert language_id.identify(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.judge(empty, labels).count() == 0
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(empty, items).count() == 0
    files = empty.selectExpr("doc_id", "source as path", "text")
    assert licences.scan_licences(files).count() == 0


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    size = 256
    got = packing.pack(docs, sequence=size).collect()
    expected = set()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        start, stop, piece = 0, (len(ids) - 1) % size + 1, 0
        while start < len(ids):
            crc = zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())
            expected.add((doc_id, piece, start, stop - start, crc))
            start, stop, piece = stop, stop + size, piece + 1
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == expected
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= size
    assert len(filled) <= -(-sum(filled.values()) // size) + 2


def test_best_two_fit_repeats_what_one_by_one_does():
    rnd = random.Random(4)

    def one_by_one(pieces, size):
        left, bins = sorted(pieces, reverse=True), []
        while left:
            own, gap = [], size
            for p in list(left):
                if p <= gap:
                    own.append(p)
                    left.remove(p)
                    gap -= p
            if len(own) > 1 and gap:
                room = gap + own[-1]
                best = max(((a + b, a, b) for i, a in enumerate(left) for b in left[i + 1:] if a + b <= room),
                           default=(0, 0, 0))
                if best[0] > own[-1]:
                    left.append(own.pop())
                    own += best[1:]
                    for p in best[1:]:
                        left.remove(p)
                    left.sort(reverse=True)
            bins.append(tuple(sorted(own)))
        return sorted(bins)

    for _ in range(30):
        pieces = [rnd.randint(1, 40) for _ in range(rnd.randint(1, 120))]
        counts = {}
        for p in pieces:
            counts[p] = counts.get(p, 0) + 1
        plan = packing.best_two_fit(counts, 50)
        bins = [tuple(sorted(length for length, c in parts for _ in range(c))) for times, parts in plan
                for _ in range(times)]
        assert sorted(bins) == one_by_one(pieces, 50)


def test_chunk_encoder_is_the_tokenizer():
    rnd = random.Random(1)
    encoder = packing.ChunkEncoder(packing.TOKENIZER)
    texts = ["".join(rnd.choice("ab'st \n\t \x1c9.éÉ ,ſ") for _ in range(40)) for _ in range(2000)]
    texts += ["a<|endoftext|> b", "", " ", "don't  'll", "x.\ny"]
    whole = [e.ids for e in encoder._tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == whole


def test_language_of_held_out(spark):
    rnd = random.Random(5)
    sounds = {"aa": ["ba", "no", "ti"], "bb": ["xe", "qu", "oz"]}
    data = [(i, " ".join("".join(rnd.choices(sounds[k], k=3)) for _ in range(30)), k)
            for i in range(200) for k in [rnd.choice(["aa", "bb"])]]
    data += [(1000, None, "aa"), (1001, "123 !?", "bb"), (1002, "", None)]
    got = {r.doc_id: r for r in language_id.identify(
        spark.createDataFrame(data, "doc_id bigint, text string, lang string")).collect()}
    assert len(got) == len(data)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in data)
    assert all(got[i].lang_pred == k for i, _, k in data[:200])
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_without_labels(spark):
    rows = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in language_id.identify(rows).collect()] == ["und"]


def _base(text):
    import re
    from collections import Counter
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    trios = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(trios)
    cover = {k for i, t in enumerate(trios) if counts[t] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(cover), len(words) < 50 or 100 * len(cover) > 50 * len(words))


def test_quality_base_rules(docs, rows):
    more = {i: t for i, t in rows}
    got = {r.doc_id: tuple(r)[1:] for r in quality.base_rules(docs).collect()}
    assert got == {i: _base(t) for i, t in more.items()}


def test_quality_prefers_trusted_words(spark):
    good, bad = [f"w{i}" for i in range(200)], [f"junk{i}!!" for i in range(200)]
    data = [(i, " ".join((good if i < 80 else bad)[i:i + 100])) for i in range(100)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 2)] + [(99, 0, 0), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    assert kept == set(range(80))


def _edited(item, edits, rnd):
    chars = list(item)
    for _ in range(edits):
        at = rnd.randrange(len(chars))
        kind = rnd.random()
        if kind < 0.4:
            chars[at] = "#"
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, "#")
    return "".join(chars)


def _edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_contamination_against_alignment(spark):
    rnd = random.Random(8)
    words = ["the", "of", "thing", "reon", "ation", "and", "wher", "eaned", "sti"]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    items = [(i, prose(25)) for i in range(6)] + [(6, None), (7, " "), (8, "Tiny one"), (None, "no id")]
    docs = [(100, None), (101, "")]
    for k in range(40):
        item = items[k % 6][1]
        docs.append((k, prose(30) + " " + _edited(item, rnd.choice([0, 3, 8, 12, 18, 30]), rnd).upper() + "\n\n" + prose(20)))
    docs.append((50, prose(5) + " tiny one " + prose(5)))
    found = {(r.doc_id, r.item_id): r for r in decontamination.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    clean = lambda t: " ".join((t or "").lower().split())
    for doc_id, text in docs:
        for item_id, item in items:
            if item_id is not None and clean(item):
                size = len(clean(item))
                edits = _edit_distance_inside(clean(item), clean(text))
                assert ((doc_id, item_id) in found) == (edits <= size // 10), (doc_id, item_id, edits, size)
                if (doc_id, item_id) in found:
                    assert found[doc_id, item_id].edits >= edits


def test_contamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 60)
    items = [(i, f"item number {i} has a text of its own kind {i * 37}") for i in range(8)]
    docs = [(i, "before " + t + " after") for i, t in items]
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                        spark.createDataFrame(items, "item_id bigint, text string")).where("edits = 0")
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i, _ in items}


def test_least_edits_by_table():
    rnd = random.Random(12)
    for _ in range(300):
        item = decontamination.normal("".join(rnd.choices("ab ", k=rnd.randint(1, 90))) + "x")
        text = decontamination.normal("".join(rnd.choices("abx ", k=rnd.randint(0, 60))))
        row = [0] * (len(text) + 1)
        for i, code in enumerate(item.tolist()):
            new = [i + 1]
            for j, other in enumerate(text.tolist()):
                new.append(min(row[j] + (code != other), row[j + 1] + 1, new[j] + 1))
            row = new
        assert decontamination.least_edits(item, text) == min(row)


def test_items_with_one_stem_are_not_all_aligned(spark, monkeypatch):
    """Documents that hold only the stem are turned away before any alignment, in blocks of few hits too."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 9))) for _ in range(500)]
    stem = "which of the following statements is true about"
    items = [(i, stem + " " + " ".join(rnd.choices(words, k=14))) for i in range(60)]
    texts = ["x " + stem + " " + " ".join(rnd.choices(words, k=9)) for _ in range(80)]
    quoted = list(items[7][1])
    quoted[60] = "#"
    texts += ["before " + items[3][1] + " after", "".join(quoted), items[9][1][:80], ""]
    aligned = []
    real = decontamination.banded_edits
    monkeypatch.setattr(decontamination, "banded_edits", lambda *a: aligned.append(1) or real(*a))
    for hits in (decontamination.HITS, 500):
        monkeypatch.setattr(decontamination, "HITS", hits)
        index = decontamination.ItemIndex(items, 0.1, 8)
        got = decontamination._matches(index, list(range(len(texts))), [decontamination.normal(t) for t in texts])
        assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == {(80, 3, 0), (81, 7, 1)}
    assert len(aligned) <= 4


def test_licences(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.txt", "plain text"),
        (3, "a/b/LICENSE.md", "intro\nLicensed under the Apache License, Version 2.0."), (4, "a/y.txt", None),
        (5, "z/q.txt", "no licence here"), (6, "a/own.txt", "x\nAll rights reserved.\ny"), (7, None, "text"),
        (8, "ab/x.txt", "text")], "doc_id bigint, path string, text string")
    got = {r.doc_id: (r.own_licence, r.licence, r.licence_folder) for r in licences.scan_licences(files).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "Apache-2.0", "a/b"), 3: ("Apache-2.0", "Apache-2.0", None),
                   4: (None, "MIT", "a"), 5: (None, None, None), 6: ("Proprietary", "Proprietary", None),
                   7: (None, None, None), 8: (None, None, None)}


def _weights(**counts):
    known = {w: 2 for t in licences.all_templates().values() for x in t for w in licences.terms(x)}
    return licences.Weights(1000, known | {k.encode(): n for k, n in counts.items()},
                            np.zeros(licences.BUCKETS, dtype=np.int64))


def _cosine(weights, unit, template):
    def vector(words):
        idf = dict(zip(words, weights.of(words).tolist(), strict=True))
        counts = {w: words.count(w) * idf[w] for w in words}
        norm = sum(x * x for x in counts.values()) ** 0.5
        return {w: x / norm for w, x in counts.items()}
    one, other = vector(unit), vector(template)
    return sum(x * other.get(w, 0.0) for w, x in one.items())


def test_licence_units_against_all_cosines():
    """Bounds lose nothing: every run, header and file against every template, one by one."""
    texts = {k: [t for t in v if len(t) < 80] for k, v in licences.all_templates().items()}
    weights = _weights(the=900, under=300, license=40)
    matcher = licences.LicenceMatcher(texts, weights, 0.8)
    pool = sorted({w.decode() for v in texts.values() for t in v for w in licences.terms(t)}) + ["other", "word", "\n\n"]
    some = [t for v in texts.values() for t in v]
    rnd, hits = random.Random(9), 0
    for k in range(250):
        text = " ".join(rnd.choices(pool, k=rnd.randint(0, 14)))
        if k % 2:
            words = rnd.choice(some).split()
            words[rnd.randrange(len(words))] = rnd.choice(pool)
            text += "\n" * rnd.randint(0, 2) + " ".join(words)
        words = licences.terms(text)
        units = [(licences.terms(block), name, t) for block in [text] for name, v in texts.items() for t in v]
        head = []
        for i, line in enumerate(text.split("\n")):
            if i and head and not licences.terms(line):
                break
            head += licences.terms(line)
        best = 0.0
        for _, name, t in units:
            template = licences.terms(t)
            runs = [words[s:s + len(template)] for s in range(max(1, len(words) - len(template) + 1))]
            best = max([best] + [_cosine(weights, u, template) for u in [*runs, head, words] if u])
        got = matcher.best(text.encode(), True)
        assert (got[0] is not None) == (best >= 0.8 - 1e-12)
        if got[0]:
            assert got[1] == pytest.approx(best, abs=1e-8) or got[0] == "Proprietary" or best == pytest.approx(
                max(_cosine(weights, u, licences.terms("All rights reserved.")) for u in
                    [words[s:s + 3] for s in range(len(words))] + [words, head]))
            hits += 1
    assert hits > 60


def test_real_licence_texts(spark):
    every = licences.all_templates()
    notice = next(t for t in every["Apache-2.0"] if t.startswith("Licensed under the Apache License, Version"))
    wrapped = "\n".join("# " + " ".join(notice.split()[i:i + 6]) for i in range(0, len(notice.split()), 6))
    gpl = next(t for t in every["GPL-3.0"] if t.startswith("This program"))
    mit = next(t for t in every["MIT"] if t.startswith("Permission is"))
    bsd = {k: next(t for t in every[k] if t.startswith("Redistribution")) for k in ("BSD-2-Clause", "BSD-3-Clause")}
    rows = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit),
        ("MIT", "prose " * 30000 + "\n" + mit + "\n" + "prose " * 300),
        ("MIT", "Released under the MIT License. See the file."), ("MIT", "// SPDX-License-Identifier: MIT\nint x;"),
        ("Apache-2.0", "#!/bin/sh\n" + wrapped + "\n\nimport os\n"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
        ("GPL-3.0", "/*\n * " + gpl.replace(", ", ",\n * ") + "\n */\nint main() {}"),
        ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright"),
        ("GPL-2.0", "licensed under the GNU\n-- General Public License, version 2, and nothing else"),
        ("LGPL-2.1", gpl.replace("program", "library").replace("GNU ", "GNU Lesser ").replace("version 3", "version 2.1")),
        ("BSD-3-Clause", "Copyright 1999, A B. All rights reserved.\n\n" + bsd["BSD-3-Clause"].replace(
            "the copyright holder nor", "Acme Corporation nor")),
        ("BSD-2-Clause", "Copyright 1999, A B. All rights reserved.\n\n" + bsd["BSD-2-Clause"]),
        ("MPL-2.0", "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of "
                    "the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"),
        ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
        ("CC-BY-SA-4.0", "This is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        ("Proprietary", "Copyright 2001. All rights\nreserved."), (None, "the terms of the school and its public rights"),
        (None, "SPDX-License-Identifier: EUPL-1.2"), (None, "licensed under the GNU General Public License, version 1"),
        (None, ""), (None, None)]
    files = spark.createDataFrame([(i, f"d{i}/f.txt", t, "x") for i, (_, t) in enumerate(rows)]
                                  + [(100 + i, f"e/{i}", "plain words of a text", "x") for i in range(200)]
                                  + [(3, "d3/f.txt", rows[3][1], "x")],  # a repeated row keeps its own result row
                                  "doc_id bigint, path string, text string, score string")
    got = licences.scan_licences(files).collect()
    assert len(got) == len(rows) + 201
    found = {r.doc_id: (r.own_licence, r.line) for r in got}
    assert {i: found[i][0] for i in range(len(rows))} == {i: name for i, (name, _) in enumerate(rows)}
    assert found[0][1] == 4 and found[1][1] == 1 and found[4][1] in (0, 1)
    assert all(found[100 + i][0] is None for i in range(200))


def test_licence_weights_count_all_texts(spark):
    rows = [(i, "p", f"License word{i % 3} common LICENSE") for i in range(30)] + [(99, "p", None)]
    files = spark.createDataFrame(rows, "doc_id bigint, path string, text string").repartition(5)
    weights = licences.document_frequencies(files, {"X": ["the license"]})
    expected = [math.log(32 / 31) + 1, math.log(32) + 1, math.log(32 / 31) + 1, math.log(32 / 11) + 1]
    assert weights.of([b"license", b"the", b"common", b"word1"]) == pytest.approx(expected)


def test_bytes_are_scanned_in_bounded_slices():
    texts = [f"{k} " * 3000 for k in range(1000, 2500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    parts = list(suffix_dedup._scan(iter([batch])))
    assert len(parts) > 2 and max(p.num_rows for p in parts) * 15_000 < 2 * common.SLICE_BYTES
    assert [i for p in parts for i in p.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert [n for p in parts for n in p.column("n_bytes").to_pylist()] == [len(t) for t in texts]
    assert list(suffix_dedup._scan(iter([batch.slice(0, 0)]))) == []


def test_flagged_keys_made_by_the_packing_worker(spark):
    from pairforge.llm.flags import flagged_keys
    sets = spark.createDataFrame([(1, [5, 6]), (2, [6, 7]), (3, [8]), (4, [7, 9])], "doc_id bigint, keys array<bigint>")

    def given(batches):
        yield from batches
    for later in (False, True):
        plain, made = (flagged_keys(sets, 7, later, **how) for how in ({}, {"made": given}))
        assert {r.doc_id: sorted(r["keys"]) for r in plain.collect()} == {r.doc_id: sorted(r["keys"]) for r in made.collect()}
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1
