"""The corpus pipeline against its stages in plain Python."""

import os
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pairforge.llm import packing
from tests.llm import brute
from tests.llm.test_documents import _edit_distance_inside

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keys string, spans string, _id bigint"
ITEMS = "item_id bigint, text string, doc_id bigint"


def sample():
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdefgéß") for _ in range(rnd.randint(2, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, prose(18)) for i in range(3)]
    passage, base = prose(60), prose(120)
    rows = [(1, None), (2, ""), (3, " 12 !?\n"), (4, "One two"), (5, "one TWO"), (6, base), (7, base), (8, base + " more")]
    rows += [(k, prose(15) + "\n" + passage + "\t" + prose(12)) for k in range(10, 16)]
    rows += [(20, passage), (21, passage + " tail")]
    rows += [(30 + i, prose(20) + " " + t.replace("a", "A") + "  " + prose(9)) for i, t in items]
    rows += [(33, prose(25) + " " + items[0][1].replace(" ", "  ", 4)[:-4] + " " + prose(5))]
    rows += [(34, prose(25) + " " + items[1][1][:len(items[1][1]) // 2] + " " + prose(5))]
    rows += [(k, prose(rnd.randint(1, 60))) for k in range(40, 70)] + [(90, prose(4000))]
    return rows, items


def expected(rows, items, size=2048):
    from tokenizers import Tokenizer
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    found = brute.near_duplicates(rows)
    rows = [(i, t) for i, t in rows if found[i][1] == i]
    units = lambda text: text.encode().split()
    first, cut = brute._first_docs(rows, units, 50), []
    for i, t in rows:
        gone = brute._gone(i, units(t), first, 50)
        if any(gone):
            t = b" ".join(w for w, g in zip(units(t), gone, strict=True) if not g).decode()
        if not all(gone):
            cut.append((i, t))
    clean = lambda t: " ".join(t.lower().split())
    # the one very long text holds no item: its vocabulary is drawn at random
    rows = [(i, t) for i, t in cut if len(t) > 5000 or not any(
        _edit_distance_inside(clean(x), clean(t)) <= len(clean(x)) // 10 for _, x in items)]
    tokenizer, pieces = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER)), set()
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        start, stop, piece = 0, (len(ids) - 1) % size + 1, 0
        while start < len(ids):
            pieces.add((i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
            start, stop, piece = stop, stop + size, piece + 1
    return pieces


def tables(spark, folder, rows, items):
    data = [(i, t, "xx" if i % 3 else None, "s", len(t or ""), "k", "s", i) for i, t in rows]
    if rows:
        data += [data[-1], (None, "no id", "xx", "s", 1, "", "", None)]  # a repeated row, and one without an id
    spark.createDataFrame(data, DOCS).repartition(4).write.parquet(os.path.join(folder, "documents.parquet"))
    more = [(i, t, 6) for i, t in items] + ([(8, None, 6), (9, " ", 6), (None, "no id", 6)] if items else [])
    spark.createDataFrame(more, ITEMS).write.parquet(os.path.join(folder, "benchmark.parquet"))
    return folder


def test_pipeline_against_plain_stages(spark, tmp_path):
    rows, items = sample()
    got = corpus_pipeline.run(spark, tables(spark, str(tmp_path), rows, items)).collect()
    want = expected(rows, items)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    kept = {w[0] for w in want}
    assert not kept & {1, 2, 3, 5, 7, 8, 20, 30, 31, 32, 33} and {4, 6, 10, 34, 90} <= kept
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048


@pytest.mark.parametrize("items", [[], [(0, "an item of some length that nothing holds")]])
def test_pipeline_without_documents(spark, tmp_path, items):
    assert corpus_pipeline.run(spark, tables(spark, str(tmp_path), [], items)).count() == 0


def test_stages_keep_the_columns(spark, tmp_path):
    folder = tables(spark, str(tmp_path), [(1, "one"), (2, None), (3, "two words")], [(0, "one")])
    docs = spark.read.parquet(os.path.join(folder, "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.simpleString() == docs.schema.simpleString()
        docs = corpus_pipeline.save(out, "stage")
    assert sorted(r.doc_id for r in docs.collect()) == [3, 3]


def test_near_copies_from_80_percent_go(spark):
    rnd = random.Random(12)
    rows = []
    for k, (size, edits) in enumerate([(120, 1), (120, 2), (120, 3), (49, 1), (48, 1), (400, 8)]):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        copy = list(base)
        for e in range(edits):  # 0.92, 0.84, 0.77, exactly 0.8, 0.796, 0.816
            copy[(2 * e + 1) * size // (2 * edits)] = f"other{e}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    docs = spark.createDataFrame([(i, t, "xx", "s", 1, "k", "s", i) for i, t in rows], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    assert kept == {i for i, (_, root) in brute.near_duplicates(rows, threshold=80).items() if root == i}
    assert kept != {i for i, (_, root) in brute.near_duplicates(rows).items() if root == i}
