"""Contract files in batches and as a stream, with replaced, late, broken and empty files."""

import json
import os

import pytest
from pyspark.errors import AnalysisException

from pairforge.operators.extract import extract_functions, last_definition
from pairforge.sources import corpus
from pairforge.streaming import contracts

BODY = "public returns (bool) { total = total + amount; total = total - 1; return true; }"


def _put(root, name, text, codehash):
    os.makedirs(root, exist_ok=True)
    value = text if codehash is None else json.dumps({"codehash": codehash, "source": {"SourceCodes": [{"Code": text}]}})
    with open(os.path.join(root, name), "w") as out:
        out.write(value)


def _contract(*names):
    return "contract C { " + " ".join(f"function {n}(uint amount) {BODY}" for n in names) + " }"


def _functions(frame):
    return sorted((r.codehash, r.name, r.selector, r.text) for r in frame.collect())


def _batch(spark, root):
    sources = corpus.contract_sources(corpus.read_contracts(spark, root))
    return _functions(last_definition(extract_functions(sources, "codehash", "text", "contract")))


def test_stream_in_batches_equals_the_batch_job(spark, tmp_path):
    root, out, checkpoint = str(tmp_path / "files"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    _put(root, "b1.json", _contract("one", "two"), "0xa")
    _put(root, "b2.json", _contract("three"), "0xb")
    _put(root, "b3.json", "{ broken", None)
    assert contracts.take_in(spark, root, out, checkpoint, files_per_batch=10) == 1
    assert _functions(contracts.current_functions(spark, out)) == _batch(spark, root)
    _put(root, "c1.json", _contract("four"), "0xa")          # replaces both functions of 0xa
    _put(root, "c2.json", "{}", None)
    assert contracts.take_in(spark, root, out, checkpoint, files_per_batch=10) == 1
    now = _functions(contracts.current_functions(spark, out))
    assert now == _batch(spark, root) and [r[1] for r in now] == ["four", "three"]
    _put(root, "a1.json", _contract("late"), "0xb")          # comes late, but before b2 in order of path
    _put(root, "d1.json", "contract Empty {}", "0xa")        # replaces 0xa by nothing
    _put(root, "d2.json", _contract("five", "six"), "0xc")
    contracts.take_in(spark, root, out, checkpoint, files_per_batch=10)
    now = _functions(contracts.current_functions(spark, out))
    assert now == _batch(spark, root) and [r[1] for r in now] == ["three", "five", "six"]
    ids = sorted(r.id for r in spark.read.parquet(f"{out}/functions").collect())
    assert ids == list(range(len(ids))) and len(ids) == 6
    assert {r.status: r.n for r in contracts.file_statuses(spark, out).collect()} == {"ok": 6, "unreadable": 1, "no_source": 1}


def test_manifest_batches_read_each_file_once(spark, tmp_path):
    root, out = str(tmp_path / "files"), str(tmp_path / "out")
    for k in range(5):
        _put(os.path.join(root, f"d{k % 2}"), f"f{k}.json", _contract(f"g{k}"), f"0x{k % 4}")
    _put(root, "bad.json", "not json", None)
    _put(root, "other.txt", "not of the corpus", None)
    assert corpus.read_new_files(spark, root, out, batch_files=4) == 2
    done = spark.read.schema(corpus.DONE).parquet(f"{out}/done")
    assert sorted(r.status for r in done.collect()) == ["ok"] * 5 + ["unreadable"] and done.where("size is null").count() == 0
    assert corpus.read_new_files(spark, root, out, batch_files=4) == 0
    _put(root, "new.json", _contract("h"), "0x9")
    assert corpus.read_new_files(spark, root, out, batch_files=4) == 1
    sources = spark.read.parquet(f"{out}/sources")
    assert sources.count() == 6
    assert sorted((r.codehash, r.text) for r in corpus.last_file(sources).select("codehash", "text").collect()) == sorted(
        (r.codehash, r.text) for r in corpus.contract_sources(corpus.read_contracts(spark, root)).collect())


def test_nothing_to_read(spark, tmp_path):
    os.makedirs(tmp_path / "files")
    assert corpus.read_new_files(spark, str(tmp_path / "files"), str(tmp_path / "out")) == 0
    assert contracts.current_functions(spark, str(tmp_path / "none")).count() == 0


def test_the_folder_is_listed_once_for_all_batches(spark, tmp_path, monkeypatch):
    root, out, listed = str(tmp_path / "files"), str(tmp_path / "out"), []
    for k in range(5):
        _put(root, f"f{k}.json", _contract(f"g{k}"), f"0x{k}")
    inner = corpus.file_manifest

    def manifest(*given):
        listed.append(given)
        return inner(*given)
    monkeypatch.setattr(corpus, "file_manifest", manifest)
    assert corpus.read_new_files(spark, root, out, batch_files=2) == 3 and len(listed) == 1
    assert spark.read.parquet(f"{out}/sources").count() == 5


def test_files_lie_below_their_wave(spark, tmp_path):
    """A folder per contract cost a folder's making, commit and listing each."""
    from pairforge.plans.corpus import write_corpus
    rows = [(c, t, f"text {c} {t}") for c in range(40) for t in range(2)]
    spark.createDataFrame(rows, "conv_id bigint, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    files = write_corpus(spark, str(tmp_path), str(tmp_path / "corpus")).count()
    found = [p.relative_to(tmp_path / "corpus") for p in (tmp_path / "corpus").rglob("part-*.txt")]
    assert len(found) == files > 40
    assert {str(p.parent) for p in found} == {"wave=1", "wave=2", "wave=3"}
    texts = [p.read_text() for p in (tmp_path / "corpus" / "wave=1").glob("*.txt")]
    assert len({json.loads(t)["codehash"] for t in texts}) == len(texts) == 40


def test_batch_is_opened_once_and_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    for k in range(3):
        _put(str(tmp_path / "in"), f"{k}.json", _contract("f"), f"c{k}")
    seen, inner, before = [], contracts.written, spark.conf.get(contracts.LISTING)

    def written(df, name):
        listing = df.sparkSession.conf.get(contracts.LISTING)
        seen.append((name, int(listing), "_bad" in df._jdf.queryExecution().sparkPlan().toString()))
        return inner(df, name)
    monkeypatch.setattr(contracts, "written", written)
    assert contracts.take_in(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")) == 1
    assert [s[0] for s in seen if s[2]] == ["files"]
    assert {s[1] for s in seen} == {contracts.LISTING_TASKS * spark.sparkContext.defaultParallelism}
    assert spark.conf.get(contracts.LISTING) == before
    assert len(_functions(contracts.current_functions(spark, str(tmp_path / "out")))) == 3


def test_manifest_batch_is_opened_once_and_read_by_few_tasks(spark, tmp_path, monkeypatch):
    """Listing took a task per path, reading a task per few files, and each file was parsed twice."""
    root, out, seen, inner = str(tmp_path / "files"), str(tmp_path / "out"), [], corpus.written
    for k in range(200):
        _put(root, f"f{k}.json", _contract(f"g{k}"), f"0x{k}")
    _put(root, "bad.json", "not json", None)

    def written(df, name):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        seen.append((name, "_bad" in plan, df.rdd.getNumPartitions(), int(spark.conf.get(corpus.LISTING))))
        return inner(df, name)
    monkeypatch.setattr(corpus, "written", written)
    before, slots = [spark.conf.get(k) for k in (corpus.LISTING, corpus.OPEN_COST)], spark.sparkContext.defaultParallelism
    assert corpus.read_new_files(spark, root, out) == 1
    assert [s[0] for s in seen if s[1]] == ["files"]
    assert max(s[2] for s in seen) <= 2 * slots and {s[3] for s in seen} == {corpus.LISTING_TASKS * slots}
    assert [spark.conf.get(k) for k in (corpus.LISTING, corpus.OPEN_COST)] == before
    assert spark.read.parquet(f"{out}/sources").count() == 200 and spark.read.parquet(f"{out}/done").count() == 201


def test_settings_come_back_after_a_failure(spark, tmp_path):
    before = spark.conf.get(corpus.OPEN_COST)
    with pytest.raises(AnalysisException):
        corpus.read_new_files(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"))
    assert spark.conf.get(corpus.OPEN_COST) == before


def test_contract_files_have_no_checksum_files(spark, tmp_path):
    """Each file had one beside it, and a process was started for both."""
    from pairforge.plans.corpus import write_corpus
    rows = [(c, t, f"text {c} {t}") for c in range(5) for t in range(2)]
    spark.createDataFrame(rows, "conv_id bigint, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    write_corpus(spark, str(tmp_path), str(tmp_path / "corpus"))
    assert not list((tmp_path / "corpus").rglob(".*.crc")) and len(list((tmp_path / "corpus").rglob("part-*.txt"))) >= 5
