"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from pairforge.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
          "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLE[name])
    cols = rel.columns
    assert sorted(cols) == sorted(df.columns)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(cols, rel.types)}
    assert got == _rows(cols, rel.fetchall())


def _selectors(rows):
    from pairforge.functions.hashing import keccak256_hex
    for r in rows:
        if getattr(r, "side", "contract") == "contract":
            assert r.selector == keccak256_hex(r.signature.encode())[:8]


def _pairs(rows):
    for r in rows:
        assert (r.codehash1 == r.codehash2) == (r.label == 1)
    assert {r.label for r in rows} == {0, 1}


def _scores(rows):
    _pairs(rows)
    for r in rows:
        assert r.pred == (r.logits[1] > r.logits[0]) and r.logits[0] == -r.logits[1]
        assert r.scored_line.startswith(f"{r.label}<CODESPLIT>{r.codehash1}<CODESPLIT>{r.codehash2}<CODESPLIT>")
    right = [r.pred == r.label for r in rows if r.split == "train"]
    assert sum(right) > 0.6 * len(right)


def _documents(rows):
    assert len({r.doc_id for r in rows}) == len(rows) == 200
    assert all(r.n_tokens >= 0 and len(r.ids_md5) == 32 for r in rows)


def _merges(rows):
    assert sorted(r.rank for r in rows) == list(range(len(rows))) and len(rows) == 185
    assert all(r.token == r.left + r.right for r in rows)


#: what must hold for the rows of queries that SQL cannot express
PROPERTIES = {
    "batch_scores": _scores,
    "bpe_encode": _documents,
    "bpe_length_stats": lambda rows: [None for r in rows if not r.min_len <= r.q1 <= r.q3 <= r.max_len] == [] or pytest.fail(),
    "bpe_train": _merges,
    "contract_pairs": _pairs,
    "extract_functions": _selectors,
    "selector_vectors": _selectors,
}
LLM = {n for n in QUERIES if n.startswith("op") or n == "pipeline"}  # tested in tests/llm


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - LLM))
def test_queries_without_oracle(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows
    PROPERTIES.get(name, lambda rows: None)(rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["split", "label", "n_pairs"]
