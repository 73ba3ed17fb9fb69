import re

import pytest

from pairforge.operators.extract import TOKEN_RX
from pairforge.operators import linearize as L


def toks(s):
    return [t for t in re.findall(TOKEN_RX, s) if not re.match(r"^([ \t\r\n\x0c]|/\*|//)", t)]


def lin_body(stmts):
    out = L.rewrite(toks("function g() public { " + stmts + " }"))
    return out[len("function g(){"):-1]


def test_function_golden():
    src = ("function f(uint256 a, address to) public returns (bool) { require(a > 0, \"x\"); uint256 b = a + 1; "
           "emit T(to); if (b > 2) { b = 3; } else { b = 4; } return true; }")
    assert L.rewrite(toks(src)) == "function f(a,to){b=a+1;(b>2?{b=3}:{b=4});return{true}}"


@pytest.mark.parametrize("stmts,want", [
    ("for (uint i = 0; i < 10; i++) { x += i; }", "i=0;((i<10)=>{x+=i}i++;)"),
    ("while (a < b) { a++; }", "(a<b=>{a++})"),
    ("do { a++; } while (a < b);", "{a++}(a<b=>{a++})"),
    ("h(a, b + 1);", "h(a, b+1)"),
    ("unchecked { a = b; }", "{{a=b}}"),
    ("return;", "return{None}"),
    ("revert();", "revert()"),
    ("assert(a);", ""),
    ("uint total;", "total"),
    ("x = a ? b : c;", "x=(a?b:c)"),
    ("delete x;", "delete x"),
    ("(uint a, uint b) = f();", "(a,b)=f()"),
    ("t = 1 ether;", "t=1ether"),
    ("for (;;) { x = 1; }", "(()=>{x=1})"),
    ("try c.f() returns (uint v) { x = v; } catch { x = 0; }", "(c.f()?{x=v}:{x=0})"),
    ("emit E(1); break;", ""),
    ("assembly { let z := 1 }", ""),
])
def test_statement_goldens(stmts, want):
    assert lin_body(stmts) == want


def test_unnamed_params_vanish_and_errors():
    assert L.rewrite(toks("function k(uint, address who) external { }")) == "function k(who){}"
    with pytest.raises(L.LinearizeError):
        L.rewrite(toks("function k(uint a) external { if (a) "))


def test_linearize_udf_quarantines(spark):
    df = spark.createDataFrame([("function a() public { x = 1; }",), ("function b( {",)], "f string")
    got = {r.f: (r.linear, r.linear_error) for r in L.linearize(df, "f").collect()}
    assert got["function a() public { x = 1; }"] == ("function a(){x=1}", None)
    assert got["function b( {"][0] is None and got["function b( {"][1]


def test_pairs_need_both_sides(spark):
    df = spark.createDataFrame([("function a() public { x = 1; }", "function b() public { y = 2; }"),
                                ("function a() public { x = 1; }", "function b( {")], "func1 string, func2 string")
    got = L.linearize_pairs(df, ["func1", "func2"], mode="append").collect()
    ok = [r for r in got if r.error is None]
    assert len(ok) == 1 and ok[0].func1 == "function a() public { x = 1; } function a(){x=1}"
    assert len([r for r in got if r.error]) == 1


def test_pairs_are_linearised_once(spark, tmp_path, monkeypatch):
    from pairforge.plans.extraction import linearize_pair_splits
    rows = [(c, t, f"text {c} {t}") for c in range(12) for t in range(4)]
    spark.createDataFrame(rows, "conv_id bigint, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    seen, inner = spark.sparkContext.accumulator(0), L.linearize_pairs

    def counted(df, cols, mode="replace"):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        out = inner(df, cols, mode)
        return out.mapInArrow(count, out.schema)
    monkeypatch.setattr(L, "linearize_pairs", counted)
    got = linearize_pair_splits(spark, str(tmp_path)).collect()
    sizes = {s: sum(r.n for r in got if r.split == s) for s in ("train", "valid", "test")}
    assert sizes == {"train": 8, "valid": 2, "test": 2} and seen.value == 12
