
from pairforge.operators import extract as X

CONTRACT = """contract T {
  uint total; /* } */ // {
  modifier onlyOwner() { require(msg.sender == owner, "x{"); _; }
  constructor() { total = 0; }
  function transfer(address to, uint amount) public returns (bool) { total = total - amount; /* c */ return true; }
  function stub(uint a) external;
  function tiny() public {}
  function many(uint[] memory xs, T other, int k) internal { if (k > 0) { total += xs[0]; } }
  receive() external payable { total = 1; }
}"""

DECOMPILED = ("function Unresolved_a9059cbb(address arg0, uint256 arg1) public payable returns (bool) "
              "{ if (arg0 == msg.sender) { return true; } }")


def test_extraction_goldens(spark):
    df = spark.createDataFrame([("0xabc", CONTRACT)], "codehash string, text string")
    got = {r.name: r for r in X.extract_functions(df).collect()}
    assert set(got) == {"onlyOwner", "transfer", "many"}
    assert (got["onlyOwner"].signature, got["onlyOwner"].selector, got["onlyOwner"].n_tokens) == ("onlyOwner()", "1036e0a8", 27)
    assert (got["transfer"].signature, got["transfer"].selector, got["transfer"].n_tokens) == (
        "transfer(address,uint256)", "a9059cbb", 43)
    assert got["transfer"].text.endswith("total = total - amount;   return true; }")
    assert got["transfer"].text.startswith("function transfer(address to, uint amount)")
    assert (got["many"].signature, got["many"].n_tokens) == ("many(uint256[],int)", 52)
    # tiny() has only 10 tokens
    allf = {r.name: r.n_tokens for r in X.extract_functions(df, min_tokens=0).collect()}
    assert allf["tiny"] == 10 and "stub" not in allf


def test_extraction_non_compat_signature(spark):
    df = spark.createDataFrame([("0xabc", CONTRACT)], "codehash string, text string")
    got = {r.name: r.signature for r in X.extract_functions(df, compat=False).collect()}
    assert got["many"] == "many(uint256[],address,int256)"          # FIXTURES §3
    assert got["transfer"] == "transfer(address,uint256)"
    dims = spark.createDataFrame([("0x1", "interface I {} function g(uint[3][] memory a, byte b, I c) public { "
                                   + "x = 1; x = 2; x = 3; x = 4; }")], "codehash string, text string")
    sig = X.extract_functions(dims, compat=False).first().signature
    assert sig == "g(uint256[3][],bytes1,address)"


def test_decompiled_side(spark):
    df = spark.createDataFrame([("0xabc", DECOMPILED), ("0xdef", DECOMPILED.replace("Unresolved_a9059cbb", "Broken"))],
                               "codehash string, text string")
    got = {r.codehash: r for r in X.extract_functions(df, side="decompiled").collect()}
    assert got["0xabc"].selector == "a9059cbb" and got["0xabc"].n_tokens == 48 and got["0xabc"].error is None
    assert got["0xdef"].error == "name_without_selector"


def test_last_definition_wins(spark):
    twice = CONTRACT.replace("function tiny() public {}",
                             "function transfer(address a, uint256 b) public { total = total + b; total = total + 1; }")
    df = spark.createDataFrame([("0xabc", twice)], "codehash string, text string")
    f = X.last_definition(X.extract_functions(df))
    tr = [r for r in f.collect() if r.selector == "a9059cbb"]
    assert len(tr) == 1 and "total + 1" in tr[0].text


def test_brace_spans(spark):
    df = spark.createDataFrame([(1, "a{b{c}d}e}f{g"), (2, "}{x}{")], "k int, t string")
    got = sorted((r.k, r.span_start, r.span_text) for r in X.brace_spans(df, "k", "t").collect())
    assert got == [(1, 2, "{b{c}d}"), (2, 2, "{x}")]


def _function(body):
    return "function big(uint a) public returns (bytes memory) { total = total + a; x = a; " + body + " return data; }"


def test_long_literals_do_not_overflow_the_stack(spark):
    literals = ['"' + "x" * 200_000 + '"', "'" + "y{" * 100_000 + "'", '"' + r"\"" * 50_000 + '"',
                '"' + r"\\a}" * 50_000 + '"', "/*" + "{" * 200_000 + "*/", "//" + "}" * 200_000 + "\n"]
    df = spark.createDataFrame([(f"0x{i}", _function(f"data = {s};")) for i, s in enumerate(literals)],
                               "codehash string, text string")
    got = {r.codehash: r for r in X.extract_functions(df).collect()}
    assert len(got) == len(literals)
    for i, s in enumerate(literals):
        assert got[f"0x{i}"].signature == "big(uint256)"
        text = {"/*": " ", "//": "  "}.get(s[:2], s)  # a comment is one space, and so is the line break after it
        assert got[f"0x{i}"].text == _function(f"data = {text};")


def test_patterns_of_both_engines_agree(spark):
    import random

    import duckdb
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["'", '"', "\\", "\n", "a", "_$", "0x1F", "1.5e-3", "/*", "*/", "//", " ", ">>=", "é", "{"])
                     for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {}
    for r in sorted(X.tokens(df, "k", "t").collect(), key=lambda r: (r.k, r.pos)):
        got.setdefault(r.k, []).append(r.tok)
    for k, t in enumerate(texts):
        want = duckdb.execute("select regexp_extract_all(?, ?)", [t, X.TOKEN_RX]).fetchone()[0]
        assert got.get(k, []) == want and "".join(want) == t
