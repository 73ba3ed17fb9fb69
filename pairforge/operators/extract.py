"""Function extraction from contract sources (X1-X8), as Spark window jobs.

1. Tokens: one JVM regex pass per text (comments, strings, words, numbers,
   whitespace runs, operators, any other character), ``posexplode``d.  A
   whitespace run or a comment is one token and is written as one space.
2. Per token, window frames over the tokens of the same text give: running
   brace depth, the matching ``}`` of a ``{`` (braces of one nesting level, in
   order), the next identifier, the next ``{``/``;``, the next ``)`` with what
   follows it, and the kind of the next token.  All are windows over one
   partitioning by text: the tokens are made once and never joined.
3. Starts are ``function``/``modifier`` tokens whose next identifier comes
   before their next ``)`` (else the declaration is abandoned: fallback,
   receive, function types).  The body opener is the first ``{``/``;`` after
   that ``)``; a ``;`` means a stub, which is dropped.
4. Each token learns the function it belongs to from a running ``max`` of
   span starts, so no range join is needed; a function's text is its tokens
   joined in order.  Signature types are the type tokens between the name
   and the first ``)``.  Keccak runs once per distinct signature and batch.

The window partition is one text: the work per partition is bounded by the
size of one contract, which must be scanned as a whole anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.hashing import keccak_selector

# Token patterns in the order they are tried.
TOKEN_PATTERNS = [
    r"/\*[\s\S]*?\*/",                      # block comment
    r"//[^\r\n]*",                          # line comment
    r'"(?:[^"\r\n\\]|\\.)*"',               # double-quoted string
    r"'(?:[^'\r\n\\]|\\.)*'",               # single-quoted string
    r"[A-Za-z_$][A-Za-z0-9_$]*",            # identifier or keyword
    r"0[xX][0-9A-Fa-f_]+|[0-9][0-9_]*(?:\.[0-9_]+)?(?:[eE]-?[0-9_]+)?",  # number
    r"[ \t\r\n\x0c]+",                      # whitespace run
    r">>>=|<<=|>>=|>>>|\*\*|=>|->|:=|==|!=|<=|>=|&&|\|\||\+\+|--|\+=|-=|\*=|/=|%=|\|=|&=|\^=|<<|>>",
    r"[\s\S]",                              # any other character
]
#: for engines whose regexes don't backtrack
TOKEN_RX = "|".join(TOKEN_PATTERNS)
# Java's engine recurses on a repeated choice, once per character, and overflows the stack in
# a long literal.  The possessive form matches the same text in a loop: what a round of it
# takes never needs to be given back, as neither choice matches a closing quote alone.
JAVA_TOKEN_RX = TOKEN_RX
for _quote in "\"'":
    JAVA_TOKEN_RX = JAVA_TOKEN_RX.replace(rf"(?:[^{_quote}\r\n\\]|\\.)*", rf"(?:[^{_quote}\r\n\\]++|\\.)*+")

# Solidity words that the lexer does not return as Identifier.
KEYWORDS = """abstract address anonymous as assembly bool break bytes calldata catch constant constructor
continue contract delete do else emit enum error event external fallback false fixed for from function
global hex if immutable import indexed interface internal is library mapping memory modifier new
override payable pragma private public pure receive return returns revert storage string struct true
try type ufixed unchecked unicode using view virtual while
after alias apply auto byte case copyof default define final implements in inline let macro match
mutable null of partial promise reference relocatable sealed sizeof static supports switch typedef
typeof var
wei gwei ether seconds minutes hours days weeks years
int uint""".split()
# Sized type names are built from their rule: bytes1..bytes32, int8..int256, uint8..uint256.
SIZED_TYPES = ([f"bytes{n}" for n in range(1, 33)] + [f"int{n}" for n in range(8, 257, 8)]
               + [f"uint{n}" for n in range(8, 257, 8)])
# Types that enter a signature -- address, bool, bytes, string,
# int, uint and the sized bytesN / intN / uintN names built above.
SIGNATURE_TYPES = ["address", "bool", "bytes", "string", "int", "uint"] + SIZED_TYPES
SIGNATURE_TYPE_RX = "^(" + "|".join(SIGNATURE_TYPES) + ")$"
FIXED_RX = r"^u?fixed([1-9][0-9]*x[1-9][0-9]*)?$"
MIN_TOKENS = 20


def tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, pos, tok, kind)``; kind in ws, fn, ident, rparen, lbrace,
    rbrace, semi, lbrack, sigtype, other."""
    t = df.select(F.col(key), F.posexplode(F.regexp_extract_all(F.col(text), F.lit(JAVA_TOKEN_RX), 0)).alias("pos", "tok"))
    tok, first = F.col("tok"), F.substring("tok", 1, 1)
    letter = first.between("a", "z") | first.between("A", "Z") | first.isin("_", "$")
    # look-ups in hash sets; a pattern is tried on the few words that could match it
    kind = (F.when(first.isin(" ", "\t", "\r", "\n", "\x0c") | F.substring("tok", 1, 2).isin("/*", "//"), "ws")
             .when(tok.isin("function", "modifier"), "fn")
             .when(tok.isin(*SIGNATURE_TYPES), "sigtype")
             .when(letter & ~tok.isin(*KEYWORDS, *SIZED_TYPES)
                   & ~((tok.startswith("fixed") | tok.startswith("ufixed")) & tok.rlike(FIXED_RX)), "ident")
             .when(tok == ")", "rparen").when(tok == "{", "lbrace").when(tok == "}", "rbrace")
             .when(tok == ";", "semi").when(tok == "[", "lbrack")
             .otherwise("other"))
    return t.withColumn("kind", kind)


def _next(cond: Column, value: Column, w) -> Column:
    return F.min(F.when(cond, value)).over(w)


def _without_assembly(t: DataFrame, key: str) -> DataFrame:
    """Tokens of ``assembly { ... }`` blocks, braces included, get the kind
    ``other``: words in there are Yul, so its functions start nothing.

    A ``{`` opens such a block if the last of ``assembly``, ``{``, ``}`` and ``;``
    before it is ``assembly``; the block lasts while the depth stays at its own."""
    in_order = Window.partitionBy(key).orderBy("pos")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    k = F.col("kind")
    brace = k.isin("lbrace", "rbrace")
    mark = F.last(F.when(brace | (k == "semi") | (F.col("tok") == "assembly"), F.col("tok")), ignorenulls=True)
    t = t.withColumn("_mark", mark.over(in_order.rowsBetween(Window.unboundedPreceding, -1)))
    t = t.withColumn("_depth", F.sum(F.when(k == "lbrace", 1).when(k == "rbrace", -1).otherwise(0)).over(upto))
    t = t.withColumn("_blocks", F.sum(F.when((k == "lbrace") & (F.col("_mark") == "assembly"), 1).otherwise(0)).over(upto))
    block = Window.partitionBy(key, "_blocks").orderBy("pos")
    first = F.first("_depth").over(block.rowsBetween(Window.unboundedPreceding, 0))
    lowest = F.min("_depth").over(block.rowsBetween(Window.unboundedPreceding, -1))
    inside = (F.col("_blocks") > 0) & (F.coalesce(lowest, first) >= first)
    return t.withColumn("kind", F.when(inside & (k != "ws"), F.lit("other")).otherwise(k)).drop("_mark", "_depth", "_blocks")


def extract_functions(df: DataFrame, key: str = "codehash", text: str = "text", side: str = "contract",
                      compat: bool = True, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """One row per function with a body of more than ``min_tokens``
    tokens: ``(key, side, pos, name, signature, selector, n_tokens, text, error)``.
    ``side='decompiled'`` takes the selector from the name (``Unresolved_<sel>``);
    a name without ``_`` gets ``error`` set instead of failing the job."""
    t = _without_assembly(tokens(df, key, text), key)
    # "over the rows after this one" as a running frame over the reversed
    # order: Spark evaluates an unbounded-following frame in O(n^2) per
    # partition, a running (unbounded-preceding) frame in O(n).
    w_after = Window.partitionBy(key).orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    w_upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    k, pos = F.col("kind"), F.col("pos")

    def following(cond: Column, *fields: str) -> Column:
        """The fields of the nearest later token that meets the condition."""
        return F.last(F.when(cond, F.struct(*fields)), ignorenulls=True).over(w_after)

    t = t.withColumn("depth", F.sum(F.when(k == "lbrace", 1).when(k == "rbrace", -1).otherwise(0)).over(w_upto))
    # matching close brace: braces of one nesting level, in order
    level = F.when(k == "lbrace", F.col("depth")).when(k == "rbrace", F.col("depth") + 1)
    wl = Window.partitionBy(key, "level").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("level", level).withColumn("close", _next(k == "rbrace", pos, wl))
    t = (t.withColumn("ident", following(k == "ident", "pos", "tok"))
          .withColumn("opener", following(k.isin("lbrace", "semi"), "pos", "kind", "close"))
          .withColumn("paren", following(k == "rparen", "pos", "opener"))
          .withColumn("next_kind", F.lead("kind").over(Window.partitionBy(key).orderBy("pos"))))
    begins = ((k == "fn") & (F.col("ident.pos") < F.col("paren.pos")) & (F.col("paren.opener.kind") == "lbrace")
              & F.col("paren.opener.close").isNotNull())
    t = t.withColumn("begins", F.coalesce(begins, F.lit(False)))
    if compat:
        # a start inside another span restarts extraction there: drop the outer span
        later = _next(F.col("begins"), pos, w_after)
        t = t.withColumn("_later", later).withColumn(
            "begins", F.col("begins") & F.coalesce(F.col("_later") > F.col("paren.opener.close"), F.lit(True)))

    # every token learns the span it belongs to (spans do not overlap now)
    span = F.struct(pos.alias("start"), F.col("ident.pos").alias("name_pos"), F.col("paren.pos").alias("rparen"),
                    F.col("paren.opener.close").alias("close"))
    tt = t.withColumn("span", F.last(F.when(F.col("begins"), span), ignorenulls=True).over(w_upto))
    tt = tt.select(key, "pos", "tok", "kind", "next_kind", "span.*").filter(F.col("pos") <= F.col("close"))

    piece = F.when(F.col("kind") == "ws", F.lit(" ")).otherwise(F.col("tok"))
    tname = F.when(F.col("tok") == "uint", F.lit("uint256")).otherwise(F.col("tok"))
    arr = F.when(F.col("next_kind") == "lbrack", F.lit("[]")).otherwise(F.lit(""))
    is_param = (F.col("kind") == "sigtype") & (F.col("pos") > F.col("name_pos")) & (F.col("pos") < F.col("rparen"))
    in_params = (F.col("kind") != "ws") & (F.col("pos") > F.col("name_pos")) & (F.col("pos") < F.col("rparen"))
    funcs = tt.groupBy(key, "start").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("pos", piece.alias("p")))).alias("_pieces"),
        F.array_sort(F.collect_list(F.when(is_param, F.struct("pos", F.concat(tname, arr).alias("t"))))).alias("_types"),
        F.array_sort(F.collect_list(F.when(in_params, F.struct("pos", F.col("tok").alias("t"))))).alias("_params"),
        F.max(F.when(F.col("pos") == F.col("name_pos"), F.col("tok"))).alias("name"))
    if compat:
        types = F.array_join(F.transform("_types", lambda s: s["t"]), ",")
    else:
        types = _abi_types(funcs, t, key)
        funcs = funcs.join(_contract_names(t, key), key, "left")
    funcs = funcs.select(
        F.col(key), F.lit(side).alias("side"), F.col("start").alias("pos"), "name", "n_tokens",
        F.array_join(F.transform("_pieces", lambda s: s["p"]), "").alias("text"),
        F.concat(F.col("name"), F.lit("("), types, F.lit(")")).alias("signature"))
    funcs = funcs.filter(F.col("n_tokens") > min_tokens)
    if side == "decompiled":
        parts = F.split(F.col("name"), "_")
        return funcs.select("*", F.get(parts, 1).alias("selector"),
                            F.when(F.size(parts) < 2, F.lit("name_without_selector")).alias("error"))
    # hashed where the function is: no join of texts on a signature that most contracts have
    return funcs.select(key, "side", "pos", "name", "signature", keccak_selector(F.col("signature")).alias("selector"),
                        "n_tokens", "text", F.lit(None).cast("string").alias("error"))


_CONTRACT_WORDS = ("contract", "interface", "library")


def _contract_names(t: DataFrame, key: str) -> DataFrame:
    """Names declared by ``contract``/``interface``/``library`` in each text
    (bounded by the number of such declarations in one file)."""
    w_before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.when(F.col("kind") != "ws", F.col("tok")), ignorenulls=True).over(w_before)
    decl = t.withColumn("_prev", prev).filter((F.col("kind") == "ident") & F.col("_prev").isin(*_CONTRACT_WORDS))
    return decl.groupBy(key).agg(F.collect_set("tok").alias("_cnames"))


def _abi_types(funcs: DataFrame, t: DataFrame, key: str) -> Column:
    """``compat=False``: every parameter's type, ABI-canonicalised: ``int`` ->
    ``int256``, ``uint`` -> ``uint256``, ``byte`` -> ``bytes1``, contract /
    interface / library types -> ``address``; array dimensions are kept
    (``T[3][]``).  Other user-defined types keep their name."""
    toks = F.transform("_params", lambda s: s["t"])
    body = F.regexp_replace(F.array_join(toks, " "), r"^\( ?", "")
    params = F.filter(F.split(body, " ?, ?"), lambda p: p != "")

    def canon(p):
        first = F.regexp_extract(p, r"^(\S+)", 1)
        dims = F.regexp_replace(F.regexp_extract(p, r"^\S+((?: \[(?: [0-9]+)? \])*)", 1), " ", "")
        mapped = (F.when(first == "uint", F.lit("uint256")).when(first == "int", F.lit("int256"))
                   .when(first == "byte", F.lit("bytes1"))
                   .when(F.coalesce(F.array_contains(F.col("_cnames"), first), F.lit(False)), F.lit("address"))
                   .otherwise(first))
        return F.concat(mapped, dims)
    return F.array_join(F.transform(params, canon), ",")


def last_definition(funcs: DataFrame, key: str = "codehash") -> DataFrame:
    """The last definition of a selector in a contract wins."""
    w = Window.partitionBy(key, "side", "selector").orderBy(F.col("pos").desc())
    return funcs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def brace_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """Top-level ``{...}`` spans of a text (the depth/matching part of X1):
    ``(key, span_start, span_len, span_text)``, 1-based character offsets.

    The text is cut into ``{``, ``}`` and runs of other characters.  The
    depth is clamped at zero (a ``}`` with no opener is ignored) using
    ``clamped = depth - min(0, running min of depth)``.  A span opens where
    the clamped depth becomes 1 and closes at the next piece where it is 0
    again; an unclosed span is dropped.  Windows only -- no pairing of
    openers with closers.
    """
    pieces = df.select(F.col(key), F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r"[{}]|[^{}]+"), 0))
                       .alias("i", "piece"))
    w = Window.partitionBy(key).orderBy("i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(key).orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col("piece") == "{", 1).when(F.col("piece") == "}", -1).otherwise(0)
    p = (pieces.withColumn("off", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + 1)
               .withColumn("d", F.sum(step).over(upto)))
    p = p.withColumn("rd", F.col("d") - F.least(F.lit(0), F.min("d").over(upto)))
    p = p.withColumn("close_off", F.min(F.when(F.col("rd") == 0, F.col("off"))).over(after))
    spans = p.filter((F.col("piece") == "{") & (F.col("rd") == 1) & F.col("close_off").isNotNull())
    spans = spans.select(key, F.col("off").alias("span_start"), (F.col("close_off") + 1 - F.col("off")).alias("span_len"))
    src = df.select(F.col(key), F.col(text).alias("_t"))
    return spans.join(src, key).select(key, "span_start", "span_len",
                                       F.expr("substring(_t, span_start, span_len)").alias("span_text"))
