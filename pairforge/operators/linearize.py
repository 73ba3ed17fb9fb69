"""Linear data-flow form of a function.

Spark tokenizes every function with the extraction regex (whitespace and
comments dropped) and hands the token arrays, in Arrow batches, to
``rewrite`` -- a small recursive rewriter applied per function.  A function
the rewriter cannot read gets an ``error`` and goes to quarantine; pairs
need both sides to succeed.  Re-numbering and splitting are the usual
DataFrame operators.

Output grammar (L5): ``function name(p1,p2){s1;s2}``; blocks ``{...}``;
``unchecked`` doubles the braces; ``if`` -> ``(c?a)`` / ``(c?a:b)``;
``for(i;c;e) b`` -> ``i;((c)=>b e;)``; ``while`` -> ``(c=>b)``;
``do b while c`` -> ``b(c=>b)``; ``try x {b} catch {k}`` -> ``(x?b:k)``;
``return x`` -> ``return{x}``, ``return`` -> ``return{None}``; declarations
keep names only (``T x = e`` -> ``x=e``); calls ``f(a, b)``; operators
without spaces; ``1 ether`` -> ``1ether``; ternaries ``(c?a:b)``.  Dropped
(L2/L3): emit, revert statements, assembly, break, continue and
``require``/``assert``/``revert`` calls with arguments.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.operators.extract import JAVA_TOKEN_RX, KEYWORDS, SIZED_TYPES

_TYPES = {"address", "bool", "string", "bytes", "int", "uint", "byte", "fixed", "ufixed", "var"} | set(SIZED_TYPES)
_LOCATIONS = {"memory", "storage", "calldata", "payable", "indexed", "constant", "immutable"}
_ASSIGN = {"=", "|=", "^=", "&=", "<<=", ">>=", ">>>=", "+=", "-=", "*=", "/=", "%="}
_UNITS = {"wei", "gwei", "ether", "seconds", "minutes", "hours", "days", "weeks", "years"}
_GUARDS = {"require", "assert", "revert"}
_WORDS = set(KEYWORDS) | set(SIZED_TYPES)


class LinearizeError(ValueError):
    pass


def _is_name(t: str) -> bool:
    return (t[:1].isalpha() or t[:1] in "_$") and t not in _WORDS


class _Rewriter:
    def __init__(self, toks: list[str]):
        self.t, self.i = toks, 0

    def peek(self, k: int = 0) -> str | None:
        j = self.i + k
        return self.t[j] if j < len(self.t) else None

    def take(self, want: str | None = None) -> str:
        tok = self.peek()
        if tok is None or (want is not None and tok != want):
            raise LinearizeError(f"expected {want!r} at token {self.i}, got {tok!r}")
        self.i += 1
        return tok

    def until(self, stops: set[str]) -> list[str]:
        """Tokens up to (not including) a stop token at bracket depth 0."""
        out, depth = [], 0
        while True:
            tok = self.peek()
            if tok is None:
                raise LinearizeError(f"unexpected end looking for {stops}")
            if depth == 0 and tok in stops:
                return out
            if tok in "([{":
                depth += 1
            elif tok in ")]}":
                depth -= 1
                if depth < 0:
                    raise LinearizeError("unbalanced brackets")
            out.append(self.take())

    # ---------------------------------------------------------------- function
    def function(self) -> str:
        self.take("function")
        name = self.take()
        params = self.params()
        self.until({"{", ";"})
        if self.peek() == ";":
            raise LinearizeError("function without body")
        body = self.block()
        return f"function {name}({','.join(params)}){body}"

    def params(self) -> list[str]:
        self.take("(")
        inner = self.until({")"})
        self.take(")")
        names = []
        for p in _split_top(inner, ","):
            if len(p) >= 2 and _is_name(p[-1]) and p[-1] not in _LOCATIONS:
                names.append(p[-1])
        return names

    # --------------------------------------------------------------- statements
    def block(self) -> str:
        self.take("{")
        parts = []
        while self.peek() != "}":
            if self.peek() is None:
                raise LinearizeError("unclosed block")
            s = self.statement()
            if s is not None:
                parts.append(s)
        self.take("}")
        return "{" + ";".join(parts) + "}"

    def body(self) -> str:
        s = self.statement()
        return "" if s is None else s

    def statement(self) -> str | None:
        tok = self.peek()
        if tok == "{":
            return self.block()
        if tok == "unchecked":
            self.take()
            return "{" + self.block() + "}"
        if tok == "if":
            self.take()
            self.take("(")
            c = expr(self.until({")"}))
            self.take(")")
            a = self.body()
            if self.peek() == "else":
                self.take()
                return f"({c}?{a}:{self.body()})"
            return f"({c}?{a})"
        if tok == "for":
            self.take()
            self.take("(")
            init = self.simple(self.until({";"}))
            self.take(";")
            cond = expr(self.until({";"}))
            self.take(";")
            post = expr(self.until({")"}))
            self.take(")")
            b = self.body()
            head = f"{init};" if init else ""
            tail = f"{post};" if post else ""
            return f"{head}(({cond})=>{b}{tail})"
        if tok == "while":
            self.take()
            self.take("(")
            c = expr(self.until({")"}))
            self.take(")")
            return f"({c}=>{self.body()})"
        if tok == "do":
            self.take()
            b = self.body()
            self.take("while")
            self.take("(")
            c = expr(self.until({")"}))
            self.take(")")
            self.take(";")
            return f"{b}({c}=>{b})"
        if tok == "try":
            self.take()
            x = expr(self.until({"{", "returns"}))
            if self.peek() == "returns":
                self.take()
                self.take("(")
                self.until({")"})
                self.take(")")
            b = self.block()
            k = None
            while self.peek() == "catch":
                self.take()
                self.until({"{"})
                blk = self.block()
                k = blk if k is None else k
            return f"({x}?{b}:{k})" if k is not None else f"({x}?{b})"
        if tok == "return":
            self.take()
            e = self.until({";"})
            self.take(";")
            return f"return{{{expr(e)}}}" if e else "return{None}"
        if tok in ("emit", "break", "continue") or (tok == "revert" and self.peek(1) != "("):
            self.until({";"})
            self.take(";")
            return None
        if tok == "assembly":
            self.until({"{"})
            self._skip_braces()
            return None
        toks = self.until({";"})
        self.take(";")
        if toks and toks[0] in _GUARDS and len(toks) > 1 and toks[1] == "(":
            args = _split_top(toks[2:-1], ",") if toks[-1] == ")" else []
            if any(args):
                return None
        s = self.simple(toks)
        return s if s else None

    def _skip_braces(self) -> None:
        self.take("{")
        depth = 1
        while depth:
            tok = self.take()
            depth += tok == "{"
            depth -= tok == "}"

    def simple(self, toks: list[str]) -> str:
        """A declaration (names only) or an expression."""
        if not toks:
            return ""
        lhs, rhs = _split_assign(toks)
        if lhs and lhs[0] == "(" and _is_decl_tuple(lhs):
            names = [p[-1] if len(p) >= 2 else "" for p in _split_top(lhs[1:-1], ",")]
            out = "(" + ",".join(names) + ")"
            return out + ("=" + expr(rhs) if rhs is not None else "")
        if _is_decl(lhs):
            name = lhs[-1]
            return name + ("=" + expr(rhs) if rhs is not None else "")
        return expr(toks)


def _split_top(toks: list[str], sep: str) -> list[list[str]]:
    parts, cur, depth = [], [], 0
    for tok in toks:
        if tok in "([{":
            depth += 1
        elif tok in ")]}":
            depth -= 1
        if tok == sep and depth == 0:
            parts.append(cur)
            cur = []
        else:
            cur.append(tok)
    if cur or parts:
        parts.append(cur)
    return parts


def _split_assign(toks: list[str]):
    depth = 0
    for j, tok in enumerate(toks):
        if tok in "([{":
            depth += 1
        elif tok in ")]}":
            depth -= 1
        elif depth == 0 and tok == "=":
            return toks[:j], toks[j + 1:]
    return toks, None


def _is_decl(lhs: list[str]) -> bool:
    if len(lhs) < 2 or not _is_name(lhs[-1]):
        return False
    head = lhs[0]
    if head in _TYPES or head == "mapping":
        return True
    prev = lhs[-2]
    return _is_name(head) and (prev in _LOCATIONS or prev == "]" or _is_name(prev) or prev in _TYPES)


def _is_decl_tuple(lhs: list[str]) -> bool:
    if lhs[-1] != ")":
        return False
    parts = _split_top(lhs[1:-1], ",")
    return any(len(p) >= 2 and _is_decl(p) for p in parts)


def expr(toks: list[str]) -> str:
    """An expression without spaces; call arguments joined with ', '."""
    if not toks:
        return ""
    lhs, rhs = None, None
    depth = 0
    for j, tok in enumerate(toks):
        if tok in "([{":
            depth += 1
        elif tok in ")]}":
            depth -= 1
        elif depth == 0 and tok in _ASSIGN:
            return expr(toks[:j]) + tok + expr(toks[j + 1:])
    depth = 0
    for j, tok in enumerate(toks):
        if tok in "([{":
            depth += 1
        elif tok in ")]}":
            depth -= 1
        elif depth == 0 and tok == "?":
            rest = toks[j + 1:]
            d2, k = 0, None
            for m, t2 in enumerate(rest):
                if t2 in "([{":
                    d2 += 1
                elif t2 in ")]}":
                    d2 -= 1
                elif d2 == 0 and t2 == "?":
                    d2 += 100
                elif d2 >= 100 and t2 == ":":
                    d2 -= 100
                elif d2 == 0 and t2 == ":":
                    k = m
                    break
            if k is None:
                raise LinearizeError("ternary without ':'")
            return f"({expr(toks[:j])}?{expr(rest[:k])}:{expr(rest[k + 1:])})"
    return _atoms(toks)


def _atoms(toks: list[str]) -> str:
    out, j = [], 0
    while j < len(toks):
        tok = toks[j]
        if tok in ("(", "[", "{"):
            close = _match(toks, j)
            inner = toks[j + 1:close]
            prev = toks[j - 1] if j else None
            is_call = tok == "(" and prev is not None and (_is_name(prev) or prev in (")", "]") or prev in _TYPES)
            if tok == "{":
                opts = _split_top(inner, ",")
                out.append("{" + (_atoms(opts[0]) if opts and opts[0] else "") + "}")
            elif tok == "[":
                out.append("[" + ":".join(expr(p) for p in _split_top(inner, ":")) + "]")
            elif is_call:
                args = [expr(p) for p in _split_top(inner, ",")] if inner else []
                out.append("(" + ", ".join(args) + ")")
            else:
                parts = _split_top(inner, ",")
                if len(parts) == 1:
                    out.append("(" + expr(parts[0]) + ")")
                else:
                    out.append("(" + ",".join(expr(p) for p in parts) + ")")
            j = close + 1
            continue
        if tok in ("delete", "new") and j + 1 < len(toks):
            out.append(tok + " ")
        else:
            out.append(tok)
        j += 1
    return "".join(out)


def _match(toks: list[str], j: int) -> int:
    pairs = {"(": ")", "[": "]", "{": "}"}
    depth = 0
    for k in range(j, len(toks)):
        if toks[k] in pairs:
            depth += 1
        elif toks[k] in pairs.values():
            depth -= 1
            if depth == 0:
                return k
    raise LinearizeError("unbalanced brackets")


def rewrite(tokens: list[str]) -> str:
    """One function's tokens (no whitespace/comments) -> linear text."""
    r = _Rewriter(list(tokens))
    out = r.function()
    if r.peek() is not None:
        raise LinearizeError("text after the function")
    return out


_RESULT = T.StructType([T.StructField("linear", T.StringType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_RESULT)
def _rewrite_udf(tokens: pd.Series) -> pd.DataFrame:
    lin, err = [], []
    for toks in tokens:
        try:
            lin.append(rewrite(list(toks)))
            err.append(None)
        except (LinearizeError, IndexError, RecursionError) as e:
            lin.append(None)
            err.append(f"{type(e).__name__}: {e}")
    return pd.DataFrame({"linear": lin, "error": err})


def code_tokens(text: Column) -> Column:
    """Tokens without whitespace and comments (the linearisation lexer)."""
    toks = F.regexp_extract_all(text, F.lit(JAVA_TOKEN_RX), 0)
    return F.filter(toks, lambda t: ~t.rlike(r"^([ \t\r\n\x0c]|/\*|//)"))


def linearize(df: DataFrame, text: str, out: str = "linear", mode: str = "replace") -> DataFrame:
    """L1 for one text column: adds ``out`` and ``<out>_error``.  ``mode='append'``
    gives ``text + ' ' + linear`` (P12), ``'replace'`` the linear form (P13)."""
    r = df.withColumn("_lin", _rewrite_udf(code_tokens(F.col(text))))
    value = F.col("_lin.linear")
    if mode == "append":
        value = F.concat(F.col(text), F.lit(" "), value)
    return r.withColumn(out, value).withColumn(out + "_error", F.col("_lin.error")).drop("_lin")


def linearize_pairs(df: DataFrame, cols: list[str], mode: str = "replace") -> DataFrame:
    """L1 over several columns; ``error`` is set when any side failed."""
    out = df
    for c in cols:
        out = linearize(out, c, "_l_" + c, mode)
    err = F.coalesce(*[F.col(f"_l_{c}_error") for c in cols])
    for c in cols:
        out = out.withColumn(c, F.col("_l_" + c))
    return out.withColumn("error", err).drop(*[f"_l_{c}" for c in cols], *[f"_l_{c}_error" for c in cols])
