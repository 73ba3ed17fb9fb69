"""Extraction queries.

``span_extract`` runs the brace-depth machinery of X1 over ``pages.html``.
The contract queries build a two-sided corpus *from* ``conversations`` (one
contract per conversation, one function per turn, the turn's whole text
inside the body as a comment; the decompiled side names functions
``Unresolved_<selector>``) and run the full extraction, last-wins, match and
pairing path over it, so their work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions.hashing import keccak_selector
from pairforge.operators import extract as X
from pairforge.operators import pairs
from pairforge.plans.registry import query
from pairforge.session import written
from pairforge.sources import records
from pairforge.sources.tables import load


@query("span_extract", sql="""
WITH pc AS (SELECT page_id, unnest(p) AS piece, unnest(range(len(p))) AS i
            FROM (SELECT page_id, regexp_extract_all(html, '[{}]|[^{}]+') AS p FROM pages)),
o AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS off,
             sum(CASE WHEN piece = '{' THEN 1 WHEN piece = '}' THEN -1 ELSE 0 END)
               OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d FROM pc),
r AS (SELECT *, d - least(0, min(d) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS rd FROM o),
c AS (SELECT *, min(CASE WHEN rd = 0 THEN off END) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS close_off FROM r),
s AS (SELECT page_id, CAST(off AS BIGINT) AS span_start, CAST(close_off + 1 - off AS BIGINT) AS span_len FROM c
      WHERE piece = '{' AND rd = 1 AND close_off IS NOT NULL)
SELECT s.page_id, span_start, span_len, md5(substr(html, span_start, span_len)) AS span_md5
FROM s JOIN pages p ON p.page_id = s.page_id""")
def span_extract(spark, sf_dir):
    """X1 depth windows: top-level brace spans of every page."""
    pages = load(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    s = X.brace_spans(pages, "page_id", "html")
    return s.select("page_id", "span_start", "span_len", F.md5("span_text").alias("span_md5"))


def derived_contracts(spark, sf_dir):
    """Two views of one contract per conversation, derived by Spark."""
    conv = load(spark, sf_dir, "conversations")
    codehash = F.concat(F.lit("0x"), F.md5(F.col("conv_id").cast("string")))
    k = F.expr("turn div 2").cast("string")
    sig = F.concat(F.lit("f"), k, F.lit("(uint256,address)"))
    body = F.regexp_replace(F.col("text"), r"\*/", "* /")
    base = conv.select("conv_id", "turn", codehash.alias("codehash"), sig.alias("sig"), body.alias("body"))
    sels = base.select("sig").distinct().select("sig", keccak_selector(F.col("sig")).alias("sel"))
    base = base.join(sels, "sig")
    dec_fn = F.concat(F.lit("function Unresolved_"), F.col("sel"),
                      F.lit("(uint256 arg0, address arg1) public payable returns (bool) { /* "), F.col("body"),
                      F.lit(" */ if (arg0 == 0) { return true; } }\n"))
    src_fn = F.concat(F.lit("function f"), F.expr("turn div 2").cast("string"),
                      F.lit("(uint amount, address to) public returns (bool) { /* "), F.col("body"),
                      F.lit(" */ total = total + amount; return true; }\n"))

    def assemble(side_filter, fn):
        part = base.filter(side_filter).select("codehash", "turn", fn.alias("fn"))
        g = part.groupBy("codehash").agg(F.array_sort(F.collect_list(F.struct("turn", "fn"))).alias("fs"))
        return g.select("codehash", F.concat(F.lit("contract C {\n  uint total;\n"),
                                             F.array_join(F.transform("fs", lambda s: s["fn"]), ""),
                                             F.lit("}\n")).alias("text"))
    src = assemble(F.col("turn") % 2 == 0, src_fn)
    dec = assemble(F.col("turn") % 2 == 1, dec_fn)
    return src, dec


def extracted(spark, sf_dir):
    """Both function tables, checkpointed: every later branch (matching,
    ranking, sampling) reads the written tables instead of re-running the
    extraction windows."""
    src, dec = derived_contracts(spark, sf_dir)
    s = X.last_definition(X.extract_functions(src, "codehash", "text", "contract"))
    d = X.extract_functions(dec, "codehash", "text", "decompiled")
    d = X.last_definition(records.ok_rows(d))
    return s.checkpoint(), d.checkpoint()


@query("extract_functions")
def extract_functions_q(spark, sf_dir):
    """Functions of both sides (name, signature, selector, tokens)."""
    s, d = extracted(spark, sf_dir)
    cols = ["codehash", "side", "pos", "name", "signature", "selector", "n_tokens"]
    return s.select(*cols, F.md5("text").alias("text_md5")).unionByName(
        d.select(*cols, F.md5("text").alias("text_md5")))


@query("contract_pairs")
def contract_pairs(spark, sf_dir):
    """E1 end to end: extraction -> J1 match -> J4 positive/negative pairs ->
    K1 record lines (line breaks removed, delimiter clashes quarantined)."""
    s, d = extracted(spark, sf_dir)
    pn = pairs.pos_neg_pairs(s.select("codehash", "selector", "text"), d.select("codehash", "selector", "text"))
    lines = records.ok_rows(records.encode_records(pn))
    return lines.select("label", "codehash1", "codehash2", "selector1", "selector2",
                        F.length("value").alias("line_chars"), F.md5("value").alias("line_md5"))


@query("linearize_functions")
def linearize_functions(spark, sf_dir):
    """The linear form of every extracted function; failures keep an error."""
    from pairforge.operators import linearize as L
    s, d = extracted(spark, sf_dir)
    both = s.select("codehash", "side", "selector", "text").unionByName(d.select("codehash", "side", "selector", "text"))
    out = L.linearize(both, "text")
    return out.select("codehash", "side", "selector", F.length("linear").alias("n_chars"),
                      F.md5("linear").alias("linear_md5"), F.col("linear_error").alias("error"))


@query("linearize_pair_splits")
def linearize_pair_splits(spark, sf_dir):
    """Pair records -> both functions linearised (append mode) -> failed
    pairs quarantined -> ids re-numbered -> 70/20/10 split; rows per split,
    label and status."""
    from pairforge.operators import linearize as L
    from pairforge.operators import splits
    from pairforge.operators.index import dense_index
    s, d = extracted(spark, sf_dir)
    pn = pairs.pos_neg_pairs(s.select("codehash", "selector", "text"), d.select("codehash", "selector", "text"))
    # written once: numbering, split and counts each read it, and would make the pairs' joins anew
    lin = written(L.linearize_pairs(pn, ["func1", "func2"], mode="append"), "linear-pairs")
    good = dense_index(lin.filter(F.col("error").isNull()), ["codehash1", "selector1"], "id")
    good = written(good.select("id", "label"), "linear-ids")
    sp = splits.ordered_split(good, ["id"])
    ok = sp.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    bad = lin.filter(F.col("error").isNotNull()).groupBy(F.lit("quarantine").alias("split"), "label").agg(
        F.count(F.lit(1)).alias("n"))
    return ok.unionByName(bad)


def _q(s: str) -> str:
    return s.replace("'", "''")


_WORDS_SQL = "[" + ", ".join(f"'{w}'" for w in X.KEYWORDS + X.SIZED_TYPES) + "]"

_SRC_SQL = f"""body AS (SELECT conv_id, turn, '0x' || md5(CAST(conv_id AS VARCHAR)) AS codehash, replace(text, '*/', '* /') AS b
              FROM conversations WHERE turn % 2 = 0),
src AS (SELECT codehash, 'contract C {{' || chr(10) || '  uint total;' || chr(10)
               || string_agg('function f' || CAST(turn // 2 AS VARCHAR) || '(uint amount, address to) public returns (bool) {{ /* '
                             || b || ' */ total = total + amount; return true; }}' || chr(10), '' ORDER BY turn)
               || '}}' || chr(10) AS text
        FROM body GROUP BY codehash)"""


def extract_sql(src: str) -> str:
    """DuckDB form of extraction (X1-X3, X6): ``src`` defines the table src(codehash, text)."""
    return f"""
WITH {src},
raw AS (SELECT codehash, unnest(l) AS tok, unnest(range(len(l))) AS pos
        FROM (SELECT codehash, regexp_extract_all(text, '{_q(X.TOKEN_RX)}') AS l FROM src)),
tk AS (SELECT *, CASE WHEN regexp_matches(tok, '^([ \\t\\r\\n\\x0c]|/\\*|//)') THEN 'ws'
                      WHEN tok IN ('function', 'modifier') THEN 'fn'
                      WHEN regexp_matches(tok, '{X.SIGNATURE_TYPE_RX}') THEN 'sigtype'
                      WHEN regexp_matches(tok, '^[A-Za-z_$]') AND NOT list_contains({_WORDS_SQL}, tok)
                           AND NOT regexp_matches(tok, '{X.FIXED_RX}') THEN 'ident'
                      WHEN tok = ')' THEN 'rparen' WHEN tok = '{{' THEN 'lbrace' WHEN tok = '}}' THEN 'rbrace'
                      WHEN tok = ';' THEN 'semi' WHEN tok = '[' THEN 'lbrack' ELSE 'other' END AS kind
       FROM raw),
t AS (SELECT *,
        sum(CASE WHEN kind = 'lbrace' THEN 1 WHEN kind = 'rbrace' THEN -1 ELSE 0 END)
          OVER (PARTITION BY codehash ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS depth,
        min(CASE WHEN kind = 'ident' THEN pos END) OVER w AS next_ident,
        first_value(CASE WHEN kind = 'ident' THEN tok END IGNORE NULLS) OVER w AS next_name,
        min(CASE WHEN kind = 'rparen' THEN pos END) OVER w AS next_rparen,
        min(CASE WHEN kind IN ('lbrace', 'semi') THEN pos END) OVER w AS next_body,
        lead(kind) OVER (PARTITION BY codehash ORDER BY pos) AS next_kind
      FROM tk WINDOW w AS (PARTITION BY codehash ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
br AS (SELECT codehash, pos, kind, CASE WHEN kind = 'lbrace' THEN depth ELSE depth + 1 END AS level
       FROM t WHERE kind IN ('lbrace', 'rbrace')),
closes AS (SELECT codehash, body, close FROM (
             SELECT codehash, pos AS body, kind,
                    min(CASE WHEN kind = 'rbrace' THEN pos END) OVER (PARTITION BY codehash, level ORDER BY pos
                        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS close FROM br) WHERE kind = 'lbrace'),
starts AS (SELECT codehash, pos AS start, next_ident AS name_pos, next_rparen AS rparen FROM t
           WHERE kind = 'fn' AND next_ident IS NOT NULL AND next_rparen IS NOT NULL AND next_ident < next_rparen),
spans0 AS (SELECT s.codehash, s.start, s.name_pos, s.rparen, c.close
           FROM starts s JOIN t a ON a.codehash = s.codehash AND a.pos = s.rparen
           JOIN t b ON b.codehash = s.codehash AND b.pos = a.next_body AND b.kind = 'lbrace'
           JOIN closes c ON c.codehash = s.codehash AND c.body = a.next_body),
spans AS (SELECT * FROM (SELECT *, min(start) OVER (PARTITION BY codehash ORDER BY start
                                    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns FROM spans0)
          WHERE ns IS NULL OR ns > close),
tt AS (SELECT t.codehash, t.pos, t.tok, t.kind, t.next_kind,
              last_value(m.start IGNORE NULLS) OVER u AS start, last_value(m.name_pos IGNORE NULLS) OVER u AS name_pos,
              last_value(m.rparen IGNORE NULLS) OVER u AS rparen, last_value(m.close IGNORE NULLS) OVER u AS close
       FROM t LEFT JOIN spans m ON m.codehash = t.codehash AND m.start = t.pos
       WINDOW u AS (PARTITION BY t.codehash ORDER BY t.pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT codehash, start, count(*) AS n_tokens,
             string_agg(CASE WHEN kind = 'ws' THEN ' ' ELSE tok END, '' ORDER BY pos) AS text,
             max(CASE WHEN pos = name_pos THEN tok END) AS name,
             string_agg(CASE WHEN kind = 'sigtype' AND pos > name_pos AND pos < rparen
                             THEN (CASE WHEN tok = 'uint' THEN 'uint256' ELSE tok END)
                                  || (CASE WHEN next_kind = 'lbrack' THEN '[]' ELSE '' END) END, ',' ORDER BY pos) AS types
      FROM tt WHERE start IS NOT NULL AND pos <= close GROUP BY codehash, start),
g AS (SELECT *, name || '(' || coalesce(types, '') || ')' AS signature,
             row_number() OVER (PARTITION BY codehash, name || '(' || coalesce(types, '') || ')' ORDER BY start DESC) AS rn
      FROM f WHERE n_tokens > 20)
SELECT codehash, CAST(start AS BIGINT) AS pos, name, signature, n_tokens, md5(text) AS text_md5 FROM g WHERE rn = 1"""


@query("extract_source_functions", sql=extract_sql(_SRC_SQL))
def extract_source_functions(spark, sf_dir):
    """X1-X3 + X6 on the source side of the derived corpus (name, signature,
    token count and text; the selector is checked by unit tests)."""
    src, _ = derived_contracts(spark, sf_dir)
    f = X.extract_functions(src, "codehash", "text", "contract")
    f = X.last_definition(f)
    return f.select("codehash", F.col("pos").cast("bigint").alias("pos"), "name", "signature", "n_tokens",
                    F.md5("text").alias("text_md5"))


@query("selector_vectors")
def selector_vectors(spark, sf_dir):
    """Every distinct signature with its keccak selector and how many
    decompiled functions carry that selector in their name."""
    s, d = extracted(spark, sf_dir)
    sigs = s.groupBy("signature", "selector").agg(F.count(F.lit(1)).alias("n_source"))
    dec = d.groupBy("selector").agg(F.count(F.lit(1)).alias("n_decompiled"))
    return sigs.join(dec, "selector", "left").select("signature", "selector", "n_source",
                                                     F.coalesce("n_decompiled", F.lit(0)).alias("n_decompiled"))
