"""String functions (F1-F10, X2).  Every pattern is written so that Java
regex (Spark) and RE2 (DuckDB) read it the same way: explicit character
classes instead of ``\\s``/``\\w`` (whose meaning differs between engines),
``\\A``/``\\z`` anchors and ``\\x{...}`` code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character sets of Python's str.splitlines() and str.isspace().
LINE_BREAKS = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
PY_SPACE = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PY_SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# ASCII whitespace as lexers see it.
ASCII_WS = r"[ \t\n\r\x0b\x0c]"
ASCII_WS_RUN = ASCII_WS + "+"
# Word / whitespace run / single other character: the token stream used for
# minimum-length filters and word-level ids.
TOKEN_RX = r"[A-Za-z0-9_]+|[ \t\n\r\x0b\x0c]+|[^A-Za-z0-9_ \t\n\r\x0b\x0c]"
WORD_RX = r"[^ \t\n\r\x0b\x0c]+"
NON_ASCII = r"[^\x00-\x7F]"

RECORD_DELIM = "<CODESPLIT>"
REVIEW_DELIM = "<SPLIT>"


def remove_line_breaks(c: Column) -> Column:
    """``''.join(s.splitlines())``."""
    return F.regexp_replace(c, LINE_BREAKS, "")


def newline_to_space(c: Column) -> Column:
    """F2."""
    return F.replace(c, F.lit("\n"), F.lit(" "))


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` (all Unicode spaces, not just ' ')."""
    return F.btrim(c, F.lit(PY_SPACE_CHARS))


def split_keep_empty(c: Column, delim: str) -> Column:
    """``s.split(delim)`` -- trailing empty fields kept."""
    return F.split(c, _quote(delim), -1)


def delimiters(c: Column, delim: str) -> Column:
    """The number of delimiters, without making the fields."""
    return F.regexp_count(c, F.lit(_quote(delim)))


def rstrip_commas(c: Column) -> Column:
    """F5."""
    return F.regexp_replace(c, r",+\z", "")


def shard_key(c: Column) -> Column:
    """``codehash[2:6]``."""
    return F.substring(c, 3, 4)


def drop_non_ascii(c: Column) -> Column:
    """F9."""
    return F.regexp_replace(c, NON_ASCII, "")


def fixed_point(c: Column, fmt: str = "%3.3f") -> Column:
    """F10."""
    return F.format_string(fmt, c)


def collapse_whitespace(c: Column) -> Column:
    """X2 on text: every whitespace run becomes one space."""
    return F.regexp_replace(c, ASCII_WS_RUN, " ")


def token_count(c: Column) -> Column:
    """Number of tokens (words, whitespace runs, other characters), counted
    by the regex engine without materialising the tokens."""
    return F.regexp_count(c, F.lit(TOKEN_RX)).cast("int")


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(c, F.lit(WORD_RX)).cast("int")


def words(c: Column) -> Column:
    """Whitespace-separated words, in order."""
    return F.regexp_extract_all(c, F.lit(WORD_RX), 0)


def _quote(s: str) -> str:
    special = set(r".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in s)
