"""Deterministic hashing shared by every "random" operator.

``dhash(seed, *cols)`` is a 60-bit non-negative BIGINT taken from the first 15
hex digits of ``md5(concat_ws('|', seed, cols...))``.  DuckDB computes the
same value with ``('0x' || substr(md5(concat_ws('|', ...)), 1, 15))::BIGINT``,
so sampling, shuffling and splitting are reproducible across engines and
independent of partitioning.

``keccak256_hex`` is the Ethereum hash (Keccak with the original 0x01
padding, not SHA3-256); Spark has no built-in for it, so it runs as an
Arrow-batched pandas UDF and callers apply it to *distinct* values only.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hash_key(seed, *cols) -> Column:
    """The string that is hashed: ``seed|c1|c2...`` (NULLs skipped like concat_ws)."""
    parts = [F.lit(str(seed))] + [_as_col(c).cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def dhash(seed, *cols) -> Column:
    """Portable 60-bit hash of ``seed`` and the given columns."""
    return F.conv(F.substring(F.md5(hash_key(seed, *cols)), 1, 15), 16, 10).cast("bigint")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _position_draws(prefix: pd.Series, size: pd.Series) -> pd.Series:
    ends = [f"|{i}".encode() for i in range(int(size.fillna(0).max()) if len(size) else 0)]

    def draw(start, end):
        state = start.copy()
        state.update(end)
        return int.from_bytes(state.digest()[:8], "big") >> 4  # the first 15 hex digits
    return pd.Series([None if pd.isna(n) else [draw(start, end) for end in ends[:int(n)]]
                      for start, n in zip((hashlib.md5(p.encode()) for p in prefix), size)], dtype=object)


def position_hashes(seed, key: Column, size: Column) -> Column:
    """``dhash(seed, key, i)`` of the positions i = 0, 1, ... below ``size``, as an array."""
    return _position_draws(hash_key(seed, key), size)


def dhash_sql(seed, *exprs: str) -> str:
    """DuckDB/ANSI SQL text for the same value (used by the oracle queries)."""
    inner = ", ".join([f"'{seed}'"] + list(exprs))
    return f"('0x' || substr(md5(concat_ws('|', {inner})), 1, 15))::BIGINT"


def md5_low64_bit(text_col: Column, bit: int) -> Column:
    """Bit ``bit`` (0 = least significant) of the low 64 bits of md5(text).

    The low 64 bits are the last 16 hex digits; bit i lives in hex digit
    ``32 - i // 4`` (1-based) at position ``i % 4``.  Reading one hex digit
    keeps the arithmetic inside 32-bit integers in every engine.
    """
    digit = F.conv(F.substring(F.md5(text_col), 32 - bit // 4, 1), 16, 10).cast("int")
    return F.shiftright(digit, bit % 4).bitwiseAND(F.lit(1))


# ---------------------------------------------------------------- Keccak-256
_MASK64 = (1 << 64) - 1
_ROUNDS = 24


def _round_constants() -> list[int]:
    # Generated by the LFSR x^8 + x^6 + x^5 + x^4 + 1 defined in FIPS 202.
    out, r = [], 1
    for _ in range(_ROUNDS):
        rc = 0
        for j in range(7):
            r = ((r << 1) ^ ((r >> 7) * 0x71)) % 256
            if r & 2:
                rc |= 1 << ((1 << j) - 1)
        out.append(rc)
    return out


def _rotation_offsets() -> list[list[int]]:
    rot = [[0] * 5 for _ in range(5)]
    x, y = 1, 0
    for t in range(24):
        rot[x][y] = ((t + 1) * (t + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return rot


_RC = _round_constants()
_ROT = _rotation_offsets()


def _rotl(v: int, n: int) -> int:
    return ((v << n) | (v >> (64 - n))) & _MASK64 if n else v


def _keccak_f(a: list[list[int]]) -> None:
    for rc in _RC:
        c = [a[x][0] ^ a[x][1] ^ a[x][2] ^ a[x][3] ^ a[x][4] for x in range(5)]
        d = [c[(x - 1) % 5] ^ _rotl(c[(x + 1) % 5], 1) for x in range(5)]
        for x in range(5):
            for y in range(5):
                a[x][y] ^= d[x]
        b = [[0] * 5 for _ in range(5)]
        for x in range(5):
            for y in range(5):
                b[y][(2 * x + 3 * y) % 5] = _rotl(a[x][y], _ROT[x][y])
        for x in range(5):
            for y in range(5):
                a[x][y] = b[x][y] ^ ((~b[(x + 1) % 5][y]) & b[(x + 2) % 5][y])
        a[0][0] ^= rc


def keccak256_hex(data: bytes) -> str:
    rate = 136
    msg = bytearray(data)
    msg.append(0x01)
    while len(msg) % rate:
        msg.append(0)
    msg[-1] |= 0x80
    a = [[0] * 5 for _ in range(5)]
    for off in range(0, len(msg), rate):
        block = msg[off:off + rate]
        for i in range(rate // 8):
            x, y = i % 5, i // 5
            a[x][y] ^= int.from_bytes(block[8 * i:8 * i + 8], "little")
        _keccak_f(a)
    out = b"".join(a[i % 5][i // 5].to_bytes(8, "little") for i in range(4))
    return out.hex()


@F.pandas_udf(T.StringType())
def keccak_selector(sig: pd.Series) -> pd.Series:
    """First 8 hex digits of keccak-256 of each signature (4-byte selector)."""
    known = {s: keccak256_hex(s.encode("utf-8"))[:8] for s in sig.dropna().unique()}
    return sig.map(lambda s: known.get(s))
