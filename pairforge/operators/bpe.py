"""Byte-level BPE vocabulary: pre-token counts and merge training (A17, A18);
``vocabulary`` encodes with the result.

* Pre-tokens come from one JVM regex: the byte-level split rule (English
  contractions; letters, digits, other runs, each optionally led by one space;
  whitespace runs, whose last character goes with a word that follows).
* Symbols are written as the hex of their UTF-8 bytes.  In the table of words
  they are numbers (the bytes first, then in the order in which they are made), four
  bytes each, so that the tasks merge and count a whole batch of words at a time.
* Training runs on the distinct pre-token table (pre-aggregated map-side).
  Pair counts are made once and then kept up by differences: of the words that hold
  a merged pair, the pairs before (minus) and after (plus) the merges.  A round is one
  job; the driver receives only the top pairs.  Several merges are applied in one
  round when that provably gives the same result as merging one at a time:
  a candidate is taken only if the merges already taken in the round leave
  its count as it is, and that is strictly greater than every count that
  those merges could create.  Words and counts are written every few rounds; the
  rounds between apply the merges since then to the words written last, those of a
  round together: none of them takes a symbol that another one needs.  So no
  round's plan holds an earlier one: what the driver keeps of a plan doesn't grow.
"""

from __future__ import annotations

import collections

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions import arrays as A
from pairforge.session import written

# White space and the byte-level split rule.  A run of white space
# before a word leaves its last character to the word's side.
SPACE = r"\t-\r \x{85}\p{Z}"
CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"
PRETOKEN_RX = (CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
               + "|[" + SPACE + "]+(?![^" + SPACE + "])|[" + SPACE + "]+")
# Special tokens of the shipped vocabulary, in id order.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
N_BYTES = 256
#: pairs that a task sums up before it hands them on
TASK_PAIRS = 1 << 20


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN_RX), 0)


def pretoken_counts(df: DataFrame, text: str = "text", min_frequency: int = 1) -> DataFrame:
    """``(pretoken, n)`` with ``n >= min_frequency``."""
    toks = df.select(F.explode(pretokens(F.col(text))).alias("pretoken"))
    c = toks.groupBy("pretoken").agg(F.count(F.lit(1)).alias("n"))
    return c.filter(F.col("n") >= min_frequency) if min_frequency > 1 else c


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")


def _numbers(words: DataFrame) -> DataFrame:
    """``(symbols binary, cnt)`` of ``(pretoken, n)``: the UTF-8 bytes as numbers."""
    def numbered(batches):
        for part in A.sliced(batches):
            lengths, symbols = A.byte_strings(part.column(0))
            yield _table(lengths, symbols, part.column(1))
    rows = words.where("pretoken is not null").select(F.encode("pretoken", "UTF-8"), F.col("n").cast("bigint"))
    return rows.mapInArrow(numbered, "symbols binary, cnt bigint")


def _table(lengths: np.ndarray, symbols: np.ndarray, cnt: pa.Array) -> pa.RecordBatch:
    bounds = pa.py_buffer((A.bounds_of(lengths) * 4).astype(np.int32))
    data = pa.py_buffer(symbols.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(cnt), [None, bounds, data]), cnt], names=["symbols", "cnt"])


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owner, symbol) of all symbols of the words."""
    lengths, data = A.byte_strings(column)
    return A.owners(lengths // 4), np.frombuffer(data.tobytes(), dtype=np.int32).astype(np.int64)


def _merge(owner: np.ndarray, symbols: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_symbols`` after merges that don't meet (rows of left, right and made symbol)."""
    keys = A.pair_keys(step[:, 0], step[:, 1])
    order = np.argsort(keys)
    starts = np.zeros(max(int(step.max()), int(symbols.max(initial=0))) + 1, dtype=bool)
    starts[step[:, 0]] = True
    at = np.flatnonzero(starts[symbols[:-1]] & (owner[:-1] == owner[1:]))
    there, which = A.found_in(keys[order], A.pair_keys(symbols[at], symbols[at + 1]))
    at, made = at[there], step[order, 2][which[there]]
    places = A.every_other(at)
    symbols, owner = A.merged(symbols, owner, places, made[np.searchsorted(at, places)])
    return owner, symbols


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their numbers, without sums of 0."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    sums = np.add.reduceat(n, first) if len(first) else n
    return keys[first][sums != 0], sums[sums != 0]


def _pair_counts(words: DataFrame, names: list[str], found) -> DataFrame:
    """(pair, n): the sums of the pairs' keys and numbers that ``found`` makes of a batch's
    owners, symbols and counts."""
    def counted(batches):
        keys = sums = np.zeros(0, dtype=np.int64)

        def told():
            left, right = (pa.array(names).take(pa.array(x)).to_pylist() for x in (keys >> 32, keys & 0xFFFFFFFF))
            pairs = pa.array([f"{a} {b}" for a, b in zip(left, right)], pa.string())
            return pa.RecordBatch.from_arrays([pairs, pa.array(sums, pa.int64())], names=["pair", "n"])
        for part in A.sliced(batches):
            more = [found(*_symbols(part.column(0)), np.asarray(part.column(1)))]
            keys, sums = _sums(*(np.concatenate(x) for x in zip((keys, sums), *more)))
            if len(keys) > TASK_PAIRS:
                yield told()
                keys = sums = keys[:0]
        yield told()
    return words.mapInArrow(counted, "pair string, n bigint")


def _keys(owner: np.ndarray, symbols: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    beside = owner[:-1] == owner[1:]
    return A.pair_keys(symbols[:-1][beside], symbols[1:][beside]), cnt[owner[:-1][beside]]


def _pairs(words: DataFrame, names: list[str]) -> DataFrame:
    return _summed(_pair_counts(words, names, _keys))


def merge_symbols(symbols: list[str], ranks: dict[tuple[str, str], list[int]]) -> list[str]:
    """The symbols of a word after all merges, one after the other by rank: the plain form of what
    the queries do with whole batches."""
    done = -1
    while True:
        step = min(((rank, pair) for pair in zip(symbols, symbols[1:]) for rank in ranks.get(pair, ()) if rank > done),
                   default=None)
        if step is None:
            return symbols
        done, (left, right) = step
        out, i = [], 0
        while i < len(symbols):
            both = symbols[i] == left and i + 1 < len(symbols) and symbols[i + 1] == right
            out.append(left + right if both else symbols[i])
            i += 2 if both else 1
        symbols = out


def _ranks(merges: list[tuple[str, str]]) -> dict[tuple[str, str], list[int]]:
    ranks = collections.defaultdict(list)
    for rank, pair in enumerate(merges):
        ranks[pair].append(rank)
    return dict(ranks)


def _changes(words: DataFrame, steps: list[np.ndarray], names: list[str]) -> DataFrame:
    """(pair, n) of the words that hold a merged pair: lost pairs count minus, new ones plus."""
    def changed(owner, symbols, cnt):
        owner_after, after = owner, symbols
        for step in steps:
            owner_after, after = _merge(owner_after, after, step)
        shorter = np.bincount(owner_after, minlength=len(cnt)) < np.bincount(owner, minlength=len(cnt))
        lost, kept = shorter[owner], shorter[owner_after]
        minus, plus = _keys(owner[lost], symbols[lost], -cnt), _keys(owner_after[kept], after[kept], cnt)
        return _sums(*(np.concatenate(x) for x in zip(minus, plus)))
    return _pair_counts(words, names, changed)


def _rewritten(words: DataFrame, steps: list[np.ndarray]) -> DataFrame:
    """The words after the merges."""
    def rewrite(batches):
        for part in A.sliced(batches):
            owner, symbols = _symbols(part.column(0))
            for step in steps:
                owner, symbols = _merge(owner, symbols, step)
            yield _table(np.bincount(owner, minlength=len(part)), symbols, part.column(1))
    return words.mapInArrow(rewrite, "symbols binary, cnt bigint")


def _choose(top: list[tuple[str, int]], min_frequency: int, budget: int,
            truncated: bool) -> list[tuple[str, str]]:
    """Merges of one round (see module doc).  ``top`` is sorted by count
    desc, pair asc; when ``truncated``, a pair not listed has a count <= the
    last listed one, so later picks must beat that too.

    Merging (a, b) can only raise the count of new pairs (x, ab) and
    (ab, y), bounded by the counts of (x, a) and (b, y).  It takes
    occurrences only from pairs that end with a or begin with b: an
    occurrence of (a, y) or (x, b) beside it keeps its symbols.  Every other
    pair keeps its count.  A later candidate must not end with the left or
    begin with the right of a merge taken, and must beat that bound strictly."""
    if not top or top[0][1] < min_frequency:
        return []
    floor = top[-1][1]
    split = [(p.split(" "), n) for p, n in top]
    chosen, lefts, rights, bound = [], set(), set(), 0
    for (left, right), n in split:
        if len(chosen) >= budget or n < min_frequency:
            break
        if chosen:
            if left in rights or right in lefts:
                break
            if n <= bound or (truncated and n <= floor):
                break
        chosen.append((left, right))
        lefts.add(left)
        rights.add(right)
        # a symbol merged with itself makes the new pair (aa, aa) as well
        bound = max([m for (l2, r2), m in split
                     if (r2 == left or l2 == right) and ((l2, r2) != (left, right) or left == right)]
                    + [bound])
    return chosen


def _together(step: list[tuple[str, str]], numbers: dict[str, int]) -> list[np.ndarray]:
    """The merges of a round in numbers, in groups that can be made at once: a merge of a symbol that
    one before it makes (it may be known already, from other parts) opens a new group."""
    groups, made = [[]], set()
    for left, right in step:
        if left in made or right in made:
            groups, made = [*groups, []], set()
        groups[-1].append((numbers[left], numbers[right], numbers.setdefault(left + right, len(numbers))))
        made.add(left + right)
    return [np.array(g) for g in groups]


def train_bpe(words: DataFrame, vocab_size: int, min_frequency: int = 2, top_k: int = 2000,
              checkpoint_every: int = 8, max_rounds: int | None = None,
              max_per_round: int | None = None) -> list[tuple[str, str]]:
    """Ordered merges ``[(left, right), ...]`` learnt from ``words``
    (``pretoken``, ``n``).  The vocabulary is the special tokens, the 256
    byte symbols and one token per merge, up to ``vocab_size``."""
    spark = words.sparkSession
    budget = vocab_size - len(SPECIAL_TOKENS) - N_BYTES
    # dealt anew: whole words are few and the merging of each takes long
    state = written(_numbers(words.repartition(spark.sparkContext.defaultParallelism)), "bpe-words")
    numbers = {f"{b:02X}": b for b in range(N_BYTES)}
    counts = written(_pairs(state, list(numbers)), "bpe-pairs")
    merges: list[tuple[str, str]] = []
    pending: list[np.ndarray] = []  # the merges since the tables were written, in groups
    rounds = 0
    while len(merges) < budget and (max_rounds is None or rounds < max_rounds):
        if rounds and rounds % checkpoint_every == 0:
            counts = written(_summed(counts.unionByName(_changes(state, pending, list(numbers)))), "bpe-pairs")
            state = written(_rewritten(state, pending), "bpe-words")
            pending = []
        now = _summed(counts.unionByName(_changes(state, pending, list(numbers)))) if pending else counts
        top = [(r.pair, r.n) for r in now.orderBy(F.desc("n"), F.asc("pair")).limit(top_k).collect()]
        room = budget - len(merges) if max_per_round is None else min(max_per_round, budget - len(merges))
        step = _choose(top, min_frequency, room, len(top) >= top_k)
        if not step:
            break
        merges.extend(step)
        pending.extend(_together(step, numbers))
        rounds += 1
    return merges


def vocabulary(merges: list[tuple[str, str]]) -> list[str]:
    """Token strings by id: specials, byte symbols, merged symbols."""
    return SPECIAL_TOKENS + [f"{b:02X}" for b in range(N_BYTES)] + [l + r for l, r in merges]


def merges_frame(spark: SparkSession, merges: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(i, l, r, l + r) for i, (l, r) in enumerate(merges)],
                                 "rank int, left string, right string, token string")


def symbol_text(hex_col: Column) -> Column:
    """Readable form of a (merged) symbol: its bytes as UTF-8; a partial
    character shows as U+FFFD."""
    return F.make_valid_utf8(F.unhex(hex_col).cast("string"))
