"""Best-two-fit packing of tokenized documents into sequences.

A document's tokens end with ``end_id``; only longer documents than a sequence
are cut, into whole sequences with the remainder first.  A plan needs only
how many pieces there are of each length: bins are filled greedily, longest
first, then the smallest piece of a bin gives way to the two unpacked pieces
that fit the widened gap most tightly.  A bin that can be repeated is planned
once with its multiplicity, so planning costs follow the number of lengths (at
most the sequence length), not the number of documents.  Pieces get a rank
within their length (counted by salted groups, so a busy length is no single
task) and the rank names bin and offset.

Defined cases (see also ``common``): a null or empty text is the end token
alone; no rows: an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import documents, id_array, save

SEQUENCE = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: pieces ranked by one task at most, on average
RANK_ROWS = 50_000
#: a worker forgets its encodings when they pass so many bytes; longer chunks aren't kept
CACHE_BYTES, KEPT_CHARS, ENTRY_BYTES = 256 << 20, 64, 200
#: characters of text encoded together
BATCH_CHARS = 2_000_000

#: the byte-level split rule begins a new piece at a space before a visible character
_SPLIT = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
#: chunks of Latin letters, plain stops and single line breaks, and their pieces by that rule
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ.,;:!?]+(?:\n[A-Za-zÀ-ÖØ-öø-ÿ.,;:!?]+)*")
_PIECE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,;:!?]+|\n")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def tokenizer_path(name: str) -> str:
    if os.path.exists(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class _Chunks(dict):
    """chunk -> token ids as bytes; a chunk not met yet is encoded by the short way or,
    where that doesn't hold, by the tokenizer."""

    def __init__(self, encoder: "ChunkEncoder", prefix: str):
        super().__init__({"": b""} if not prefix else {})
        self.encoder, self.prefix, self.size = encoder, prefix, 0

    def __missing__(self, chunk: str) -> bytes:
        encoder = self.encoder
        if encoder.plain and chunk.isalpha() and chunk.isascii():
            ids = encoder.piece(self.prefix + chunk)
        elif encoder.plain and _PLAIN.fullmatch(chunk):
            pieces = _PIECE.findall(chunk)
            pieces[0] = self.prefix + pieces[0]
            ids = b"".join(map(encoder.piece, pieces))
        else:
            ids = array("I", encoder._tokenizer.encode(self.prefix + chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= KEPT_CHARS:
            self[chunk] = ids
            self.size += ENTRY_BYTES + len(chunk) + len(ids)
        return ids


class _Pieces(dict):
    """piece -> token ids as bytes, by the model alone."""

    def __init__(self, model):
        super().__init__()
        self.model, self.size = model, 0

    def __missing__(self, piece: str) -> bytes:
        if not piece.isascii():
            mapped = piece.encode().decode("latin-1").translate(_LETTERS)
        else:
            mapped = piece.replace(" ", "Ġ").replace("\n", "Ċ")
        ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        if len(piece) <= KEPT_CHARS:
            self[piece] = ids
            self.size += ENTRY_BYTES + len(piece) + len(ids)
        return ids


class ChunkEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The tokenizer's split rule never joins over a space that stands before a
    visible character, so a text's ids are those of its chunks between such
    spaces: one look-up per chunk, and a chunk is encoded when it is first met."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(tokenizer_path(tokenizer))
        self._forget()
        # the short way holds for a plain byte-level tokenizer; others take whole chunks through the pipeline
        probe = "Ab, cé.\nD"
        self.plain = (self._tokenizer.normalizer is None and b"".join(map(self.piece, ("Ab", ",", " cé", ".", "\n", "D")))
                      == array("I", self._tokenizer.encode(probe, add_special_tokens=False).ids).tobytes())

    def _forget(self) -> None:
        self._first, self._rest, self._pieces = _Chunks(self, ""), _Chunks(self, " "), _Pieces(self._tokenizer.model)
        self.piece = self._pieces.__getitem__

    def encode(self, texts: list[str]) -> list[bytes]:
        if self._first.size + self._rest.size + self._pieces.size > CACHE_BYTES:
            self._forget()
        first, rest, join = self._first, self._rest.__getitem__, b"".join
        out = []
        for text in texts:
            chunks = text.split(" ") if not _ODD_SPACE.search(text) else _SPLIT.split(text)
            head = first[chunks[0]]
            del chunks[0]
            out.append(head + join(map(rest, chunks)))
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(tokenizer: str) -> ChunkEncoder:
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = ChunkEncoder(tokenizer)
    return _ENCODERS[tokenizer]


def _groups(texts: list[str]):
    """Ranges of texts of a bounded number of characters each."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= BATCH_CHARS:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _cutter(tokenizer: str, sequence: int, end_id: int):
    end = array("I", [end_id]).tobytes()

    def cut(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            ids = id_array(batch.column("doc_id")).tolist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _groups(texts):
                out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
                for doc_id, tokens in zip(ids[a:b], encoder.encode(texts[a:b]), strict=True):
                    tokens = memoryview(tokens + end)
                    total = len(tokens) // 4
                    stop = (total - 1) % sequence + 1
                    start = piece = 0
                    while start < total:
                        out["doc_id"].append(doc_id)
                        out["piece"].append(piece)
                        out["start"].append(start)
                        out["length"].append(stop - start)
                        out["ids_crc32"].append(zlib.crc32(tokens[4 * start:4 * stop]))
                        start, stop, piece = stop, stop + sequence, piece + 1
                yield pa.RecordBatch.from_pydict(out, schema=_PIECES)
    return cut


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (multiplicity, [(length, copies), ...]) for ``counts`` pieces of each length.

    Each bin is what best-two-fit makes next; it is repeated while the pieces
    that it saw are still there, which leaves every choice the same."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = sorted(length for length, n in counts.items() if n)
    plan = []
    while lengths:
        gap, greedy = size, {}
        top = len(lengths)
        while top := bisect_right(lengths, gap, hi=top):
            length = lengths[top - 1]
            copies = min(gap // length, int(left[length]))
            greedy[length] = copies
            gap -= copies * length
            top -= 1
        used = dict(greedy)
        if sum(greedy.values()) > 1 and gap:
            small = min(greedy)
            spare = left.copy()
            for length, copies in greedy.items():
                spare[length] -= copies
            room = gap + small
            there = np.where(spare[:room + 1] > 0, np.arange(room + 1), 0)
            below = np.maximum.accumulate(there)
            a = np.flatnonzero(there)
            b = below[np.minimum(room - a, a)]
            twin = (a == b) & (spare[a] < 2)
            b = np.where(twin, below[np.maximum(a - 1, 0)], b)
            sums = np.where(b > 0, a + b, 0)
            if len(a) and sums.max() > small:
                best = int(len(sums) - 1 - np.argmax(sums[::-1]))
                used[small] -= 1
                for length in (int(a[best]), int(b[best])):
                    used[length] = used.get(length, 0) + 1
        used = {length: copies for length, copies in used.items() if copies}
        seen = {length: max(greedy.get(length, 0), used.get(length, 0)) for length in greedy.keys() | used.keys()}
        times = min((int(left[length]) - seen[length]) // copies + 1 for length, copies in used.items())
        plan.append((times, sorted(used.items(), reverse=True)))
        for length, copies in used.items():
            left[length] -= times * copies
        lengths = [length for length in lengths if left[length]]
    return plan


def _places(plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, copies per bin, offset) of each part of the plan."""
    rows, taken, sequence = [], {}, 0
    for times, parts in plan:
        offset = 0
        for length, copies in parts:
            low = taken.get(length, 0)
            taken[length] = low + times * copies
            rows.append((length, low, low + times * copies - 1, sequence, copies, offset))
            offset += length * copies
        sequence += times
    return rows


def pack(docs: DataFrame, sequence: int = SEQUENCE, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is a tokenizer file or the name of an installed public one."""
    spark = docs.sparkSession
    pieces = save(documents(docs, "text").mapInArrow(
        _cutter(tokenizer, sequence, end_id),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(16, sum(counts.values()) // RANK_ROWS)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
              .drop("n"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    ranked = (salted.withColumn("own", own).join(before, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("own") - 1).drop("salt", "own", "before"))
    # at most a few rows per length, whatever the number of documents: small enough to broadcast
    places = spark.createDataFrame(_places(best_two_fit(counts, sequence)),
                                   "at bigint, low bigint, high bigint, base bigint, copies bigint, shift bigint")
    place = F.col("rank") - F.col("low")
    return (ranked.join(F.broadcast(places), (F.col("length") == F.col("at")) & F.col("rank").between(
                F.col("low"), F.col("high")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("base") + F.floor(place / F.col("copies"))).alias("sequence_id"),
                    (F.col("shift") + F.pmod(place, F.col("copies")) * F.col("length")).alias("offset")))
