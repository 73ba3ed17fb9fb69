"""Benchmark passages in documents: q-gram lemma filter, then banded alignment.

Texts are compared lower-cased with white space runs as one space.  An item of
m characters may be met with k = rate * m edits.  Such a meeting shares at
least m - q + 1 - k * q character q-grams with the item, on diagonals within
k of each other; so the shared q-grams are counted in overlapping diagonal
bands, regions that reach the bound are kept, and an alignment inside the
region's band decides.

Many items may begin with the same words, and a document that holds only
those shares enough q-grams with each of them.  So a region must pass two more
tests before it is aligned, both exact: disjoint short grams of the item that
the text around the region lacks need an edit each (tested for all regions of
a stretch of text at once), and the item's best place in the region, by a
bit-parallel edit distance, must lie within the edits.  Shared q-grams are
expanded for blocks of items, ``HITS`` at a time.

The items travel in blocks of a bounded number of characters; a larger
benchmark means more passes over the documents, not larger ones.

Defined cases (see also ``common``): items without text, or blank, are met by
nothing; null document texts meet nothing; repeated items each count; no rows
on either side: an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import U64, documents, mix, odd_multipliers, save

#: edits per character of an item
RATE = 0.1
GRAM = 8
#: characters of items in one pass
BLOCK_CHARS = 2_000_000
#: bits of the first look-up table
_TABLE = 22
#: characters of documents compared at once
CHUNK_CHARS = 200_000
#: shared q-grams expanded at once, for documents of one chunk
HITS = 2_000_000
#: characters of the short grams, and of the stretches of text whose short grams are looked up together
_SHORT, _STRETCH = 4, 256


def normal(text: str | None) -> np.ndarray:
    return np.frombuffer(" ".join((text or "").lower().split()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` characters, by doubling."""
    if len(codes) < size:
        return np.empty(0, dtype=U64)
    with np.errstate(over="ignore"):
        acc, done = mix(codes.astype(U64)) if size < 4 else codes.astype(U64) * _STEPS[0], 1
        while done < size:
            ahead = min(done, size - done)
            acc = acc[:len(acc) - ahead] * _STEPS[done.bit_length()] + acc[ahead:]
            done += ahead
        acc ^= acc >> U64(32)
        return acc * _STEPS[0]


_STEPS = odd_multipliers(64, 606)


_SHORT_BITS = 16


def _short_grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``_SHORT`` characters; equal ones only hide an edit, never invent one."""
    return (_grams(codes, _SHORT) >> U64(64 - _SHORT_BITS)).astype(np.uint16)


def least_edits(item: np.ndarray, text: np.ndarray) -> int:
    """The fewest edits between the item and any run of the text: a column of the
    edit table as two bit masks in whole numbers, one step for each character."""
    size = len(item)
    masks: dict[int, int] = {}
    for i, code in enumerate(item.tolist()):
        masks[code] = masks.get(code, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    least = size
    for code in text.tolist():
        same = masks.get(code, 0)
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full  # a run may begin anywhere: no cost at the top
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal
        least = min(least, score)
    return least


class _GramTable:
    """Where each q-gram of the items stands."""

    def __init__(self, items: list[tuple[int, np.ndarray]], gram: int):
        self.gram = gram
        hashes = [_grams(codes, gram) for _, codes in items]
        which = np.repeat([i for i, _ in items], [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = which[order].astype(np.int64), place[order]
        self.hashes, self.low, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.there = np.zeros(1 << _TABLE, dtype=bool)
        self.there[(self.hashes >> U64(64 - _TABLE)).astype(np.int64)] = True
        #: gram and item of each posting in one ascending number
        self.items = int(self.item.max()) + 1
        self.posting = np.repeat(np.arange(len(self.hashes)), self.count) * self.items + self.item

    def hits(self, codes: np.ndarray):
        """(place in the document, item, place in the item) of the shared q-grams,
        at most about ``HITS`` at once: all of an item's together."""
        grams = _grams(codes, self.gram)
        at = np.flatnonzero(self.there[(grams >> U64(64 - _TABLE)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        real = self.hashes[found] == grams[at]
        at, found = at[real], found[real]
        blocks = min(self.items, 1 + int(self.count[found].sum()) // HITS)
        cuts = np.linspace(0, self.items, blocks + 1).astype(np.int64)
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            low, counts = self.low[found], self.count[found]
            if blocks > 1:
                low = np.searchsorted(self.posting, found * self.items + first)
                counts = np.searchsorted(self.posting, found * self.items + last) - low
            picked = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            yield np.repeat(at, counts), self.item[picked], self.place[picked]


class ItemIndex:
    def __init__(self, items: list[tuple[int, str]], rate: float, gram: int):
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        self.codes = [normal(t) for _, t in items]
        self.sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.budgets = np.floor(self.sizes * rate).astype(np.int64)
        grams = np.maximum(1, np.minimum(gram, self.sizes // (self.budgets + 1)))
        self.bounds = self.sizes - grams + 1 - self.budgets * grams
        self.short = np.zeros((len(items), max(_SHORT, -int(-self.sizes.max(initial=0) // _SHORT) * _SHORT)), dtype=np.uint16)
        for row, codes in zip(self.short, self.codes, strict=True):
            held = _short_grams(codes)
            row[:len(held)] = held
        self.tables = []
        for q in sorted({int(q) for q, size in zip(grams, self.sizes, strict=True) if size}, reverse=True):
            self.tables.append(_GramTable([(i, c) for i, c in enumerate(self.codes) if len(c) and grams[i] == q], q))

    def _affordable(self, short: np.ndarray, group: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which bands (document and item in ``group``, first diagonal counted from
        minus the item's size) may hold the item within its edits: each of a set of
        disjoint short grams that the text there lacks needs an edit of its own.
        The text looked at covers the band's diagonals and its edits on either side."""
        items = group % len(self.sizes)
        sizes, budgets = self.sizes[items], self.budgets[items]
        low = first - sizes - budgets  # first text place
        high = first + 2 * (budgets + 1) + budgets  # end of the last diagonal's text
        stretch = low // _STRETCH
        reach = (high - stretch * _STRETCH + _STRETCH - 1) // _STRETCH
        keep = np.ones(len(group), dtype=bool)
        order = np.lexsort((reach, stretch))
        cuts = np.flatnonzero(np.diff(stretch[order], prepend=-1 << 40) | np.diff(reach[order], prepend=-1))
        present = np.zeros(1 << _SHORT_BITS, dtype=bool)
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
            here = order[begin:end]
            origin = int(stretch[here[0]]) * _STRETCH
            grams = short[max(0, origin):max(0, origin + int(reach[here[0]]) * _STRETCH)]
            present[grams] = True
            for part in np.array_split(here, 1 + len(here) // 4096):
                missing = ~present[self.short[items[part]]]
                missing &= np.arange(missing.shape[1]) < (sizes[part] - _SHORT + 1)[:, None]
                # grams at places that are equal modulo their size are disjoint
                needed = missing.reshape(len(part), -1, _SHORT).sum(axis=1).max(axis=1)
                keep[part] = needed <= budgets[part]
            present[grams] = False
        return keep

    def regions(self, codes: np.ndarray, bounds: np.ndarray):
        """(document number, item, first, last and busiest diagonal) of the bands that
        reach the q-gram bound, neighbouring ones as one; ``bounds``: the documents'
        ends in ``codes``."""
        short = None
        for at, item, place, table in ((*hit, t) for t in self.tables for hit in t.hits(codes)):
            doc = np.searchsorted(bounds, at, "right")
            same = at + table.gram <= bounds[doc] if len(at) else np.empty(0, dtype=bool)
            item, place, at, doc = item[same], place[same], at[same], doc[same]
            if not len(at):
                continue
            step = self.budgets[item] + 1
            diagonal = at - place + self.sizes[item]
            band = diagonal // step
            # every diagonal lies in two bands of 2 * step diagonals that start a step apart
            wide, bands = int(2 * step.max()), int(band.max()) + 2
            group = (doc * len(self.sizes) + item) * bands
            within = diagonal - band * step
            full = np.concatenate([(group + band + 1) * wide + within, (group + band) * wide + within + step])
            full.sort()
            key = full // wide
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.concatenate([starts, [len(key)]]))
            group = key[starts] // bands
            chosen = np.flatnonzero(counts >= self.bounds[group % len(self.sizes)])
            first = (key[starts[chosen]] % bands - 1) * (self.budgets[group[chosen] % len(self.sizes)] + 1)
            if not len(chosen):
                continue
            if short is None:
                short = _short_grams(codes)
            chosen = chosen[self._affordable(short, group[chosen], first)]
            k = 0
            while k < len(chosen):
                run = [chosen[k]]
                while k + 1 < len(chosen) and len(run) < 3 and key[starts[chosen[k + 1]]] == key[starts[run[-1]]] + 1 \
                        and group[chosen[k + 1]] == group[run[0]]:
                    k += 1
                    run.append(chosen[k])
                k += 1
                i, d = int(group[run[0]] % len(self.sizes)), int(group[run[0]] // len(self.sizes))
                pace, first = int(self.budgets[i]) + 1, int(key[starts[run[0]]] % bands) - 1
                busy = max(run, key=lambda r: counts[r])
                places, often = np.unique(full[starts[busy]:starts[busy] + counts[busy]] % wide, return_counts=True)
                shift = -int(self.sizes[i])
                yield (d, i, first * pace + shift, (first + len(run) + 1) * pace - 1 + shift,
                       (int(key[starts[busy]] % bands) - 1) * pace + int(places[np.argmax(often)]) + shift)


def banded_edits(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the item's best place in the text whose path keeps to
    the diagonals low - budget to high + budget, or None beyond the budget.  Of
    equal places the first end and its latest start count."""
    left, width = low - budget, high - low + 2 * budget + 1
    far = 1 << 30
    lanes = np.arange(width)
    columns = left + lanes
    cost = np.where((columns >= 0) & (columns <= len(text)), 0, far)
    begin = columns.copy()
    for i, code in enumerate(item.tolist()):
        column = left + i + lanes  # text characters before the diagonal step
        inside = (column >= 0) & (column < len(text))
        same = np.zeros(width, dtype=bool)
        same[inside] = text[column[inside]] == code
        new = np.where(inside, cost + ~same, far)
        from_above = np.concatenate([cost[1:], [far]]) + 1  # the item's character has no partner
        take = from_above < new
        new = np.where(take, from_above, new)
        start = np.where(take, np.concatenate([begin[1:], [0]]), begin)
        slid = new - lanes  # a text character has no partner: lane by lane, one more each
        best = np.minimum.accumulate(slid)
        source = np.maximum.accumulate(np.where(slid == best, lanes, 0))
        ok = (column + 1 >= 0) & (column + 1 <= len(text))
        cost = np.where(ok, np.minimum(best + lanes, far), far)
        begin = start[source]
        if cost.min() > budget:
            return None
    lane = int(np.argmin(cost))
    return int(cost[lane]), int(begin[lane]), int(left + len(item) + lane)


def _matches(index: ItemIndex, ids: list, texts: list) -> list[dict]:
    bounds = np.cumsum([len(t) for t in texts])
    codes = np.concatenate(texts) if texts else np.empty(0, dtype=np.uint32)
    best: dict[tuple, tuple] = {}
    for doc, i, low, high, busy in index.regions(codes, bounds):
        origin = int(bounds[doc]) - len(texts[doc])
        item, text, at = index.codes[i], texts[doc], busy - origin
        if 0 <= at and np.array_equal(text[at:at + len(item)], item):  # nothing aligns better
            found = (0, at, at + len(item))
        else:
            budget = int(index.budgets[i])
            low, high = low - origin, high - origin
            near = text[max(0, low - budget):max(0, high + 2 * budget + len(item) + 1)]
            found = banded_edits(item, text, low, high, budget) if least_edits(item, near) <= budget else None
        if found:
            key = (doc, i, found[1] // max(1, int(index.sizes[i])))
            best[key] = min(best.get(key, found), found)
    rows = []
    for (doc, i, _), (edits, start, end) in sorted(best.items()):
        rows.append({"doc_id": ids[doc], "item_id": int(index.ids[i]), "start": start, "end": end, "edits": edits})
    return rows


_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                    ("edits", pa.int64())])


def _matcher(items: list[tuple[int, str]], rate: float, gram: int):
    def match(batches):
        index = ItemIndex(items, rate, gram)
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(normal(text))
                held += len(texts[-1])
                if held >= CHUNK_CHARS:
                    yield pa.RecordBatch.from_pylist(_matches(index, ids, texts), schema=_MATCH)
                    ids, texts, held = [], [], 0
            yield pa.RecordBatch.from_pylist(_matches(index, ids, texts), schema=_MATCH)
    return match


def contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, gram: int = GRAM) -> DataFrame:
    """One row per document and benchmark passage in it: doc_id, item_id, start and
    end (in the normalized text), edits.

    ``docs``: doc_id, text; ``benchmark``: item_id, text."""
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    out = None
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        held = sorted((r["item_id"], r["text"]) for r in part.collect())
        found = documents(docs, "text").mapInArrow(
            _matcher(held, rate, gram), "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint")
        found = found if blocks == 1 else save(found, "contamination")
        out = found if out is None else out.unionByName(found)
    return out
