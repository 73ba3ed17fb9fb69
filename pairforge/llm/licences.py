"""Licences of files: TF-IDF cosine of headers, windows and licence files to templates, then inheritance.

A licence has several templates: its notices, its text (or the opening of a
long one), statements that name it, its SPDX line.  Of every text these units
are compared with the templates by the cosine of sparse TF-IDF vectors: the
header (the lines before the first blank one), the whole text of a file that
is named as a licence file, and every run of as many words as a template has,
across line breaks.  Lines, comment marks and wrapping don't matter, as only
ASCII letters and digits make words.

Words are weighted by their document frequency in all texts: that of template
words is counted exactly, that of any other word is that of its hash bucket
(``BUCKETS``), so that the weights have a fixed size.  A unit at the threshold
holds one of a template's few heavy words, and a run's cosine is at most its
dot product over the root of its words' squared weights; both bounds are
exact and only skip what can't reach the threshold.

A file's own licence is that of its best unit.  A file without one takes that
of the licence file in the nearest directory above it, by a join of
directories with their ancestors.

Defined cases (see also ``common``): null text has no units; a null path has
no directory and inherits nothing; of equal scores the earlier line counts,
then the longer template, then the first name; a reservation of rights counts
only where no licence is found; no rows: an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import U64, byte_texts, save, word_hashes
from pairforge.llm.licence_texts import RESERVED, templates as all_templates

THRESHOLD = 0.9
#: counters of words outside the templates
BUCKETS = 1 << 18

# The word characters 0-9 and a-z (A-Z lowered); all other bytes part words.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-][a-z0-9.-]*)?$"
_LICENCE_NAME = re.compile(_LICENCE_FILE)


def terms(text: bytes | str) -> list[bytes]:
    return (text.encode() if isinstance(text, str) else text).translate(_FOLD).split()


def _bucket(words: list[bytes]) -> np.ndarray:
    return (word_hashes(words) & U64(BUCKETS - 1)).astype(np.int64)


class Weights:
    """Inverse document frequencies: exact for the templates' words, by bucket for others."""

    def __init__(self, total: int, known: dict[bytes, int], buckets: np.ndarray):
        self.total, self.buckets = total, buckets
        self.known = {t: float(self._idf(n)) for t, n in known.items()}

    def _idf(self, count):
        return np.log((self.total + 1) / (np.asarray(count, dtype=np.float64) + 1)) + 1

    def of(self, words: list[bytes]) -> np.ndarray:
        exact = np.array([self.known.get(w, -1.0) for w in words])
        other = np.flatnonzero(exact < 0)
        if len(other):
            exact[other] = self._idf(self.buckets[_bucket([words[i] for i in other])])
        return exact


class _Template:
    def __init__(self, name: str, text: str, weights: Weights, threshold: float):
        counts = Counter(terms(text))
        words = sorted(counts)
        raw = np.array([counts[w] for w in words]) * weights.of(words)
        self.name, self.size, self.reserved = name, sum(counts.values()), name in RESERVED
        self.vector = dict(zip(words, (raw / math.sqrt(float(raw @ raw))).tolist(), strict=True))
        self.anchors: set[bytes] = set()
        rest = 1.0
        for word, weight in sorted(self.vector.items(), key=lambda x: (-x[1], x[0])):
            # without the anchors a unit's cosine is at most the norm of the other weights
            if rest < threshold * threshold - 1e-9:
                break
            self.anchors.add(word)
            rest -= weight * weight


class _Text:
    """A text's words as numbers, with their weights and lines."""

    def __init__(self, text: bytes, weights: Weights):
        lines = [terms(line) for line in text.split(b"\n")]
        self.ends = np.cumsum([len(line) for line in lines])
        words = [word for line in lines for word in line]
        self.numbers: dict[bytes, int] = {}
        self.words = np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words], dtype=np.int64)
        self.idf = weights.of(list(self.numbers))
        squares = self.idf[self.words] ** 2
        self.squares = np.concatenate([[0.0], np.cumsum(squares)])
        leading = next((i for i, line in enumerate(lines) if not line and i and self.ends[i]), len(lines))
        self.header = int(self.ends[leading - 1])

    def line(self, start: int) -> int:
        return int(np.searchsorted(self.ends, start, "right"))

    def gains(self, template: _Template) -> np.ndarray:
        """What each distinct word adds to the dot product with the template."""
        out = np.zeros(len(self.idf))
        for word, weight in template.vector.items():
            number = self.numbers.get(word)
            if number is not None:
                out[number] = weight * self.idf[number]
        return out

    def cosine(self, gains: np.ndarray, start: int, end: int) -> float:
        numbers, counts = np.unique(self.words[start:end], return_counts=True)
        weights = counts * self.idf[numbers]
        norm = math.sqrt(float(weights @ weights))
        return min(1.0, float(counts @ gains[numbers]) / norm) if norm else 0.0

    def best_run(self, template: _Template, gains: np.ndarray, floor: float) -> tuple[float, int] | None:
        """(cosine, start) of the best run of the template's length from ``floor`` on, the earliest of equal ones."""
        size = min(template.size, len(self.words))
        dots = np.concatenate([[0.0], np.cumsum(gains[self.words])])
        dots, squares = dots[size:] - dots[:len(dots) - size], self.squares[size:] - self.squares[:len(dots) - size]
        bounds = dots / np.sqrt(np.maximum(squares, 1e-12))
        near = np.flatnonzero(bounds >= floor - 1e-9)
        found: tuple[float, int] | None = None
        for start in near[np.argsort(-bounds[near], kind="stable")].tolist():
            if found and bounds[start] < found[0] - 1e-9:
                break
            score = self.cosine(gains, start, start + size)
            if score >= floor - 1e-12 and (found is None or score > found[0] + 1e-12
                                           or (score > found[0] - 1e-12 and start < found[1])):
                found = score, start
        return found


class LicenceMatcher:
    """The templates as unit vectors; ``best`` finds a text's best unit."""

    def __init__(self, texts: dict[str, list[str]], weights: Weights, threshold: float):
        self.weights, self.threshold = weights, threshold
        self.templates = [_Template(n, t, weights, threshold) for n in sorted(texts) for t in texts[n]]
        self.anchors = frozenset().union(*(t.anchors for t in self.templates))

    def best(self, text: bytes, licence_file: bool = False) -> tuple[str | None, float, int | None, str | None]:
        """(licence, cosine, line from 0, unit) of the best unit at the threshold, or (None, 0, None, None)."""
        if self.anchors.isdisjoint(terms(text)):
            return None, 0.0, None, None
        held = _Text(text, self.weights)
        found: list[tuple] = []
        for template in self.templates:
            if template.anchors.isdisjoint(held.numbers):
                continue
            gains = held.gains(template)
            run = held.best_run(template, gains, self.threshold)
            units = [(run[0], run[1], "window")] if run else []
            units.append((held.cosine(gains, 0, held.header), 0, "header"))
            if licence_file:
                units.append((held.cosine(gains, 0, len(held.words)), 0, "file"))
            found += [(template.reserved, -round(score, 9), held.line(start), -template.size, template.name, kind)
                      for score, start, kind in units if score >= self.threshold - 1e-12]
        if not found:
            return None, 0.0, None, None
        _, score, line, _, name, kind = min(found)
        return name, -score, line, kind


def _matcher(texts: dict[str, list[str]], weights: Weights, threshold: float):
    def match(batches):
        matcher = LicenceMatcher(texts, weights, threshold)
        for batch in batches:
            paths = batch.column("path").to_pylist()
            best = [matcher.best(t, bool(p and _LICENCE_NAME.match(p.rsplit("/", 1)[-1])))
                    for t, p in zip(byte_texts(batch.column("text")), paths, strict=True)]
            name, score, line, unit = zip(*best, strict=True) if best else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(paths, pa.string()), pa.array(name, pa.string()),
                 pa.array(score, pa.float64()), pa.array(line, pa.int64()), pa.array(unit, pa.string())],
                names=["doc_id", "path", "own_licence", "score", "line", "unit"])
    return match


def _counter(vocabulary: list[bytes]):
    """Texts that hold each template word (slots below 0) and a word of each bucket, and all texts (slot -1)."""
    slots = {word: -2 - i for i, word in enumerate(vocabulary)}

    def count(batches):
        known, buckets, total = Counter(), np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            total += batch.num_rows
            for text in byte_texts(batch.column("text")):
                words = set(terms(text))
                shared = words & slots.keys()
                known.update(shared)
                buckets[np.unique(_bucket(list(words - shared)))] += 1
        used = np.flatnonzero(buckets)
        keys = [-1, *(slots[w] for w in known), *used.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()),
                                          pa.array([total, *known.values(), *buckets[used].tolist()], pa.int64())],
                                         names=["slot", "n"])
    return count


def document_frequencies(files: DataFrame, texts: dict[str, list[str]]) -> Weights:
    """Word weights from all texts; what comes to the driver is one number per
    template word and bucket, at any size of the corpus."""
    vocabulary = sorted({word for each in texts.values() for text in each for word in terms(text)})
    counts = (files.select("text").mapInArrow(_counter(vocabulary), "slot bigint, n bigint")
              .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    slots, n = (counts.column(c).to_numpy() for c in ("slot", "n"))
    buckets = np.zeros(BUCKETS, dtype=np.int64)
    buckets[slots[slots >= 0]] = n[slots >= 0]
    held = dict(zip(slots[slots < 0].tolist(), n[slots < 0].tolist(), strict=True))
    return Weights(held.get(-1, 0), {w: held.get(-2 - i, 0) for i, w in enumerate(vocabulary)}, buckets)


def _folder(path):
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan_licences(files: DataFrame, texts: dict[str, list[str]] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per file: doc_id, path, own_licence, score, line, unit (header,
    window or file), licence (own or inherited) and licence_folder (the directory
    it was inherited from, else null).

    ``files``: doc_id, path (with ``/``), text; ``texts``: licence -> templates."""
    texts = texts or all_templates()
    rows = files.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "path", "text")
    match = _matcher(texts, document_frequencies(rows, texts), threshold)
    own = save(rows.mapInArrow(match, "doc_id bigint, path string, own_licence string, score double, line bigint, "
                               "unit string").withColumn("folder", _folder(F.col("path"))), "licences")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    granted = (own.where(name.rlike(_LICENCE_FILE) & F.col("own_licence").isNotNull()).groupBy("folder")
               .agg(F.max(F.struct("score", F.negative("doc_id").alias("back"), "own_licence"))["own_licence"]
                    .alias("granted")))
    parts = F.split("folder", "/")
    above = own.where("folder is not null").select("folder").distinct().select("folder", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))).alias("a"))
    nearest = (above.select("folder", "a.depth", "a.above").join(granted.withColumnRenamed("folder", "above"), "above")
               .groupBy("folder").agg(F.max(F.struct("depth", "above", "granted")).alias("best"))
               .select("folder", F.col("best.granted").alias("granted"), F.col("best.above").alias("licence_folder")))
    return (own.join(nearest, "folder", "left")
            .select("doc_id", "path", "own_licence", "score", "line", "unit",
                    F.coalesce("own_licence", "granted").alias("licence"),
                    F.when(F.col("own_licence").isNull(), F.col("licence_folder")).alias("licence_folder")))
