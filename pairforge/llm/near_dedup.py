"""MinHash near-duplicates with odd sketches.

A document's set holds the hashes of its distinct word shingles.  MinHash
bands propose pairs; the MinHash samples folded into a parity bitmap (an odd
sketch, whose XOR popcount estimates the number of differing samples) discard
proposals that are clearly less similar; the full sets decide.

No step emits all pairs of a group.  Equal sets form one class, of which only
the smallest doc_id is compared.  Every class is first paired with one hub, the
class that meets most others in the bands; after these links are joined into
components, only classes outside a bucket's largest component are compared
with the rest of their bucket, inside a join condition on the sketches.

Defined cases (see also ``common``): no words or null text: empty set, linked
with nothing; fewer words than a shingle: the whole sequence is the only
shingle; no rows: an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import (U64, beside, byte_texts, documents, free_shuffles, gram_hashes, id_array, list_column,
                                  mix, odd_multipliers, save, word_hashes)

SHINGLE = 5
BANDS = 25
ROWS = 5
#: MinHash samples and bits of an odd sketch
SKETCH_SAMPLES = 512
SKETCH_BITS = 1024
#: a proposal is discarded if its popcount exceeds that of the threshold
#: similarity by this many standard deviations
SIGMAS = 4.5
CHUNK = 4096


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of one text (A-Z lower-cased, ASCII white space splits)."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=U64)
    return np.unique(gram_hashes(word_hashes(words), min(shingle, len(words)), seed=31 + min(shingle, len(words))))


def minhash(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    best = np.full(len(multipliers), np.iinfo(U64).max, dtype=U64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), CHUNK):
            np.minimum(best, (shingles[i:i + CHUNK, None] * multipliers).min(axis=0), out=best)
    return best


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        weighted = (samples.reshape(bands, rows) * odd_multipliers(rows, 77)).sum(axis=1, dtype=U64)
        return mix(weighted + mix(np.arange(bands, dtype=U64)))


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmap of the (place, sample) pairs, as 64-bit words."""
    with np.errstate(over="ignore"):
        place = mix(samples ^ mix(np.arange(len(samples), dtype=U64))) % U64(bits)
    parity = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(parity).view(U64)


def popcount_limit(threshold: float, samples: int = SKETCH_SAMPLES, bits: int = SKETCH_BITS) -> int:
    """The XOR popcount that a pair of the threshold similarity exceeds only beyond
    SIGMAS deviations: each sample that differs flips two random bits."""
    flips = 2 * samples * (1 - threshold)
    expected = bits / 2 * (1 - (1 - 2 / bits) ** flips)
    slope = (1 - 2 / bits) ** flips
    sampled = 2 * slope * math.sqrt(samples * threshold * (1 - threshold))
    placed = flips / math.sqrt(2 * bits)
    return math.ceil(expected + SIGMAS * math.hypot(sampled, placed))


def _signer(shingle: int, bands: int, rows: int):
    def sign(batches):
        multipliers = odd_multipliers(bands * rows, 5)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in byte_texts(batch.column("text")):
                found = shingle_set(text, shingle)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(minhash(found, multipliers), bands, rows) if len(found) else found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 list_column(keys)], names=["doc_id", "n_shingles", "digest", "bands"])
    return sign


def _sketcher(shingle: int):
    def sketch(batches):
        multipliers = odd_multipliers(SKETCH_SAMPLES, 9)
        for batch in batches:
            ids, texts = id_array(batch.column("id")), byte_texts(batch.column("text"))
            for i in range(0, len(texts), 500):
                sets = [shingle_set(t, shingle) for t in texts[i:i + 500]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:i + 500]), pa.array([len(s) for s in sets], pa.int64()), list_column(sets),
                     list_column([odd_sketch(minhash(s, multipliers)) for s in sets])],
                    names=["id", "n", "shingles", "sketch"])
    return sketch


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component): the smallest id reachable over the undirected edges (a, b).

    Every round takes the smallest label among a node's neighbours, then the
    label of that label; rounds are written out, and end when no label falls."""
    both = save(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                f"{name}-edges")
    labels = save(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
                  .select("id", F.least("id", "low").alias("component")), f"{name}-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        step = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("far"))
        new = save(step.join(jump, "low", "left")
                   .select("id", F.col("component").alias("was"),
                           F.least("low", F.coalesce("far", "low")).alias("component")), f"{name}-labels")
        changed = not new.where("was <> component").isEmpty()
        labels = new.select("id", "component")
        if not changed:
            return labels


def _xor_popcount(a: str, b: str, words: int):
    parts = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(words)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _alike(threshold_pct: int, limit: int):
    """Sizes allow the threshold, and the odd sketches don't contradict it."""
    return ((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold_pct)
            & (_xor_popcount("sketch_a", "sketch_b", SKETCH_BITS // 64) <= limit))


def _confirm(pairs: DataFrame, sets: DataFrame, threshold_pct: int) -> DataFrame:
    """Pairs whose full sets meet 100 * intersection >= threshold * union.  A busy
    id on one side of the pairs is spread by the skew join."""
    first = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    second = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(first, "b").join(second, "a")
            .where(common * 100 >= threshold_pct * (F.size("set_a") + F.size("set_b") - common))
            .select("a", "b"))


def _first_shared(place: str):
    """The band at ``place`` (0-based) is the first that both sides share."""
    before = F.zip_with(F.slice("bands_a", 1, F.col(place)), F.slice("bands_b", 1, F.col(place)),
                        lambda x, y: x == y)
    return ~F.exists(before, lambda same: same)


def near_duplicates(docs: DataFrame, threshold_pct: int = 85, shingle: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs``: doc_id, text.  Documents are linked if 100 * |A and B| >=
    threshold_pct * |A or B|; component_id is the smallest doc_id reachable."""
    signed = save(documents(docs, "text").mapInArrow(
        _signer(shingle, bands, rows), "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"),
        "near-signed")
    classes = save(signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("id")),
                   "near-classes")
    heads = (signed.dropDuplicates(["doc_id"]).join(classes.select(F.col("id").alias("doc_id")), "doc_id")
             .select(F.col("doc_id").alias("id"), "bands"))
    slim = save(heads.select("id", F.posexplode("bands").alias("place", "band")), "near-bands")
    shared = slim.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = save(slim.join(shared, "band"), "near-members")
    met = members.groupBy("id").agg(F.sum("size").alias("met"))
    texts = documents(docs, "text").withColumnRenamed("doc_id", "id").join(
        beside(met.select("id")), "id", "left_semi")
    sets = save(texts.mapInArrow(_sketcher(shingle), "id bigint, n bigint, shingles array<bigint>, "
                                 "sketch array<bigint>").dropDuplicates(["id"]), "near-sets")
    free_shuffles(docs.sparkSession)

    limit = popcount_limit(threshold_pct / 100)
    sketches = sets.select("id", "n", "sketch")
    side_a = sketches.toDF("a", "n_a", "sketch_a")
    side_b = sketches.toDF("b", "n_b", "sketch_b")
    ranked = members.join(met, "id").select("band", "id", "met")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("met", F.negative("id").alias("back"))).alias("hub"))
    stars = (ranked.join(hubs, "band").where("-hub.back <> id")
             .select((-F.col("hub.back")).alias("a"), F.col("id").alias("b"), F.col("hub.met").alias("met")).distinct())
    likely = save(stars.join(side_b, "b").join(side_a, "a").where(_alike(threshold_pct, limit))
                  .groupBy("b").agg(F.max(F.struct("met", F.negative("a").alias("back"))).alias("best"))
                  .select((-F.col("best.back")).alias("a"), "b"), "near-likely")
    links = save(_confirm(likely, sets, threshold_pct), "near-links")
    components = connected_components(links, "near")

    # classes that their bucket's largest component doesn't hold, against the rest of the bucket
    placed = save(members.select("band", "place", "id").join(components, "id", "left")
                  .select("band", "place", "id", F.coalesce("component", "id").alias("component")), "near-placed")
    parts = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
    main = (parts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
            .where("parts > 1").select("band", F.col("main.component").alias("main")))
    unsettled = placed.join(main, "band").join(sketches, "id").join(heads, "id")
    minor = unsettled.where("component <> main").select(
        "band", "place", "main", F.col("id").alias("a"), F.col("component").alias("of_a"), F.col("n").alias("n_a"),
        F.col("sketch").alias("sketch_a"), F.col("bands").alias("bands_a"))
    rest = unsettled.select(F.col("band").alias("band_b"), F.col("id").alias("b"), F.col("component").alias("of_b"),
                            F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"), F.col("bands").alias("bands_b"))
    later = (minor.join(rest, (F.col("band") == F.col("band_b")) & (F.col("of_a") != F.col("of_b"))
                        & ((F.col("of_b") == F.col("main")) | (F.col("a") < F.col("b")))
                        & _alike(threshold_pct, limit) & _first_shared("place"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    tried = likely.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    later = save(later.join(tried, ["a", "b"], "left_anti"), "near-later")
    if not later.isEmpty():
        components = connected_components(links.union(_confirm(later, sets, threshold_pct)), "near-all")

    classed = (classes.join(components, "id", "left")
               .select("digest", F.coalesce("component", "id").alias("_component")))
    return (signed.select("doc_id", "n_shingles", "digest").join(classed, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("_component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
