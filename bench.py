"""Benchmark the headline queries.

Runs each query to completion (noop sink, no collect) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairforge.plans import QUERIES  # noqa: E402
from pairforge.session import build_session  # noqa: E402

HEADLINE = [
    "pair_split_counts",   # J1 + J4 + T1 + A1
    "pos_neg_pairs",       # J4 pairs per second
    "simhash",             # A16 documents per second
    "simhash_pairs",       # J6 + J8 + J9 candidates
    "pack_blocks",         # Z10 tokens per second
    "mlm_mask",            # Z12
    "random_split",        # T2 rows per second
    "min_token_filter",    # P4
    "length_stats",        # A3
    "pretoken_counts",     # A17
    "bpe_train",           # A18 alone (the merges are kept in the table cache)
    "bpe_encode",          # Z1 with the merges of bpe_train
    "extract_source_functions",  # X1-X3, X6
    "stream_append",       # R1-R3
]


def throughput(spark, sf_dir: str, times: dict) -> dict:
    """
    after the timed runs (not part of any timing)."""
    from pyspark.sql import functions as F

    from pairforge.functions.text import word_count
    from pairforge.sources.tables import load
    docs = load(spark, sf_dir, "documents")
    d = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(word_count(F.col("text")) + 2).alias("tok")).collect()[0]
    groups = docs.select("lang", "source").distinct().count()
    conv = load(spark, sf_dir, "conversations").select("conv_id").distinct().count()
    out = {}

    def rate(key, n, q):
        if q in times and times[q] > 0:
            out[key] = round(n / times[q], 1)
    rate("contracts_paired_per_sec", conv, "pos_neg_pairs")
    rate("documents_fingerprinted_per_sec", d["n"], "simhash")
    rate("candidate_draws_per_sec", groups * 26, "simhash_pairs")
    rate("tokens_packed_per_sec", d["tok"], "pack_blocks")
    rate("rows_split_per_sec", d["n"], "random_split")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="pairforge-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # Warm-up on the smallest tables (not timed): JIT and whole-stage codegen
    # compilation happen here, so the timings below are steady-state.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        for name in HEADLINE:
            if name in QUERIES:
                QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        # each query runs on its own: nothing cached by an earlier one is reused
        spark.catalog.clearCache()
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    rates = throughput(spark, sf_dir, times)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "warmup": bool(warm and os.path.isdir(warm)),
                      "throughput": rates}))


if __name__ == "__main__":
    main()
