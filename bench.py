"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query runs to completion through the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_render_plain", "content_hash", "dedupe_first", "seeded_split", "load_splits", "manifest_counts",
    "disjointness", "prompt_leakage", "batch_plan", "conv_pairs", "chat_history", "truncate_tokens",
    "prompt_reference", "generate", "bleu_score", "rouge_l", "compare_systems", "throughput", "stream_dedupe",
    "doc_bleu_score", "doc_compare_systems",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    from quire import queries as Q
    from quire.session import get_spark

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):      # stage times: scripts/stage_times.py <dir>
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = get_spark(cpus=cpus, shuffle_partitions=max(8, cpus * 2), extra=extra)
    # warm-up on the smallest tables: JVM JIT, codegen, regexes, Python workers
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("text_preview", "seeded_split", "generate", "bleu_score", "rouge_l", "stream_dedupe"):
        Q.SPARK_QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        Q.SPARK_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    pairs = 2 * Q.SPARK_QUERIES["conv_pairs"](spark, sf_dir).count()     # two systems scored

    def rate(rows, name):
        return round(rows / times[name], 1) if times.get(name) else None

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    out = {"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
           "sf": float(m.group(1)) if m else None, "cpus": cpus,
           "prepare_rows_per_sec": rate(docs, "load_splits"),
           "bleu_pairs_per_sec": rate(pairs, "bleu_score"),
           "rouge_pairs_per_sec": rate(pairs, "rouge_l")}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
