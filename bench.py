"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; each query is written to the ``noop`` sink (full execution, no
output cost).  All queries run once to warm up, then each $BENCH_RUNS times; the median
is reported.

Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termlens.plans import catalog as C  # noqa: E402
from termlens.session import build_session  # noqa: E402

HEADLINE = [
    "extract_raw",             # flagship: keyterms + offsets + fragments (contexts)
    "extract_analyzed_porter", # analysed mode: Porter terms, word windows
    "keyterms_per_doc",        # background counts + top-k per document
    "tokens_with_offsets",     # tokeniser with positions and offsets
    "background_df",           # document frequency per term
    "cross_field_hits",        # keyterms of one field located in another
    "significant_terms_by_group",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="termlens-bench")
    spark.conf.set(C.SCAN_PARTITIONS, str(2 * cpus))  # the tables are files of one row group
    times: dict[str, float] = {}
    for name in names:  # warm-up pass over every query first (JIT, Python workers, caches)
        C.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        fn = C.QUERIES[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_docs = docs.count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "documents": n_docs,
        "flagship_docs_per_sec": round(n_docs / times["extract_raw"], 1) if "extract_raw" in times else None,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
