"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (nothing is pulled
to the driver).  Prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``python bench.py --all`` times every registered query instead.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "doc_tfidf", "top_terms", "pairwise_cosine", "cosine_similarity",
    "pagerank_k5", "graph_verdict", "degree",
    "ridge_sweep", "ridge_fit",
    "logistic_k2", "binary_metrics",
    "mf_k4", "mf_cv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tessera.plans.registry import load_all
    from tessera.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    names = list(queries) if "--all" in sys.argv else [n for n in HEADLINE if n in queries]
    names += [a for a in sys.argv[1:] if not a.startswith("--") and a not in names]

    # warm-up on the smallest tables: JVM start, class loading and JIT of the
    # tokenizer/aggregation paths are not query time
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for w in ("doc_tfidf", "pagerank_k5"):
        queries[w](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
