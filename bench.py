"""Benchmark: run the headline queries end to end and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3).  Each query is executed fully with
the ``noop`` sink (no collect to the driver): one warm-up run, then the
warm-up).  ``cold`` records each query's first (warm-up) run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "transfer_balance", "txn", "rule_join", "date_formats", "txn_amounts", "dup_flag", "drop_duplicates",
    "surrogate_key", "latest", "two_latest", "last_batches", "set_agg", "set_flag", "merge_delete",
    "key_rewrite", "producer_balance", "div_sub", "conform_union", "prefix_join", "raw_load",
    "plan", "partition_merge", "transform_load", "split_valid",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ledgerflow.bindings.registry import QUERIES
    from ledgerflow.session import local_session

    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="ledgerflow-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times, cold = {}, {}
    for name in HEADLINE:
        cold[name] = round(run(name), 3)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
        "method": f"median of {runs} runs after 1 warm-up run per query",
        "cold_total_sec": round(sum(cold.values()), 3), "cold": cold,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
