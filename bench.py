"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
(default 8): one warm-up, then the median of ``$BENCH_REPS`` (default 3) runs per
query, each fully executed into the ``noop`` sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "crossover_signals",
    "crossover_by_type",
    "tumbling_avg_10m",
    "window_ma_join",
    "bloom_probe",
    "bloom_verdict",
    "batch_gate",
    "minhash_signature",
    "crossover_stream",
    "tumbling_avg_stream",
    "window_ma_stream",
    "bloom_stream",
    "sentence_gate_stream",
    "batch_gate_stream",
    "batch_local_ma_stream",
    "backfill_dedup_stream",
    "lsh_candidates",
    "jaccard_verified",
    "bloom_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from driftwood.plans import QUERIES
    from driftwood.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up
        times[name] = round(statistics.median(once() for _ in range(reps)), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "reps": reps}))


if __name__ == "__main__":
    main()
