"""Benchmark: the pipelines timed to a completed action (noop sink).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Prints one JSON line; per-query values are the median
wall time over the runs, taken interleaved after one warm-up pass over all queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallycast import build_session  # noqa: E402
from tallycast import registry  # noqa: E402

# q1..q3 are the original's three queries end to end (q3 = share, then the
# 2 x 4 clustering sweep, keyed output); the others are parts and the
# vector-width form of the sweep.
BENCH = {
    "q1": registry.q1_daily_mean_per_unit,
    "q2": registry.q2_next_month_top_k,
    "q3": registry.q3_cluster_sweep,
    "q3a_forecast_share": registry.q3_forecast_share,
    "embedding_cluster_sweep": registry.embedding_cluster_sweep,
}
HEADLINE = ("q1", "q2", "q3")


def run_once(spark, fn, base: str) -> float:
    t = time.perf_counter()
    fn(spark, base).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallycast-bench-")},
    )
    for fn in BENCH.values():  # warm-up pass: JIT, class loading, file listing
        run_once(spark, fn, base)
    times: dict[str, list[float]] = {name: [] for name in BENCH}
    for _ in range(runs):  # interleaved, so drift and GC do not pile onto one query
        for name, fn in BENCH.items():
            times[name].append(run_once(spark, fn, base))
    results = {name: round(statistics.median(ts), 3) for name, ts in times.items()}
    m = re.search(r"sf([0-9.]+)", base)
    print(json.dumps({
        "metric": "q1_q2_q3_total_median_wall",
        "value": round(sum(results[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
        "conf": {k: spark.conf.get(k) for k in (
            "spark.sql.shuffle.partitions",
            "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.skewJoin.enabled",
            "spark.sql.autoBroadcastJoinThreshold",
        )},
        "timing": "median of interleaved runs after a warm-up pass; plan build + noop write",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
