"""Headline-query timings.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully materialised (``noop`` sink, so no column is
pruned away) ``BENCH_REPEATS`` times; the median wall time is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["priced_usage", "workspace_baseline", "cluster_scores", "rolling_baseline", "backtest_results",
            "alerts_to_send", "backtest_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE

    from spendwatch.session import local_session
    from spendwatch.plans.registry import queries

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="spendwatch-bench")
    qs = queries()
    # Warm-up: JVM start, class loading, parquet footers.
    qs["usage_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_query_seconds_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
