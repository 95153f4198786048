"""Benchmark: every registered query on one data directory.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_RUNS (timed runs per query, 3), BENCH_QUERIES (comma list, default all).
Each query runs once to warm up, then BENCH_RUNS times; its value is the
median. Execution goes through the ``noop`` sink, so the whole plan runs and
nothing is collected to the driver. Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verdant.plans import QUERIES  # noqa: E402
from verdant.session import build_session  # noqa: E402


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(QUERIES)
    spark = build_session(f"local[{cpus}]", app="verdant-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            samples = []
            for i in range(runs + 1):
                t = time.perf_counter()
                QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t)
            times[name] = round(statistics.median(samples), 4)
        except Exception as e:  # noqa: BLE001 - report and keep going
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"{name}: {times.get(name, 'FAILED')}", file=sys.stderr, flush=True)
    sf = os.path.basename(data_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
