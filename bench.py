"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 5). Each query runs once to warm up, then BENCH_REPEATS
times; the median wall time is reported. Results are fully computed through the
``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarterlens.plans import registry  # noqa: E402
from quarterlens.session import build_session  # noqa: E402

HEADLINE = ["sentiment_stats", "asof_tol7", "index_snapshot", "training_table",
            "quarter_end_prices", "earnings_features", "section_dispatch", "qoq_change",
            "change_on_day", "member_explode"]


def cpu_calibration() -> float:
    """Seconds for a fixed pure-Python loop: a yardstick of this machine's speed at
    bench time (shared machines vary by 2x or more), not part of the metric."""
    t0 = time.perf_counter()
    s = 0
    for i in range(5_000_000):
        s += i
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    calibration = cpu_calibration()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g",
                                 # the tables are single files: one scan task each
                                 "quarterlens.spreadPartitions": str(cpus)})
    registry.load_all()
    times = {}
    for name in HEADLINE:
        q = registry.QUERIES[name]
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "cpu_calibration_sec": calibration}))


if __name__ == "__main__":
    main()
