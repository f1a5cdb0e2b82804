"""Benchmark every registry key; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3, median taken), BENCH_KEYS (comma list, optional).
Each run executes the whole query into Spark's ``noop`` sink, so the time
covers the full plan without driver collection or output files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paceline.plans.queries import all_queries  # noqa: E402
from paceline.session import build_session  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    wanted = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    queries = all_queries()
    if wanted:
        queries = {k: v for k, v in queries.items() if k in wanted}

    run_noop(queries.get("events_per_year", next(iter(queries.values())))(spark, sf_dir))  # warm-up

    timings: dict[str, float] = {}
    for name, q in queries.items():
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run_noop(q(spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
