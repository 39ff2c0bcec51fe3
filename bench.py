"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is written to the ``noop`` sink so every row is computed.  One
warm-up pass over all queries, then ``BENCH_RUNS`` measured passes; the
median per query is reported.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans.queries import REGISTRY  # noqa: E402
from starloom.session import get_session  # noqa: E402

HEADLINE = ["fact_production", "interpolate_10min", "enrich_left", "upsert_single",
            "daily_totals", "condition_impact", "load_star", "csv_quarantine", "check_unique"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", "starloom-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.ui.enabled": "false",
                               "spark.ui.showConsoleProgress": "false",
                               "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE if n in REGISTRY]

    def run(name: str) -> float:
        t = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for name in names:  # warm-up pass: JIT, file listings, codegen caches
        run(name)
    times: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):  # measured passes, interleaved
        for name in names:
            times[name].append(run(name))
    results = {n: round(statistics.median(ts), 3) for n, ts in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "median_warm_query_seconds_total",
                      "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
