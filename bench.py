"""Benchmark the headline marts.

Runs each mart over the tables in $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] and prints ONE JSON line with per-query seconds.
Every query is fully computed through Spark's no-op sink (all columns, all
rows, nothing collected to the driver); each is timed from DataFrame
construction (which includes its eager planning jobs) to the end of the run,
three times after a warm-up on the smallest scale, and the median is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("events_mart", "sessions_mart", "users_mart", "products_mart", "event_params_mart")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from clickmarts.catalog import REGISTRY
    from clickmarts.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="clickmarts-bench")
    # Warm-up on the smallest scale: JVM class loading, JIT and Spark's
    # generated-code cache (keyed by code text, so the same plans at sf0.1
    # reuse the compiled classes).  Measurements below are steady state.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            REGISTRY[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    # Each query: build (including its eager planning jobs) and run, three
    # times; the median is reported (single runs vary by +-20% on a shared VM).
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    timings = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(sorted(runs)[len(runs) // 2], 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "marts_total_sec", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
