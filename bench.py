"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line. Each query is executed in full with a ``noop``
write (no driver collect), ``$BENCH_REPEAT`` times (default 2); its time is
the best run (first runs are reported too). The value is the sum over the
headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["fact_orders", "dedupe_latest", "q_ingredient_frequency", "upsert", "vector_topk",
            "quality_report"]


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = argv[1:]
    from brickyard.plans.registry import QUERIES
    from brickyard.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="brickyard-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus))),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up (not timed): JVM class loading / codegen and the Python worker pool
    spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).write.format("noop").mode("overwrite").save()

    def _touch(it):
        import numpy  # noqa: F401
        import pandas  # noqa: F401
        yield from it

    spark.range(0, cpus * 4, numPartitions=cpus * 2).mapInPandas(_touch, "id long") \
        .write.format("noop").mode("overwrite").save()
    todo = keys or list(QUERIES)
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for k in todo:
        runs = []
        for _ in range(repeat):   # best of N: steady state, less host noise
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - t0, 3))
        times[k], first[k] = min(runs), runs[0]
        print(f"# {k}: {runs}", file=sys.stderr, flush=True)
    head = [k for k in HEADLINE if k in times] or list(times)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times[k] for k in head), 3),
                      "unit": "sec", "queries": times, "headline": head,
                      "all_total_sec": round(sum(times.values()), 3), "first_run": first,
                      "repeat": repeat, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
