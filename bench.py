"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (all rows computed, none shipped
to the driver). Every query first runs once on the smallest data set to warm the JVM (JIT,
class loading); that run is not counted. Each query is then timed ``BENCH_RUNS`` times
(default 2) and the best run is kept, which damps noise from other load on the machine.
Prints one JSON line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sessionize",           # events -> sessions (gap 1800 s)
    "test_set",             # train/test split without leakage
    "item_categories",      # item -> category -> parent for the train window
    "split_test_set",       # cut of test sessions, labels (gap one day)
    "get_scores",           # Recall@20 and MRR of the stand-in predictor
    "inter_event_gaps",     # ordered steps inside sessions
    "clicks_between_carts",
    "describe_events_per_item",
    "item_coverage",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("cartpath-bench")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", cpus)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "16g"))
    if os.environ.get("BENCH_EVENT_LOG"):
        log_dir = tempfile.mkdtemp(prefix="cartpath-events-")
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from cartpath.plans.registry import queries
    qs = queries()
    smallest = re.sub(r"sf[0-9.]+$", "sf0.001", sf_dir)
    if os.path.isdir(smallest) and smallest != sf_dir:
        for name in names:
            qs[name](spark, smallest).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            sec = time.perf_counter() - t0
            best = sec if best is None else min(best, sec)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "headline_query_seconds_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
