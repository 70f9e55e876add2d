"""Skew stress: one visitor holds a third of all events.

    python scripts/skew_stress.py [rows] [scratch_dir]

Generates a synthetic click log with Spark (one hot visitor with 1/3 of the rows, the rest
spread over many visitors, 30 days), writes it as parquet to the scratch folder, then times
the per-visitor session number of every event two ways:

* ``bucketed``: ``cartpath.operators.sessions.session_buckets`` joined to the events
  (partial aggregate per (visitor, bucket), window over bucket rows, one join);
* ``naive``: one ordered window partitioned by visitor (the hot visitor's rows all go to
  one task).

Both must give the same session numbers. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def naive_mark(events, gap):
    w = Window.partitionBy("visitorid").orderBy("timestamp", "seq")
    gaps = events.withColumn("gap", F.col("timestamp") - F.lag("timestamp").over(w))
    brk = (F.col("gap").isNull() | (F.col("gap") >= gap)).cast("long")
    return gaps.withColumn("local_session", F.sum(brk).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def main():
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from cartpath.config import local_session
    from cartpath.operators.sessions import bucket_width, session_buckets, time_bucket

    def bucketed(events, gap):
        bk = session_buckets(events, gap).select("visitorid", "_tb", "local_session")
        rows = events.withColumn("_tb", time_bucket("timestamp", bucket_width(gap)))
        return rows.join(bk, ["visitorid", "_tb"])

    spark = local_session(cpus=8, shuffle_partitions=64)
    spark.sparkContext.setLogLevel("ERROR")
    span = 30 * 86400
    ev = spark.range(rows).select(
        F.col("id").alias("seq"),
        # hot visitor 0 gets every third event; the others are spread over 200k visitors
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 200_000).alias("visitorid"),
        (F.abs(F.xxhash64("id")) % span).alias("timestamp"),
        F.lit("view").alias("event"), (F.col("id") % 1000).alias("itemid"))
    path = f"{scratch}/stress-events"
    ev.write.mode("overwrite").parquet(path)
    events = spark.read.parquet(path)

    out = {"rows": rows, "hot_share": 1 / 3}
    variants = {"bucketed": lambda: bucketed(events, 1800), "naive": lambda: naive_mark(events, 1800)}
    for name in ("naive", "bucketed", "naive", "bucketed"):  # alternate; keep the best run
        t0 = time.perf_counter()
        variants[name]().select("seq", "local_session").write.mode("overwrite").parquet(f"{scratch}/stress-{name}")
        sec = round(time.perf_counter() - t0, 2)
        out[f"{name}_sec"] = min(sec, out.get(f"{name}_sec", sec))
    a = spark.read.parquet(f"{scratch}/stress-bucketed")
    b = spark.read.parquet(f"{scratch}/stress-naive")
    out["mismatches"] = a.join(b, "seq").where(a["local_session"] != b["local_session"]).count()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
