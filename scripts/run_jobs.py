"""End-to-end run of the file-based jobs on files exported from a provided data set.

    python scripts/run_jobs.py [sf_dir] [scratch_dir]

Exports the click log, category tree and item-property parts derived from ``events`` as
CSV into the scratch folder, then runs split -> cut -> item categories -> stand-in
predictions -> scores, timing each job. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from cartpath.config import local_session
    from cartpath.plans import jobs
    from cartpath.plans.fixtures import predictions
    from cartpath.sources import sinks
    from cartpath.sources.driver import category_tree, item_properties, raw_click_log

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    src, out = f"{scratch}/input", f"{scratch}/generated"
    sinks.write_csv(raw_click_log(spark, sf_dir), f"{src}/events.csv")
    sinks.write_csv(category_tree(spark, sf_dir), f"{src}/category_tree.csv")
    props = item_properties(spark, sf_dir)
    sinks.write_csv(props.where("property = 'categoryid'"), f"{src}/item_properties_part1.csv")
    sinks.write_csv(props.where("property <> 'categoryid'"), f"{src}/item_properties_part2.csv")

    times = {}
    t = time.perf_counter()
    train, test = jobs.prepare_split(spark, f"{src}/events.csv", out, gap_sec=86400)
    times["prepare_split"] = time.perf_counter() - t
    t = time.perf_counter()
    trimmed, labels = jobs.cut_test_sessions(spark, f"{out}/test_set.parquet", out)
    times["cut_test_sessions"] = time.perf_counter() - t
    t = time.perf_counter()
    cats = jobs.build_item_categories(spark, f"{out}/train_set.parquet", src, out)
    times["build_item_categories"] = time.perf_counter() - t
    t = time.perf_counter()
    sinks.write_predictions(predictions(trimmed, train), f"{out}/predictions")
    scores = jobs.score(spark, f"{out}/test_labels", f"{out}/predictions").first().asDict()
    times["predict_and_score"] = time.perf_counter() - t
    print(json.dumps({"sf_dir": sf_dir, "train_rows": train.count(), "test_rows": test.count(),
                      "label_sessions": labels.count(), "item_categories": cats.count(),
                      "scores": {k: round(v, 6) if v is not None else None for k, v in scores.items()},
                      "seconds": {k: round(v, 2) for k, v in times.items()}}))


if __name__ == "__main__":
    main()
