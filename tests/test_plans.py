"""Plan properties the scale design relies on."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_time_window_reaches_the_scan(spark):
    plan = plan_of(E.queries()["test_set"](spark, SF_SMALL))
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))
    assert "GreaterThanOrEqual(timestamp" in pushed


def test_no_cross_or_nested_loop_joins(spark):
    for name in ("train_set", "test_set", "split_leakage_check", "get_scores", "item_categories",
                 "session_size_histogram", "item_activity_bins", "eval_predictions_parsed"):
        plan = plan_of(E.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(E.queries()["events_per_item"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s == "itemid:bigint" for s in schemas), schemas


def test_single_partition_exchanges_are_bounded(spark):
    """Single-partition exchanges carry partial aggregates (one row a task), per-partition
    counts, or top-n rows; never event-sized rows."""
    for name in ("inter_event_gaps", "clicks_between_carts", "clicks_between_orders", "session_event_arrays",
                 "ground_truth_events", "trimmed_sessions", "test_labels", "split_test_set", "get_scores",
                 "event_gap", "session_boundary", "train_set", "test_set"):
        lines = plan_of(E.queries()[name](spark, SF_SMALL)).splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                below = " ".join(lines[i + 1:i + 4])
                assert "partial_" in below or "_part" in below or "Subquery" in below, (name, line, below)


def test_tree_join_gets_distinct_items(spark):
    from cartpath.operators.catalog import anchor_bounds, item_categories
    from cartpath.sources.driver import category_tree, item_properties
    train = spark.createDataFrame([(1_800_000_000,)], "timestamp long")
    plan = plan_of(item_categories(item_properties(spark, SF_SMALL), category_tree(spark, SF_SMALL), anchor_bounds(train, 4000, 0)))
    join = plan.index("Join")
    assert re.search(r"HashAggregate\(keys=\[itemid#\d+L?, categoryid#\d+L?\], functions=\[\]", plan[join:]), plan


def test_steps_read_the_sessions_once(spark, tmp_path):
    """The train set is scanned once, while the ordered rows are written."""
    from cartpath.operators.profile import clicks_between_carts
    path = str(tmp_path / "train")
    E.queries()["train_set"](spark, SF_SMALL).write.parquet(path)
    df = clicks_between_carts(spark.read.parquet(path))
    assert path not in plan_of(df)
