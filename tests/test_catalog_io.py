"""Item categories (root, unknown, time-versioned, duplicate tree rows) and file formats."""

from pyspark.sql import functions as F

from cartpath.config import scratch_path
from cartpath.operators.catalog import anchor_bounds, item_categories
from cartpath.sources import files, sinks

PROPS = "timestamp long, itemid long, property string, value string"
TREE = "categoryid long, parentid long"


def cats(spark, props, tree, train_ts):
    p = spark.createDataFrame(props, PROPS)
    t = spark.createDataFrame(tree, TREE)
    train = spark.createDataFrame([(x,) for x in train_ts], "timestamp long")
    return sorted(tuple(r) for r in item_categories(p, t, anchor_bounds(train, 1, 1)).collect())


def test_parent_root_unknown_and_window(spark):
    w = 604800
    anchor = 10 * w
    inside = (anchor - w - 100) * 1000  # ms, inside [anchor - 2w, anchor - w)
    before = (anchor - 3 * w) * 1000
    props = [(inside, 1, "categoryid", "5"), (inside, 2, "categoryid", "0"), (inside, 3, "categoryid", "99"),
             (inside + 5000, 1, "categoryid", "6"), (before, 4, "categoryid", "5"), (inside, 5, "available", "1")]
    tree = [(0, None), (5, 1), (6, 2)]
    assert cats(spark, props, tree, [anchor - 5, anchor]) == [(1, 5, 1), (1, 6, 2), (2, 0, 0), (3, 99, 99)]


def test_duplicate_tree_rows_multiply_then_distinct(spark):
    w = 604800
    anchor = 10 * w
    inside = (anchor - w - 100) * 1000
    props = [(inside, 1, "categoryid", "5"), (inside + 1000, 1, "categoryid", "5")]
    assert cats(spark, props, [(5, 1), (5, 1), (5, 2)], [anchor]) == [(1, 5, 1), (1, 5, 2)]


def test_predictions_file_roundtrip(spark):
    path = scratch_path(spark, "test-preds")
    preds = spark.createDataFrame([(12, "addtocart", [5, 9, 2]), (12, "transaction", []), (3, "addtocart", [7])],
                                  "session long, event_type string, preds array<long>")
    sinks.write_predictions(preds, path)
    back = {(r.session, r.event_type): r.preds for r in files.read_predictions(spark, path).collect()}
    assert back == {(12, "addtocart"): [5, 9, 2], (12, "transaction"): [], (3, "addtocart"): [7]}


def test_labels_file_omits_empty_types(spark):
    path = scratch_path(spark, "test-labels")
    labels = spark.createDataFrame([(12, [5], None), (13, None, None), (14, [1, 2], [3])],
                                   "session long, addtocart array<long>, transaction array<long>")
    sinks.write_labels(labels, path)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert '"session":12,"labels":{"addtocart":[5]}' in text
    assert '"session":13,"labels":{}' in text
    back = {r.session: (r.addtocart, r.transaction) for r in files.read_labels(spark, path).collect()}
    assert back == {12: ([5], None), 13: (None, None), 14: ([1, 2], [3])}


def test_click_log_reads_ms_and_failfast(spark):
    good = scratch_path(spark, "test-clicks")
    df = spark.createDataFrame([(1433221332117, 257597, "view", "355908", None)],
                               "timestamp long, visitorid long, event string, itemid string, transactionid long")
    sinks.write_csv(df, good)
    r = files.read_click_log(spark, good).first()
    assert (r.timestamp, r.visitorid, r.itemid) == (1433221332, 257597, "355908")
    bad = scratch_path(spark, "test-clicks-bad")
    spark.createDataFrame([("x", "y")], "timestamp string, visitorid string").write.option("header", True).csv(bad)
    try:
        files.read_click_log(spark, bad).collect()
        raised = False
    except Exception:
        raised = True
    assert raised
    assert F is not None


def test_cluster_settings_scale_with_input():
    from cartpath.config import cluster_settings
    small, big = cluster_settings(10 << 30), cluster_settings(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_session_table_without_item_raises(spark):
    import pytest
    path = scratch_path(spark, "test-sessions-null-item")
    df = spark.createDataFrame([(1, "view", None, 1, 0), (2, "addtocart", 5, 1, 1)],
                               "timestamp long, event string, itemid long, session long, seq long")
    sinks.write_sessions(df, path)
    with pytest.raises(Exception):
        files.read_sessions(spark, path).collect()
    ok = scratch_path(spark, "test-sessions-ok")
    sinks.write_sessions(df.where("itemid IS NOT NULL"), ok)
    assert files.read_sessions(spark, ok).count() == 1


def test_describe_exact_and_approx(spark):
    from cartpath.operators.profile import describe
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "x double")
    r = describe(df, "x").first()
    assert (r["count"], r["null_count"], r["min"], r["q25"], r["q50"], r["max"]) == (4, 0, 1.0, 1.75, 2.5, 10.0)
    a = describe(df, "x", approx=True).first()
    assert a["count"] == 4 and {a["q25"], a["q50"], a["q75"]} <= {1.0, 2.0, 3.0, 10.0}
    assert a["q25"] <= a["q50"] <= a["q75"]
