"""The end-to-end jobs on files written from the provided tables, file layouts, storage."""

import os

import pytest
from pyspark.sql import functions as F

from cartpath.config import checkpoint_root, scratch_path
from cartpath.plans import jobs
from cartpath.plans.fixtures import predictions
from cartpath.sources import files, sinks
from cartpath.sources.driver import category_tree, item_properties, raw_click_log
from conftest import SF_SMALL


def test_jobs_chain(spark):
    src = scratch_path(spark, "job-input")
    sinks.write_csv(raw_click_log(spark, SF_SMALL).coalesce(1), f"{src}/events.csv")
    sinks.write_csv(category_tree(spark, SF_SMALL), f"{src}/category_tree.csv")
    props = item_properties(spark, SF_SMALL)
    sinks.write_csv(props.where("property = 'categoryid'"), f"{src}/item_properties_part1.csv")
    sinks.write_csv(props.where("property <> 'categoryid'"), f"{src}/item_properties_part2.csv")
    out = scratch_path(spark, "job-output")

    root = checkpoint_root(spark).removeprefix("file:") + "/cartpath"
    before = set(os.listdir(root))

    train, test = jobs.prepare_split(spark, f"{src}/events.csv", out, gap_sec=86400)
    assert train.count() > 0 and test.count() > 0
    tr_max = train.agg(F.max("timestamp")).first()[0]
    te_min = test.agg(F.min("timestamp")).first()[0]
    assert te_min > tr_max

    trimmed, labels = jobs.cut_test_sessions(spark, f"{out}/test_set", out)
    assert labels.count() == test.select("session").distinct().count()

    cats = jobs.build_item_categories(spark, f"{out}/train_set", src, out)
    assert cats.count() >= 0

    assert set(os.listdir(root)) - before <= {os.path.basename(out)}  # no intermediate is left

    preds_path = f"{out}/predictions"
    sinks.write_predictions(predictions(trimmed, train), preds_path)
    r = jobs.score(spark, f"{out}/test_labels", preds_path).first()
    for v in (r.recall_cart, r.recall_order, r.mrr_cart, r.mrr_order):
        assert v is None or 0.0 <= v <= 1.0


def test_cleanup_removes_written_tables(spark):
    from cartpath.functions.materialize import materialize, temporary
    root = checkpoint_root(spark).removeprefix("file:") + "/cartpath"
    kept = materialize(spark.range(3), "kept")
    with temporary(spark):
        materialize(spark.range(5), "gone")
        assert any(x.startswith("gone-") for x in os.listdir(root))
    assert not any(x.startswith("gone-") for x in os.listdir(root)) and kept.count() == 3
    with pytest.raises(ZeroDivisionError), temporary(spark):
        materialize(spark.range(5), "gone")
        raise ZeroDivisionError
    assert not any(x.startswith("gone-") for x in os.listdir(root))


def test_cluster_without_checkpoint_folder_raises():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def write(path, text):
    path.write_text(text)
    return str(path)


def test_both_session_layouts(spark, tmp_path):
    plain = write(tmp_path / "a.csv", "timestamp,event,itemid,session\n5,view,17,2\n")
    with_seq = write(tmp_path / "b.csv", "timestamp,event,itemid,session,seq\n5,view,17,2,9\n")
    text = write(tmp_path / "c.csv", "timestamp,event,itemid,session\n5,view,sku-17,2\n")
    assert files.read_sessions(spark, plain).collect() == [(5, "view", 17, 2)]
    assert files.read_sessions(spark, with_seq).collect() == [(5, "view", 17, 2, 9)]
    assert files.read_sessions(spark, text, text_items=True).collect() == [(5, "view", "sku-17", 2)]
    with pytest.raises(Exception):
        files.read_sessions(spark, text).collect()


def test_swapped_header_raises(spark, tmp_path):
    good = write(tmp_path / "good.csv", "categoryid,parentid\n4,1\n")
    swapped = write(tmp_path / "swapped.csv", "parentid,categoryid\n1,4\n")
    assert files.read_category_tree(spark, good).collect() == [(4, 1)]
    with pytest.raises(Exception):
        files.read_category_tree(spark, swapped).collect()


def test_trimmed_sessions_as_lists(spark, tmp_path):
    path = write(tmp_path / "t.json", '{"session": 8, "events": [{"itemid": 3, "timestamp": 10, "event": "view"}, '
                 '{"itemid": 4, "timestamp": 12, "event": "addtocart"}]}\n{"session": 9, "events": []}\n')
    rows = files.read_trimmed_session_lists(spark, path).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [(8, 0, 3, 10, "view"), (8, 1, 4, 12, "addtocart")]


def test_split_job_with_text_items(spark, tmp_path):
    week = 604800
    lines = ["timestamp,visitorid,event,itemid,transactionid"]
    for visitor, base in ((1, 10 * week), (2, 11 * week + 500)):
        lines += [f"{base * 1000},{visitor},view,sku-{visitor},", f"{(base + 60) * 1000},{visitor},addtocart,sku-{visitor},"]
    path = write(tmp_path / "events.csv", "\n".join(lines) + "\n")
    train, test = jobs.prepare_split(spark, path, str(tmp_path / "out"), 1, 1)
    assert {r.itemid for r in train.collect()} == {"sku-1"} and {r.itemid for r in test.collect()} == {"sku-2"}
    again = files.read_sessions(spark, str(tmp_path / "out" / "train_set"), text_items=True)
    assert again.count() == 2 and again.columns == ["timestamp", "event", "itemid", "session"]
