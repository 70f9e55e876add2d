"""Queries of the file sources and sinks: a table derived from the provided data is
written to a fresh folder below the checkpoint root and read back with the library's
reader; the oracle is the same table without the file step."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import scratch_path
from ..functions.columns import ids_text
from ..operators.catalog import anchor_bounds, item_categories
from ..sources import files, sinks
from ..sources.driver import category_tree, item_properties, raw_click_log
from . import oracle as O
from .inputs import GAP_LONG, GAP_SHORT
from .inputs import sessions as sessions_of
from .inputs import split
from .q_eval import scored_inputs
from .q_labels import cut
from .registry import register


def _labels_text(df):
    return df.select("session", ids_text(F.col("addtocart")).alias("addtocart"),
                     ids_text(F.col("transaction")).alias("transaction"))


def src_events(spark, d):
    path = scratch_path(spark, "click-log")
    sinks.write_csv(raw_click_log(spark, d), path)
    return files.read_click_log(spark, path)


def src_sessions(spark, d):
    path = scratch_path(spark, "sessions-csv")
    sinks.write_sessions(sessions_of(spark, d, GAP_SHORT), path)
    return files.read_sessions(spark, path)


def src_category_tree(spark, d):
    path = scratch_path(spark, "category-tree")
    sinks.write_csv(category_tree(spark, d), path)
    return files.read_category_tree(spark, path)


def src_item_properties(spark, d):
    """Two part files (category rows and all other rows: together the whole table), read
    back in one scan."""
    props = item_properties(spark, d)
    p1, p2 = scratch_path(spark, "item-properties-part1"), scratch_path(spark, "item-properties-part2")
    is_category = F.col("property") == "categoryid"
    sinks.write_csv(props.where(is_category), p1)
    sinks.write_csv(props.where(~is_category), p2)
    return files.read_item_properties(spark, [p1, p2])


def eval_labels_parsed(spark, d):
    path = scratch_path(spark, "labels-json")
    sinks.write_labels(cut(spark, d)[1], path)
    return _labels_text(files.read_labels(spark, path))


def eval_predictions_parsed(spark, d):
    path = scratch_path(spark, "predictions-csv")
    sinks.write_predictions(scored_inputs(spark, d)[1], path)
    preds = files.read_predictions(spark, path)
    return preds.select("session", "event_type",
                        F.array_join(F.transform("preds", lambda x: x.cast("string")), " ").alias("preds"))


def sink_sessions_roundtrip(spark, d):
    train, test = split(spark, d, GAP_SHORT)
    p_train, p_test = scratch_path(spark, "train-set"), scratch_path(spark, "test-set")
    sinks.write_sessions(train, p_train)
    sinks.write_sessions(test, p_test)
    return (files.read_sessions(spark, p_train).withColumn("part", F.lit("train"))
            .unionByName(files.read_sessions(spark, p_test).withColumn("part", F.lit("test"))))


def sink_item_categories_roundtrip(spark, d):
    train = split(spark, d, GAP_SHORT)[0]
    cats = item_categories(item_properties(spark, d), category_tree(spark, d), anchor_bounds(train))
    path = scratch_path(spark, "item-categories")
    sinks.write_item_categories(cats, path)
    return files.read_item_categories(spark, path)


def sink_trimmed_sessions_roundtrip(spark, d):
    path = scratch_path(spark, "trimmed-sessions")
    sinks.write_trimmed_sessions(cut(spark, d)[0], path)
    return files.read_trimmed_sessions(spark, path)


def sink_trimmed_session_lists_roundtrip(spark, d):
    """Lists of at most three events: most sessions go on in further lines."""
    path = scratch_path(spark, "trimmed-session-lists")
    sinks.write_trimmed_session_lists(cut(spark, d)[0], path, 3)
    return files.read_trimmed_session_lists(spark, path)


def sink_labels_roundtrip(spark, d):
    """Raw read of the written labels: absent keys come back as nulls."""
    path = scratch_path(spark, "labels-json-raw")
    sinks.write_labels(cut(spark, d)[1], path)
    from .. import schemas
    raw = spark.read.schema(schemas.LABELS_JSON).json(path)
    return raw.select("session", ids_text(F.col("labels.addtocart")).alias("addtocart"),
                      ids_text(F.col("labels.transaction")).alias("transaction"))


q = O.Q(); O.events(q)
register("src_events", q.sql(
    "SELECT timestamp, visitorid, event, CAST(itemid AS VARCHAR) AS itemid, transactionid FROM ev"))(src_events)

q = O.Q(); s = O.sessions(q, GAP_SHORT)
register("src_sessions", q.sql(f"SELECT timestamp, event, itemid, session, seq FROM {s}"))(src_sessions)

q = O.Q(); O.tree(q)
register("src_category_tree", q.sql("SELECT categoryid, parentid FROM tree"))(src_category_tree)

q = O.Q(); O.item_props(q)
register("src_item_properties", q.sql(
    "SELECT timestamp // 1000 AS timestamp, itemid, property, value FROM props"))(src_item_properties)

q = O.Q(); n = O.cut(q, GAP_LONG)
_LABELS_SQL = q.sql(f"""
SELECT session, {O.ids_text('addtocart')} AS addtocart, {O.ids_text('transaction')} AS transaction
FROM {n['labels']}""")
register("eval_labels_parsed", _LABELS_SQL)(eval_labels_parsed)
register("sink_labels_roundtrip", _LABELS_SQL)(sink_labels_roundtrip)

q = O.Q(); n = O.fixture_predictions(q, GAP_LONG)
register("eval_predictions_parsed", q.sql(f"""
SELECT session, event_type, string_agg(CAST(itemid AS VARCHAR), ' ' ORDER BY rank) AS preds
FROM {n['pred']} GROUP BY session, event_type"""))(eval_predictions_parsed)

q = O.Q(); n = O.split(q, GAP_SHORT)
register("sink_sessions_roundtrip", q.sql(f"""
SELECT timestamp, event, itemid, session, seq, 'train' AS part FROM {n['train']}
UNION ALL SELECT timestamp, event, itemid, session, seq, 'test' AS part FROM {n['test']}"""))(sink_sessions_roundtrip)

q = O.Q(); n = O.categories(q, GAP_SHORT)
register("sink_item_categories_roundtrip", q.sql(
    f"SELECT itemid, categoryid, parentid FROM {n['item_categories']}"))(sink_item_categories_roundtrip)

q = O.Q(); n = O.cut(q, GAP_LONG)
_TRIMMED_SQL = q.sql(f"SELECT session, pos, itemid, timestamp, event FROM {n['trimmed']}")
register("sink_trimmed_sessions_roundtrip", _TRIMMED_SQL)(sink_trimmed_sessions_roundtrip)
register("sink_trimmed_session_lists_roundtrip", _TRIMMED_SQL)(sink_trimmed_session_lists_roundtrip)
