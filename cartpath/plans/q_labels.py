"""Queries of ground truth and test-session cutting (gap one day, 3 train / 2 test weeks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import ids_text
from ..functions.materialize import materialize
from ..operators.labels import (cut_rows, ground_truth_counts, ground_truth_sets, label_index, points_of, session_event_lists,
                                session_positions, split_points, test_labels, trimmed_sessions, whole_sets)
from . import oracle as O
from .inputs import GAP_LONG as G
from .inputs import split
from .registry import register


def test_set(spark, d):
    return split(spark, d, G)[1]


def cut(spark, d):
    """(trimmed events, labels, split points) of the test set. The cut rows (positions and
    split index) are written once: trimmed events and labels both read them, so positions
    are computed in one pass."""
    rows = materialize(cut_rows(test_set(spark, d)), "cut-rows")
    return trimmed_sessions(rows), test_labels(rows, points_of(rows)), points_of(rows)


def labels_text(labels):
    return labels.select("session", ids_text(F.col("addtocart")).alias("addtocart"),
                         ids_text(F.col("transaction")).alias("transaction"))


q = O.Q(); n = O.cut(q, G)
register("session_event_arrays", q.sql(
    f"SELECT session, pos, itemid, timestamp, event FROM {n['pos']}"))(
    lambda spark, d: session_positions(test_set(spark, d)).select("session", "pos", "itemid", "timestamp", "event"))

q = O.Q(); n = O.cut(q, G)
register("ground_truth_index", q.sql(f"""
SELECT session, event, itemid, max(pos)::BIGINT AS last_pos FROM {n['pos']}
WHERE event IN {O.LABEL_TYPES} GROUP BY session, event, itemid"""))(
    lambda spark, d: label_index(session_positions(test_set(spark, d))))

q = O.Q(); n = O.cut(q, G)
q.add("gt_idx", f"""
  SELECT session, event, itemid, max(pos) AS last_pos FROM {n['pos']}
  WHERE event IN {O.LABEL_TYPES} GROUP BY session, event, itemid""")
register("ground_truth_events", q.sql(f"""
SELECT p.session, p.pos, p.timestamp, p.event, p.itemid,
       (SELECT count(*) FROM gt_idx i WHERE i.session = p.session AND i.event = 'addtocart'
          AND i.last_pos > p.pos)::BIGINT AS n_cart_labels,
       (SELECT count(*) FROM gt_idx i WHERE i.session = p.session AND i.event = 'transaction'
          AND i.last_pos > p.pos)::BIGINT AS n_order_labels
FROM {n['pos']} p WHERE p.pos < p.n_in_session - 1"""))(
    lambda spark, d: ground_truth_counts(session_positions(test_set(spark, d))))

# The same on times cut to whole hours and without a sequence: most events are tied, and the
# event rank and the item order them (rows equal in these are equal in every column).
q = O.Q(); n = O.cut(q, G)
O.tied(q, n["pos"])
q.add("tied_idx", f"""
  SELECT session, event, itemid, max(pos) AS last_pos FROM tied
  WHERE event IN {O.LABEL_TYPES} GROUP BY session, event, itemid""")
register("ground_truth_events_tied", q.sql("""
SELECT p.session, p.pos, p.timestamp, p.event, p.itemid,
       (SELECT count(*) FROM tied_idx i WHERE i.session = p.session AND i.event = 'addtocart'
          AND i.last_pos > p.pos)::BIGINT AS n_cart_labels,
       (SELECT count(*) FROM tied_idx i WHERE i.session = p.session AND i.event = 'transaction'
          AND i.last_pos > p.pos)::BIGINT AS n_order_labels
FROM tied p WHERE p.pos < p.n_in_session - 1"""))(
    lambda spark, d: ground_truth_counts(session_positions(tied(spark, d))))



def label_sets_text(positioned, chunk):
    sets = whole_sets(ground_truth_sets(positioned, chunk))
    return sets.select("session", "pos", ids_text(F.col("cart_items")).alias("cart_items"), ids_text(F.col("order_items")).alias("order_items"))


def tied(spark, d):
    """Times cut to whole hours, no sequence."""
    return test_set(spark, d).drop("seq").withColumn("timestamp", F.expr("timestamp div 3600 * 3600"))


def label_sets_sql(q, pos):
    """Every event's sets from the frame of rows after it."""
    later = "OVER (PARTITION BY session ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    return q.sql(f"""
SELECT session, pos::BIGINT AS pos, {O.ids_text('list_sort(list_distinct(carts))')} AS cart_items,
       {O.ids_text('list_sort(list_distinct(orders))')} AS order_items
FROM (SELECT session, pos, n_in_session, list(itemid) FILTER (WHERE event = 'addtocart') {later} AS carts,
             list(itemid) FILTER (WHERE event = 'transaction') {later} AS orders FROM {pos}) x
WHERE pos < n_in_session - 1""")


q = O.Q(); n = O.cut(q, G)
register("ground_truth_label_sets", label_sets_sql(q, n["pos"]))(
    lambda spark, d: label_sets_text(session_positions(test_set(spark, d)), 4096))

# Tied events, and pieces of two positions: most sets are put together from several.
q = O.Q(); n = O.cut(q, G); O.tied(q, n["pos"])
register("ground_truth_label_sets_tied", label_sets_sql(q, "tied"))(
    lambda spark, d: label_sets_text(session_positions(tied(spark, d)), 2))


def lists_text(lists):
    events = F.transform("events", lambda e: F.concat_ws(":", e["itemid"].cast("string"), e["timestamp"].cast("string"), e["event"]))
    return lists.select("session", "start", F.array_join(events, " ").alias("events"))


q = O.Q(); n = O.cut(q, G)
register("session_event_lists", q.sql(f"""
SELECT session, CASE WHEN pos // 3 > 0 THEN pos // 3 * 3 END::BIGINT AS start,
       string_agg(itemid || ':' || timestamp || ':' || event, ' ' ORDER BY pos) AS events
FROM {n['pos']} GROUP BY session, pos // 3"""))(
    lambda spark, d: lists_text(session_event_lists(session_positions(test_set(spark, d)), 3)))

q = O.Q(); n = O.cut(q, G)
register("split_points", q.sql(
    f"SELECT session, n_events, last_label_pos, last_possible_idx, split_idx FROM {n['points']}"))(
    lambda spark, d: split_points(session_positions(test_set(spark, d))))

q = O.Q(); n = O.cut(q, G)
register("trimmed_sessions", q.sql(f"SELECT session, pos, itemid, timestamp, event FROM {n['trimmed']}"))(
    lambda spark, d: cut(spark, d)[0])

q = O.Q(); n = O.cut(q, G)
register("test_labels", q.sql(f"""
SELECT session, {O.ids_text('addtocart')} AS addtocart, {O.ids_text('transaction')} AS transaction
FROM {n['labels']}"""))(
    lambda spark, d: labels_text(cut(spark, d)[1]))

q = O.Q(); n = O.cut(q, G)
register("split_test_set", q.sql(f"""
SELECT l.session, t.n_kept AS n_kept_events,
       {O.ids_text('l.addtocart')} AS addtocart, {O.ids_text('l.transaction')} AS transaction
FROM {n['labels']} l
JOIN (SELECT session, count(*)::BIGINT AS n_kept FROM {n['trimmed']} GROUP BY session) t USING (session)"""))(
    lambda spark, d: (lambda parts: labels_text(parts[1]).join(
        parts[0].groupBy("session").agg(F.count(F.lit(1)).alias("n_kept_events")), "session"))(cut(spark, d)))
