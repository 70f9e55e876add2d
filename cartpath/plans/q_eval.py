"""Queries of scoring: hits, capped label counts, Recall@20 and MRR (gap one day).

Labels come from the cut of the test set, predictions from the stand-in predictor
(``plans.fixtures``) over the trimmed sessions and the train set.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import TOP_K
from ..functions.materialize import materialize
from ..operators import evaluation as E
from ..operators.labels import cut_rows, points_of, test_labels, trimmed_sessions
from . import oracle as O
from .fixtures import predictions as fixture_predictions
from .inputs import GAP_LONG as G
from .inputs import split
from .registry import register


def scored_inputs(spark, d):
    """(labels, predictions); tables read by several branches are written once."""
    train, test = split(spark, d, G, written=True)
    # The cut rows feed the trimmed prefix and the labels: written once.
    cut = materialize(cut_rows(test), "cut-rows")
    labels = materialize(test_labels(cut, points_of(cut)), "labels")
    return labels, materialize(fixture_predictions(trimmed_sessions(cut), train), "predictions")


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


q = O.Q(); n = O.hits(q, G)
register("session_hits", q.sql(
    f"SELECT session, cart_hits, order_hits FROM {n['hits']} WHERE has_pred"))(
    lambda spark, d: (lambda lp: E.session_hits(lp[0], E.predictions_by_session(lp[1]), TOP_K))(
        scored_inputs(spark, d)))

q = O.Q(); n = O.hits(q, G)
register("session_hits_all", q.sql(f"SELECT session, cart_hits, order_hits FROM {n['hits']}"))(
    lambda spark, d: (lambda lp: E.evaluate_sessions(lp[0], E.predictions_by_session(lp[1]), TOP_K))(
        scored_inputs(spark, d)))

q = O.Q(); n = O.hits(q, G)
register("num_events", q.sql(f"SELECT n_carts, n_orders FROM {n['num_events']}"))(
    lambda spark, d: E.num_events(scored_inputs(spark, d)[0], TOP_K))

_RECALL = """
SELECT round(try_divide_c, 6) AS recall_cart, round(try_divide_o, 6) AS recall_order FROM (
  SELECT CASE WHEN n.n_carts = 0 THEN NULL ELSE h.hc / n.n_carts END AS try_divide_c,
         CASE WHEN n.n_orders = 0 THEN NULL ELSE h.ho / n.n_orders END AS try_divide_o
  FROM (SELECT coalesce(sum(cart_hits), 0)::DOUBLE AS hc, coalesce(sum(order_hits), 0)::DOUBLE AS ho
        FROM {hits}) h, {num} n) x"""

_MRR = """
SELECT round(avg(rr) FILTER (WHERE event_type = 'addtocart'), 6) AS mrr_cart,
       round(avg(rr) FILTER (WHERE event_type = 'transaction'), 6) AS mrr_order FROM {rr}"""

q = O.Q(); n = O.hits(q, G)
register("recall_at_k", q.sql(_RECALL.format(hits=n["hits"], num=n["num_events"])))(
    lambda spark, d: (lambda lp: E.recall(E.evaluate_sessions(lp[0], E.predictions_by_session(lp[1]), TOP_K),
                                          E.num_events(lp[0], TOP_K)))(scored_inputs(spark, d))
    .select(_r6("recall_cart"), _r6("recall_order")))

q = O.Q(); n = O.hits(q, G)
register("mrr", q.sql(_MRR.format(rr=n["rr"])))(
    lambda spark, d: (lambda lp: E.mrr(lp[1], lp[0]))(scored_inputs(spark, d))
    .select(_r6("mrr_cart"), _r6("mrr_order")))

q = O.Q(); n = O.hits(q, G)
q.add("recall_row", _RECALL.format(hits=n["hits"], num=n["num_events"]))
q.add("mrr_row", _MRR.format(rr=n["rr"]))
register("get_scores", q.sql("SELECT * FROM recall_row, mrr_row"))(
    lambda spark, d: E.get_scores(*scored_inputs(spark, d), TOP_K)
    .select(*[_r6(c) for c in ("recall_cart", "recall_order", "mrr_cart", "mrr_order")]))
