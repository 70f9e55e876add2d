"""Recall@k and mean reciprocal rank of ranked predictions (the reference's ``evaluate``).

Inputs (long or nested, one row per key, never one collect over a whole table):

* labels: (session, addtocart ARRAY<LONG>, transaction ARRAY<LONG>); a null array is an
  absent key, an empty array an empty set;
* predictions: (session, event_type, preds ARRAY<LONG>), one row per (session, type),
  ranked best first.

Rules kept from the reference:

* hits of a session and type: number of unique ids among the first k predictions that
  are labels; null when the labels or the prediction list are missing or empty; a label
  session with no prediction row at all scores 0 for each non-empty label type;
* the recall denominator sums min(|labels|, k) over all label sessions, with or without
  predictions; a zero denominator gives null (the reference raises);
* MRR is driven by the predictions: each (session, type) row whose session has non-empty
  labels of that type adds 1/rank of its first hit (no cut at k) or 0; the mean is null
  when no row qualifies.

Duplicate (session, type) prediction rows or duplicate label sessions have no defined
winner in a distributed file, so every score raises instead of silently picking one. A
predicted session without labels raises too, unless ``strict`` is False; it is then left out.

``get_scores`` groups each input by session once, joins the two grouped tables on the same
partitioning and takes all sums in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CART, ORDER, TOP_K
from ..functions.columns import empty_long_array, first_hit_rank, hits_at_k

TYPES = (CART, ORDER)
HIT_COLS = {CART: "cart_hits", ORDER: "order_hits"}


def predictions_by_session(predictions: DataFrame) -> DataFrame:
    """(session, addtocart_preds, transaction_preds): one row per predicted session; a
    missing type is null, a type without ids is empty. Raises on a duplicate (session, type)."""
    ids = F.coalesce("preds", empty_long_array())
    agg = predictions.groupBy("session").agg(
        *[F.count_if(F.col("event_type") == t).alias(f"_n_{t}") for t in TYPES],
        *[F.first(F.when(F.col("event_type") == t, ids), ignorenulls=True).alias(f"{t}_preds")
          for t in TYPES])
    checked = [F.when(F.col(f"_n_{t}") > 1,
                      F.raise_error(F.concat(F.lit(f"duplicate {t} prediction for session "),
                                             F.col("session").cast("string"))))
                .otherwise(F.col(f"{t}_preds")).alias(f"{t}_preds") for t in TYPES]
    return agg.select("session", *checked)


def unique_label_sessions(labels: DataFrame) -> DataFrame:
    """Labels with a check that each session appears once (raises otherwise)."""
    counted = labels.groupBy("session").agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(t).alias(t) for t in TYPES])
    return counted.select(
        "session",
        *[F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate label session "),
                                                         F.col("session").cast("string"))))
           .otherwise(F.col(t)).alias(t) for t in TYPES])


def session_hits(labels: DataFrame, by_session: DataFrame, k: int = TOP_K) -> DataFrame:
    """Hits for sessions present on both sides (the reference's ``evaluate_session``)."""
    j = labels.join(by_session, "session")
    return j.select("session", *[hits_at_k(F.col(t), F.col(f"{t}_preds"), k).alias(HIT_COLS[t]) for t in TYPES])


def _hits(t: str, k: int):
    """Hits of a label session; 0 for a non-empty type of a session without predictions."""
    missing = F.when(_size(t) > 0, F.lit(0).cast("long"))
    return F.when(F.col("_predicted").isNull(), missing).otherwise(hits_at_k(F.col(t), F.col(f"{t}_preds"), k))


def _size(col: str):
    # size of the set with an absent set as empty (also where size(null) is -1)
    return F.size(F.coalesce(F.col(col), empty_long_array()))


def _capped_sum(t: str, k: int):
    return F.coalesce(F.sum(F.least(_size(t), F.lit(k)).cast("long")), F.lit(0).cast("long"))


def _rr(t: str):
    """Reciprocal rank of a joined row: null unless the type is predicted and has labels."""
    rank = first_hit_rank(F.col(t), F.col(f"{t}_preds"))
    return F.when(F.col(f"{t}_preds").isNotNull() & (_size(t) > 0),
                  F.when(rank > 0, F.lit(1.0) / rank).otherwise(F.lit(0.0)))


def joined_scores(labels: DataFrame, predictions: DataFrame, strict: bool = True) -> DataFrame:
    """One row per label session with its labels and predictions side by side; each input is
    grouped once. Raises on duplicates and, if ``strict``, on a predicted session without labels."""
    lab = unique_label_sessions(labels).withColumn("_labelled", F.lit(True))
    pred = predictions_by_session(predictions).withColumn("_predicted", F.lit(True))
    if not strict:
        return lab.join(pred, "session", "left")
    j = lab.join(pred, "session", "full")
    return j.where(F.coalesce(F.col("_labelled"), F.raise_error(F.concat(
        F.lit("no labels for predicted session "), F.col("session").cast("string"))).cast("boolean")))


def evaluate_sessions(labels: DataFrame, by_session: DataFrame, k: int = TOP_K) -> DataFrame:
    """Hits for every label session (the label side drives)."""
    j = labels.join(by_session.withColumn("_predicted", F.lit(True)), "session", "left")
    return j.select("session", *[_hits(t, k).alias(HIT_COLS[t]) for t in TYPES])


def num_events(labels: DataFrame, k: int = TOP_K) -> DataFrame:
    """One row: n_carts, n_orders = sum over label sessions of min(|labels|, k)."""
    return labels.agg(_capped_sum(CART, k).alias("n_carts"), _capped_sum(ORDER, k).alias("n_orders"))


def recall(hits: DataFrame, totals: DataFrame) -> DataFrame:
    """One row: recall_cart, recall_order (null for a zero denominator)."""
    n = totals.select(F.struct("n_carts", "n_orders")).scalar()
    sums = hits.agg(*[F.coalesce(F.sum(HIT_COLS[t]), F.lit(0)).alias(f"_h_{t}") for t in TYPES])
    return sums.select(F.try_divide(F.col(f"_h_{CART}").cast("double"), n["n_carts"]).alias("recall_cart"),
                       F.try_divide(F.col(f"_h_{ORDER}").cast("double"), n["n_orders"]).alias("recall_order"))


def reciprocal_ranks(predictions: DataFrame, labels: DataFrame, strict: bool = True) -> DataFrame:
    """(session, event_type, rr) for prediction rows whose session has non-empty labels of
    the row's type."""
    j = joined_scores(labels, predictions, strict)
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("event_type"), _rr(t).alias("rr")) for t in TYPES]))
    return j.select("session", pairs.alias("_p")).select("session", "_p.*").where(F.col("rr").isNotNull())


def mrr(predictions: DataFrame, labels: DataFrame, strict: bool = True) -> DataFrame:
    """One row: mrr_cart, mrr_order (null when no prediction row qualifies)."""
    return joined_scores(labels, predictions, strict).agg(F.avg(_rr(CART)).alias("mrr_cart"), F.avg(_rr(ORDER)).alias("mrr_order"))


def get_scores(labels: DataFrame, predictions: DataFrame, k: int = TOP_K, strict: bool = True) -> DataFrame:
    """One row: recall_cart, recall_order, mrr_cart, mrr_order."""
    sums = joined_scores(labels, predictions, strict).agg(
        *[F.coalesce(F.sum(_hits(t, k)), F.lit(0)).cast("double").alias(f"_h_{t}") for t in TYPES],
        *[_capped_sum(t, k).alias(f"_n_{t}") for t in TYPES],
        *[F.avg(_rr(t)).alias(f"_m_{t}") for t in TYPES])
    return sums.select(F.try_divide(f"_h_{CART}", f"_n_{CART}").alias("recall_cart"),
                       F.try_divide(f"_h_{ORDER}", f"_n_{ORDER}").alias("recall_order"),
                       F.col(f"_m_{CART}").alias("mrr_cart"), F.col(f"_m_{ORDER}").alias("mrr_order"))
