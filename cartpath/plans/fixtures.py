"""A small stand-in predictor so that scoring queries have predictions to score.

Not an operator of the reference (which only reads predictions from a file). Rule, per
trimmed session and label type: the distinct items of the kept prefix, most recently seen
first, followed by the 20 items most often seen with that event type in the train set
(ties by itemid); an item keeps its first rank only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CART, ORDER

POPULAR_N = 20


def popular_items(train: DataFrame, event: str, n: int = POPULAR_N) -> DataFrame:
    """One row: ``popular`` = the n most frequent items of ``event`` (a top-n via a partial
    per-partition top-n, so the result is bounded by n)."""
    counts = train.where(F.col("event") == event).groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col("itemid").asc()).limit(n)
    ranked = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "itemid"))).alias("_r"))
    return ranked.select(F.transform(F.coalesce("_r", F.array()), lambda s: s["itemid"]).alias("popular"))


def predictions(trimmed: DataFrame, train: DataFrame) -> DataFrame:
    """(session, event_type, preds ARRAY<LONG>) for every trimmed session and label type."""
    last_seen = trimmed.groupBy("session", "itemid").agg(F.max("pos").alias("_lp"))
    recent = last_seen.groupBy("session").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("_lp")).alias("k"), "itemid"))).alias("_r"))
    recent = recent.select("session", F.transform("_r", lambda s: s["itemid"]).alias("recent"))
    out = None
    for event in (CART, ORDER):
        # A scalar subquery: one array of at most POPULAR_N ids.
        pop = popular_items(train, event).scalar()
        part = recent.select(
            "session", F.lit(event).alias("event_type"),
            F.array_distinct(F.concat(F.col("recent"), pop)).alias("preds"))
        out = part if out is None else out.unionByName(part)
    return out
