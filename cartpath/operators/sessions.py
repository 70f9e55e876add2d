"""Sessionization: cut each visitor's events into sessions by an inactivity gap.

Semantics (the reference's ``create_sessions``):

* events are ordered per visitor by time (ties by ``seq``);
* an event starts a new session when it is the visitor's first one or when the gap to the
  visitor's previous event is at least ``gap_sec`` (a gap of exactly 1800 s splits);
* sessions whose events all fall in one second are dropped;
* the remaining sessions are numbered 1..N densely in (visitor, time) order.

Events without visitor or time would each form a one-event session that is dropped, so
they are removed up front.

Plan shape. Time is cut into buckets of width ``b = min(bucket_sec, gap_sec)``. Two events
in one bucket are less than ``b <= gap_sec`` apart, so no session boundary falls inside a
bucket: a boundary can only be a bucket's first event, and every event of a (visitor,
bucket) belongs to the same session. Hence:

1. per (visitor, bucket) first and last second: a partial (map-side combined) aggregate,
   so only one small row per bucket and map task is shuffled;
2. a window over each visitor's buckets (at most span / b rows per visitor, whatever the
   visitor's event count) decides which buckets start a session and numbers the sessions;
3. session extents and the one-instant filter are aggregates of the bucket rows;
4. dense ids come from a range partitioning of the session keys, not a global window; the
   numbered keys (one row per session) are written once below the checkpoint folder, so
   calling ``sessionize`` runs that one small job;
5. one join of the events with the (visitor, bucket) -> session table sets the id and
   drops one-instant sessions. It is the only shuffle of the event rows, and no ordered
   window runs over them; a hot (visitor, bucket) key is a join key, which AQE's skew
   handling splits (a window partition could not be split).

The table of buckets is written once: the extents, the ids and the join read it, so the
events are scanned twice in all (buckets, rows). AQE picks the join by measured sizes.

``mark_sessions`` adds the per-event gap to the previous event and the running session
number for the step-by-step queries, over written range partitions
(``functions.sequence``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import BUCKET_SEC, SESSION_GAP_SEC
from ..functions.columns import time_order
from ..functions.materialize import materialize
from ..functions.ranking import with_dense_id
from ..functions.sequence import ordered, with_previous, with_running_sums

TS = "timestamp"
KEY = ["visitorid", "local_session"]


def time_bucket(ts: str, bucket_sec: int):
    return F.floor(F.col(ts) / F.lit(bucket_sec)).cast("long")


def _clean(events: DataFrame) -> DataFrame:
    return events.where(F.col("visitorid").isNotNull() & F.col(TS).isNotNull())


def bucket_width(gap_sec: int, bucket_sec: int = BUCKET_SEC) -> int:
    """Bucket width b <= gap_sec: events of one bucket are at most b - 1 < gap_sec apart."""
    if int(gap_sec) < 1:
        raise ValueError("gap_sec must be at least 1 second")
    return max(1, min(int(bucket_sec), int(gap_sec)))


def session_buckets(events: DataFrame, gap_sec: int = SESSION_GAP_SEC,
                    bucket_sec: int = BUCKET_SEC) -> DataFrame:
    """One row per (visitorid, _tb) with first_ts, last_ts, prev_last_ts (last second of
    the visitor's previous non-empty bucket) and local_session (1-based per visitor)."""
    b = bucket_width(gap_sec, bucket_sec)
    ev = _clean(events).withColumn("_tb", time_bucket(TS, b))
    bk = ev.groupBy("visitorid", "_tb").agg(F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"))
    wv = Window.partitionBy("visitorid").orderBy("_tb")
    bk = bk.withColumn("prev_last_ts", F.lag("last_ts").over(wv))
    starts = (F.col("prev_last_ts").isNull() | (F.col("first_ts") - F.col("prev_last_ts") >= gap_sec)).cast("long")
    return bk.withColumn("local_session",
                         F.sum(starts).over(wv.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def mark_sessions(events: DataFrame, gap_sec: int = SESSION_GAP_SEC,
                  tie: str | Sequence[str] | None = None) -> DataFrame:
    """Every event with ``gap`` (seconds since the visitor's previous event, null for the
    first), ``is_boundary`` and ``local_session`` (1-based session number per visitor)."""
    bucket_width(gap_sec)
    ev, order = time_order(_clean(events), tie)
    rows = ordered(ev, ["visitorid"], order, "marked")
    rows = with_previous(rows, ["visitorid"], [TS])
    rows = (rows.withColumn("gap", F.col(TS) - F.col(f"prev_{TS}"))
                .withColumn("is_boundary", F.col("gap").isNull() | (F.col("gap") >= gap_sec)))
    rows = with_running_sums(rows, ["visitorid"], {"local_session": F.col("is_boundary").cast("long")})
    return rows.select(*events.columns, "gap", "is_boundary", "local_session")


def session_extents(marked: DataFrame) -> DataFrame:
    """Per (visitorid, local_session): first and last second, events, distinct seconds."""
    return marked.groupBy(*KEY).agg(
        F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct(TS).alias("n_distinct_ts"))


def multi_instant_sessions(marked: DataFrame) -> DataFrame:
    """Session keys with more than one distinct second (max > min needs no distinct)."""
    ext = marked.groupBy(*KEY).agg(F.min(TS).alias("_mn"), F.max(TS).alias("_mx"))
    return ext.where(F.col("_mx") > F.col("_mn")).select(*KEY)


def session_ids(marked: DataFrame) -> DataFrame:
    """Dense session id 1..N over the kept sessions in (visitor, local session) order."""
    return with_dense_id(multi_instant_sessions(marked), KEY, out="session")


def sessionize(events: DataFrame, gap_sec: int = SESSION_GAP_SEC, tie: str | None = None,
               bucket_sec: int = BUCKET_SEC, keep_visitor: bool = False) -> DataFrame:
    """Events -> sessions: (timestamp, event, itemid, session) and the source sequence
    (``tie``, by default ``seq``) where the events have one."""
    b = bucket_width(gap_sec, bucket_sec)
    buckets = materialize(session_buckets(events, gap_sec, bucket_sec), "session-buckets")
    extents = buckets.groupBy(*KEY).agg(F.min("first_ts").alias("_mn"), F.max("last_ts").alias("_mx"))
    kept = extents.where(F.col("_mx") > F.col("_mn")).select(*KEY)
    ids = with_dense_id(kept, KEY, out="session")
    bucket_ids = buckets.select("visitorid", "_tb", *KEY[1:]).join(ids, KEY).select("visitorid", "_tb", "session")
    rows = _clean(events).withColumn("_tb", time_bucket(TS, b))
    # The only shuffle of the event rows.
    out = rows.join(bucket_ids, ["visitorid", "_tb"])
    sequence = [c for c in ([tie] if tie else ["seq"]) if tie or c in events.columns]
    return out.select(TS, "event", "itemid", "session", *sequence, *(["visitorid"] if keep_visitor else []))
