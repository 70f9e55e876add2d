"""Queries of the sessionization steps (gap 1800 s)."""

from __future__ import annotations

from ..operators.sessions import multi_instant_sessions, session_extents, session_ids
from . import oracle as O
from .inputs import GAP_SHORT as G
from .inputs import marked, sessions
from .registry import register


def _q():
    return O.Q()


q = _q(); m = O.marked(q, G)
register("event_gap", q.sql(f"SELECT visitorid, timestamp, seq, gap FROM {m}"))(
    lambda spark, d: marked(spark, d, G).select("visitorid", "timestamp", "seq", "gap"))

q = _q(); m = O.marked(q, G)
register("session_boundary", q.sql(f"SELECT visitorid, timestamp, seq, is_boundary FROM {m}"))(
    lambda spark, d: marked(spark, d, G).select("visitorid", "timestamp", "seq", "is_boundary"))

q = _q(); m = O.marked(q, G)
register("session_local_id", q.sql(f"SELECT visitorid, timestamp, seq, local_session FROM {m}"))(
    lambda spark, d: marked(spark, d, G).select("visitorid", "timestamp", "seq", "local_session"))

q = _q(); m = O.marked(q, G)
register("session_distinct_ts", q.sql(f"""
SELECT visitorid, local_session, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
       count(*) AS n_events, count(DISTINCT timestamp) AS n_distinct_ts
FROM {m} GROUP BY visitorid, local_session"""))(
    lambda spark, d: session_extents(marked(spark, d, G)))

q = _q(); m = O.marked(q, G)
register("multi_event_sessions", q.sql(f"""
SELECT visitorid, local_session FROM {m}
GROUP BY visitorid, local_session HAVING count(DISTINCT timestamp) > 1"""))(
    lambda spark, d: multi_instant_sessions(marked(spark, d, G)))

q = _q(); i = O.session_ids(q, G)
register("session_dense_id", q.sql(f"SELECT visitorid, local_session, session FROM {i}"))(
    lambda spark, d: session_ids(marked(spark, d, G)))

q = _q(); s = O.sessions(q, G)
register("sessionize", q.sql(f"SELECT timestamp, event, itemid, session, seq FROM {s}"))(
    lambda spark, d: sessions(spark, d, G))
