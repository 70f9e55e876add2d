"""Queries of the train/test split (gap 1800 s, 3 train and 2 test weeks)."""

from __future__ import annotations

from ..operators.split import (leakage_check, qualifying_sessions, split_bounds,
                               split_session_counts, train_sessions)
from . import oracle as O
from .inputs import GAP_SHORT as G
from .inputs import sessions, split
from .registry import register

q = O.Q(); n = O.split(q, G)
register("split_bounds", q.sql(f"SELECT max_ts, test_start, train_start FROM {n['bounds']}"))(
    lambda spark, d: split_bounds(sessions(spark, d, G)))

q = O.Q(); n = O.split(q, G)
register("qualifying_sessions", q.sql(f"SELECT session FROM {n['qual']}"))(
    lambda spark, d: qualifying_sessions(sessions(spark, d, G)))

q = O.Q(); n = O.split(q, G)
register("train_set", q.sql(f"SELECT * FROM {n['train']}"))(
    lambda spark, d: split(spark, d, G)[0])

q = O.Q(); n = O.split(q, G)
register("train_sessions", q.sql(f"SELECT session FROM {n['train_sessions']}"))(
    lambda spark, d: train_sessions(split(spark, d, G)[0]))

q = O.Q(); n = O.split(q, G)
register("test_set", q.sql(f"SELECT * FROM {n['test']}"))(
    lambda spark, d: split(spark, d, G)[1])

q = O.Q(); n = O.split(q, G)
register("split_leakage_check", q.sql(f"""
SELECT a.train_max_ts, b.test_min_ts, b.test_min_ts > a.train_max_ts AS time_ok,
       (SELECT count(*) FROM (SELECT DISTINCT session FROM {n['train']}
                              INTERSECT SELECT DISTINCT session FROM {n['test']}) x) AS shared_sessions
FROM (SELECT max(timestamp) AS train_max_ts FROM {n['train']}) a,
     (SELECT min(timestamp) AS test_min_ts FROM {n['test']}) b"""))(
    lambda spark, d: leakage_check(*split(spark, d, G, written=True)))

q = O.Q(); n = O.split(q, G)
register("split_session_counts", q.sql(f"""
SELECT (SELECT count(DISTINCT session) FROM {n['train']}) AS n_train_sessions,
       (SELECT count(DISTINCT session) FROM {n['test']}) AS n_test_sessions"""))(
    lambda spark, d: split_session_counts(*split(spark, d, G, written=True)))

# One train and one test week: the train window's lower bound removes rows here.
for _part, _name in ((0, "train"), (1, "test")):
    q = O.Q(); n = O.split(q, G, 1, 1)
    register(f"{_name}_set_1w", q.sql(f"SELECT * FROM {n[_name]}"))(
        lambda spark, d, _p=_part: split(spark, d, G, 1, 1)[_p])
