"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code: plain windows over whole partitions, dense_rank
over the whole table and correlated joins — the slow but obvious formulation — so that it
checks the distributed formulation rather than repeating it. Tables are the provided
parquet views (``events`` ...). CTEs are composed by name; ``sql(...)`` keeps the first
definition of each name and emits them in dependency order of registration.
"""

from __future__ import annotations

from ..config import SEED, TEST_WEEKS, TOP_K, TRAIN_WEEKS, WEEK_SEC


class Q:
    """An ordered, de-duplicated set of CTEs plus a final SELECT."""

    def __init__(self):
        self.ctes: dict[str, str] = {}

    def add(self, name: str, body: str) -> "Q":
        if name not in self.ctes:
            self.ctes[name] = body
        return self

    def sql(self, select: str) -> str:
        if not self.ctes:
            return select
        parts = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self.ctes.items())
        return f"WITH {parts}\n{select}"


def events(q: Q) -> str:
    q.add("ev", """
  SELECT epoch(date_trunc('second', ts))::BIGINT AS timestamp,
         user_id AS visitorid,
         CASE event_type WHEN 'purchase' THEN 'transaction'
                         WHEN 'signup' THEN 'addtocart' ELSE 'view' END AS event,
         json_extract(props, '$.k')::BIGINT AS itemid,
         CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid,
         event_id AS seq
  FROM events""")
    return "ev"


def marked(q: Q, gap: int) -> str:
    events(q)
    q.add(f"gaps_{gap}", f"""
  SELECT *, timestamp - lag(timestamp) OVER (PARTITION BY visitorid ORDER BY timestamp, seq) AS gap
  FROM ev WHERE visitorid IS NOT NULL AND timestamp IS NOT NULL""")
    q.add(f"marked_{gap}", f"""
  SELECT *, (gap IS NULL OR gap >= {gap}) AS is_boundary,
         sum(CASE WHEN gap IS NULL OR gap >= {gap} THEN 1 ELSE 0 END)
             OVER (PARTITION BY visitorid ORDER BY timestamp, seq
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS local_session
  FROM gaps_{gap}""")
    return f"marked_{gap}"


def session_ids(q: Q, gap: int) -> str:
    m = marked(q, gap)
    q.add(f"sid_{gap}", f"""
  SELECT visitorid, local_session,
         dense_rank() OVER (ORDER BY visitorid, local_session)::BIGINT AS session
  FROM (SELECT visitorid, local_session FROM {m}
        GROUP BY visitorid, local_session HAVING count(DISTINCT timestamp) > 1) k""")
    return f"sid_{gap}"


def sessions(q: Q, gap: int) -> str:
    m = marked(q, gap)
    i = session_ids(q, gap)
    q.add(f"sessions_{gap}", f"""
  SELECT m.timestamp, m.event, m.itemid, i.session, m.seq, m.visitorid
  FROM {m} m JOIN {i} i USING (visitorid, local_session)""")
    return f"sessions_{gap}"


def split(q: Q, gap: int, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS) -> dict[str, str]:
    s = sessions(q, gap)
    sfx = f"{gap}_{train_weeks}_{test_weeks}"
    q.add(f"bounds_{sfx}", f"""
  SELECT max_ts, max_ts - {test_weeks * WEEK_SEC} AS test_start,
         max_ts - {(test_weeks + train_weeks) * WEEK_SEC} AS train_start
  FROM (SELECT max(timestamp) AS max_ts FROM {s}) m""")
    q.add(f"qual_{gap}", f"""
  SELECT DISTINCT session FROM (
    SELECT session, event,
           row_number() OVER (PARTITION BY session ORDER BY timestamp, seq) AS rn
    FROM {s}) r
  WHERE rn > 1 AND event <> 'view'""")
    q.add(f"train_rows_{sfx}", f"""
  SELECT s.* FROM {s} s, bounds_{sfx} b
  WHERE s.timestamp >= b.train_start AND s.timestamp < b.test_start""")
    q.add(f"train_{sfx}", f"""
  SELECT t.timestamp, t.event, t.itemid, t.session, t.seq FROM train_rows_{sfx} t
  WHERE t.session IN (SELECT session FROM train_rows_{sfx} GROUP BY session
                      HAVING count(DISTINCT timestamp) > 1)
    AND t.session IN (SELECT session FROM qual_{gap})""")
    q.add(f"train_sessions_{sfx}", f"SELECT DISTINCT session FROM train_{sfx}")
    q.add(f"test_rows_{sfx}", f"""
  SELECT s.* FROM {s} s, bounds_{sfx} b
  WHERE s.timestamp >= b.test_start
    AND s.session NOT IN (SELECT session FROM train_sessions_{sfx})""")
    q.add(f"test_{sfx}", f"""
  SELECT t.timestamp, t.event, t.itemid, t.session, t.seq FROM test_rows_{sfx} t
  WHERE t.session IN (SELECT session FROM test_rows_{sfx} GROUP BY session
                      HAVING count(DISTINCT timestamp) > 1)
    AND t.session IN (SELECT session FROM qual_{gap})""")
    return {"bounds": f"bounds_{sfx}", "qual": f"qual_{gap}", "train": f"train_{sfx}",
            "train_sessions": f"train_sessions_{sfx}", "test": f"test_{sfx}"}


def draw(session_col: str, seed: int = SEED) -> str:
    return f"('0x' || substr(md5('{seed}-' || CAST({session_col} AS VARCHAR)), 1, 8))::BIGINT"


def ids_text(expr: str) -> str:
    """Sorted, comma-joined ids; NULL for NULL or empty lists, like the Spark side."""
    return f"CASE WHEN len({expr}) > 0 THEN array_to_string(list_sort({expr}), ',') END"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


__all__ = ["Q", "events", "marked", "session_ids", "sessions", "split", "draw", "ids_text", "r6",
           "TOP_K", "SEED"]


LABEL_TYPES = "('addtocart', 'transaction')"


def cut(q: Q, gap: int, seed: int = SEED) -> dict[str, str]:
    """Positions, split points, trimmed rows and label rows of the test set."""
    n = split(q, gap)
    sfx = f"{gap}"
    q.add(f"pos_{sfx}", f"""
  SELECT *, (row_number() OVER (PARTITION BY session ORDER BY timestamp, seq) - 1)::BIGINT AS pos,
         count(*) OVER (PARTITION BY session) AS n_in_session
  FROM {n['test']}""")
    q.add(f"pts0_{sfx}", f"""
  SELECT session, count(*)::BIGINT AS n_events,
         max(CASE WHEN event IN {LABEL_TYPES} THEN pos END)::BIGINT AS last_label_pos
  FROM pos_{sfx} GROUP BY session HAVING count(*) >= 2""")
    q.add(f"pts_{sfx}", f"""
  SELECT session, n_events, last_label_pos, last_possible_idx,
         (CASE WHEN last_possible_idx = 0 THEN 1
               ELSE 1 + {draw('session', seed)} % last_possible_idx END)::BIGINT AS split_idx
  FROM (SELECT *, (CASE WHEN last_label_pos >= 2 THEN last_label_pos - 1 ELSE 0 END)::BIGINT
                  AS last_possible_idx FROM pts0_{sfx}) x""")
    q.add(f"trim_{sfx}", f"""
  SELECT p.session, p.pos, p.itemid, p.timestamp, p.event
  FROM pos_{sfx} p JOIN pts_{sfx} s USING (session) WHERE p.pos < s.split_idx""")
    q.add(f"lab_long_{sfx}", f"""
  SELECT DISTINCT p.session, p.event, p.itemid
  FROM pos_{sfx} p JOIN pts_{sfx} s USING (session)
  WHERE p.pos >= s.split_idx AND p.event IN {LABEL_TYPES}""")
    q.add(f"lab_{sfx}", f"""
  SELECT s.session,
         list_sort(list(l.itemid) FILTER (WHERE l.event = 'addtocart')) AS addtocart,
         list_sort(list(l.itemid) FILTER (WHERE l.event = 'transaction')) AS transaction
  FROM pts_{sfx} s LEFT JOIN lab_long_{sfx} l USING (session) GROUP BY s.session""")
    return {**n, "pos": f"pos_{sfx}", "points": f"pts_{sfx}", "trimmed": f"trim_{sfx}",
            "lab_long": f"lab_long_{sfx}", "labels": f"lab_{sfx}"}


def tied(q: Q, pos: str) -> str:
    """The rows of ``pos`` at whole hours and without a sequence, in the order of event and item."""
    q.add("tied", f"""
  SELECT session, timestamp // 3600 * 3600 AS timestamp, event, itemid,
         row_number() OVER (PARTITION BY session ORDER BY timestamp // 3600,
           CASE event WHEN 'view' THEN 0 WHEN 'addtocart' THEN 1 ELSE 2 END, itemid) - 1 AS pos,
         count(*) OVER (PARTITION BY session) AS n_in_session FROM {pos}""")
    return "tied"


def fixture_predictions(q: Q, gap: int, popular_n: int = 20) -> dict[str, str]:
    """Long form (session, event_type, itemid, rank) of the stand-in predictor."""
    n = cut(q, gap)
    sfx = f"{gap}"
    q.add(f"rec_{sfx}", f"SELECT session, itemid, max(pos) AS lp FROM {n['trimmed']} GROUP BY session, itemid")
    q.add(f"pop_{sfx}", f"""
  SELECT event, itemid, r FROM (
    SELECT event, itemid, row_number() OVER (PARTITION BY event ORDER BY cnt DESC, itemid) AS r
    FROM (SELECT event, itemid, count(*) AS cnt FROM {n['train']}
          WHERE event IN {LABEL_TYPES} GROUP BY event, itemid) c) x
  WHERE r <= {popular_n}""")
    q.add(f"cand_{sfx}", f"""
  SELECT r.session, t.event_type, r.itemid, 0 AS grp, -r.lp AS k
  FROM rec_{sfx} r CROSS JOIN (VALUES ('addtocart'), ('transaction')) t(event_type)
  UNION ALL
  SELECT s.session, p.event AS event_type, p.itemid, 1 AS grp, p.r AS k
  FROM (SELECT DISTINCT session FROM rec_{sfx}) s CROSS JOIN pop_{sfx} p""")
    q.add(f"pred_{sfx}", f"""
  SELECT session, event_type, itemid,
         row_number() OVER (PARTITION BY session, event_type ORDER BY grp, k)::BIGINT AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY session, event_type, itemid ORDER BY grp, k) AS first
        FROM cand_{sfx}) c
  WHERE first = 1""")
    return {**n, "pred": f"pred_{sfx}"}


def hits(q: Q, gap: int, k: int = TOP_K) -> dict[str, str]:
    """Per label session: hits of each type as the reference defines them."""
    n = fixture_predictions(q, gap)
    sfx = f"{gap}_{k}"
    q.add(f"labn_{gap}", f"""
  SELECT s.session,
         count(l.itemid) FILTER (WHERE l.event = 'addtocart') AS nc,
         count(l.itemid) FILTER (WHERE l.event = 'transaction') AS no
  FROM {n['points']} s LEFT JOIN {n['lab_long']} l USING (session) GROUP BY s.session""")
    q.add(f"predn_{gap}", f"""
  SELECT session,
         count(*) FILTER (WHERE event_type = 'addtocart') AS pc,
         count(*) FILTER (WHERE event_type = 'transaction') AS po
  FROM {n['pred']} GROUP BY session""")
    q.add(f"hitc_{sfx}", f"""
  SELECT p.session,
         count(*) FILTER (WHERE p.event_type = 'addtocart') AS hc,
         count(*) FILTER (WHERE p.event_type = 'transaction') AS ho
  FROM {n['pred']} p JOIN {n['lab_long']} l
    ON l.session = p.session AND l.event = p.event_type AND l.itemid = p.itemid
  WHERE p.rank <= {k} GROUP BY p.session""")
    q.add(f"hits_{sfx}", f"""
  SELECT l.session, (pn.session IS NOT NULL) AS has_pred,
         CASE WHEN l.nc = 0 THEN NULL WHEN pn.session IS NULL THEN 0
              WHEN coalesce(pn.pc, 0) = 0 THEN NULL ELSE coalesce(h.hc, 0) END::BIGINT AS cart_hits,
         CASE WHEN l.no = 0 THEN NULL WHEN pn.session IS NULL THEN 0
              WHEN coalesce(pn.po, 0) = 0 THEN NULL ELSE coalesce(h.ho, 0) END::BIGINT AS order_hits
  FROM labn_{gap} l LEFT JOIN predn_{gap} pn USING (session) LEFT JOIN hitc_{sfx} h USING (session)""")
    q.add(f"numev_{sfx}", f"""
  SELECT coalesce(sum(least(nc, {k})), 0)::BIGINT AS n_carts,
         coalesce(sum(least(no, {k})), 0)::BIGINT AS n_orders FROM labn_{gap}""")
    q.add(f"rr_{gap}", f"""
  SELECT pt.session, pt.event_type,
         coalesce(1.0 / (SELECT min(p.rank) FROM {n['pred']} p JOIN {n['lab_long']} l
                          ON l.session = p.session AND l.event = p.event_type AND l.itemid = p.itemid
                          WHERE p.session = pt.session AND p.event_type = pt.event_type), 0.0) AS rr
  FROM (SELECT DISTINCT session, event_type FROM {n['pred']}) pt
  JOIN labn_{gap} l USING (session)
  WHERE (pt.event_type = 'addtocart' AND l.nc > 0) OR (pt.event_type = 'transaction' AND l.no > 0)""")
    return {**n, "hits": f"hits_{sfx}", "num_events": f"numev_{sfx}", "rr": f"rr_{gap}"}


def item_props(q: Q) -> str:
    q.add("props", """
  SELECT epoch(date_trunc('second', ts))::BIGINT * 1000 AS timestamp,
         json_extract(props, '$.k')::BIGINT AS itemid,
         CASE WHEN event_type IN ('view', 'click') THEN 'categoryid' ELSE 'available' END AS property,
         CAST((json_extract(props, '$.k')::BIGINT + day(ts)) % 17 AS VARCHAR) AS value
  FROM events""")
    return "props"


def tree(q: Q) -> str:
    item_props(q)
    q.add("tree", """
  SELECT categoryid, (CASE WHEN categoryid >= 4 THEN categoryid % 4 END)::BIGINT AS parentid
  FROM (SELECT DISTINCT CAST(value AS BIGINT) AS categoryid FROM props
        WHERE property = 'categoryid') c
  WHERE categoryid < 13""")
    return "tree"


def categories(q: Q, gap: int, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS) -> dict[str, str]:
    n = split(q, gap, train_weeks, test_weeks)
    tree(q)
    q.add("cat_ab", f"""
  SELECT train_max_ts, train_max_ts - {test_weeks * WEEK_SEC} AS test_start,
         train_max_ts - {(test_weeks + train_weeks) * WEEK_SEC} AS train_start
  FROM (SELECT max(timestamp) AS train_max_ts FROM {n['train']}) m""")
    q.add("cat_raw", """
  SELECT timestamp // 1000 AS timestamp, itemid, CAST(value AS BIGINT) AS categoryid
  FROM props WHERE property = 'categoryid'""")
    q.add("cat_parent", """
  SELECT r.timestamp, r.itemid, r.categoryid, coalesce(t.parentid, r.categoryid) AS parentid
  FROM cat_raw r LEFT JOIN tree t USING (categoryid)""")
    q.add("item_cat", """
  SELECT DISTINCT c.itemid, c.categoryid, c.parentid FROM cat_parent c, cat_ab b
  WHERE c.timestamp >= b.train_start AND c.timestamp < b.test_start""")
    return {**n, "bounds": "cat_ab", "raw": "cat_raw", "parent": "cat_parent", "item_categories": "item_cat"}


def pct(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({den} AS DOUBLE), 6)"
