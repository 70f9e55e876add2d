"""Queries of the profiling notebook over the train set (gap one day, 3 train / 2 test weeks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CART, ORDER, VIEW
from ..functions.materialize import materialize
from ..operators import profile as P
from . import oracle as O
from .inputs import GAP_LONG as G
from .inputs import split
from .registry import REGISTRY, register


def train(spark, d, written=False):
    """The train set; ``written`` where a plan reads it more than once."""
    return split(spark, d, G, written=written)[0]


def rounded(df):
    """Ratios and other doubles to 6 digits, as the SQL side has them."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def base():
    q = O.Q()
    t = O.split(q, G)["train"]
    q.add("eps", f"SELECT session, count(*) AS events_count FROM {t} GROUP BY session")
    q.add("epi", f"SELECT itemid, count(itemid) AS events_count FROM {t} GROUP BY itemid")
    for e, name in ((VIEW, "views_count"), (CART, "carts_count"), (ORDER, "purchases_count")):
        q.add(f"per_{name}", f"SELECT itemid, count(itemid) AS {name} FROM {t} WHERE event = '{e}' GROUP BY itemid")
    q.add("slen", f"""
  SELECT session, CAST(max(timestamp) - min(timestamp) AS DOUBLE) / CAST(60 AS DOUBLE)
         AS session_length_minutes FROM {t} GROUP BY session""")
    q.add("gaps", f"""
  SELECT next_ts - timestamp AS time_between_sec FROM (
    SELECT timestamp, lead(timestamp) OVER (PARTITION BY session ORDER BY timestamp, seq) AS next_ts
    FROM {t}) x WHERE next_ts IS NOT NULL""")
    q.add("cb_r1", f"""
  SELECT session, timestamp, seq, event, itemid,
         row_number() OVER (PARTITION BY session ORDER BY timestamp, seq) AS p
  FROM {t} WHERE event <> 'transaction'""")
    q.add("cb_r2", """
  SELECT a.session, a.timestamp, a.seq, a.event FROM cb_r1 a
  JOIN cb_r1 b ON b.session = a.session AND b.p = a.p + 1
  WHERE NOT coalesce(a.event = 'addtocart' AND b.event = 'addtocart' AND a.itemid = b.itemid, false)""")
    q.add("cb_r3", """
  SELECT *, row_number() OVER (PARTITION BY session ORDER BY timestamp, seq) AS idx FROM cb_r2""")
    q.add("cb_c", """
  SELECT session, idx, row_number() OVER (PARTITION BY session ORDER BY idx) AS cp
  FROM cb_r3 WHERE event = 'addtocart'""")
    q.add("carts_gap", """
  SELECT a.session, (b.idx - a.idx)::BIGINT AS delta_index
  FROM cb_c a JOIN cb_c b ON b.session = a.session AND b.cp = a.cp + 1""")
    q.add("co_o1", f"""
  SELECT session, timestamp, event, min(seq) AS seq FROM {t}
  WHERE event <> 'addtocart' GROUP BY session, timestamp, event""")
    q.add("co_o2", """
  SELECT *, row_number() OVER (PARTITION BY session ORDER BY timestamp, seq) AS idx FROM co_o1""")
    q.add("co_t", """
  SELECT session, idx, row_number() OVER (PARTITION BY session ORDER BY idx) AS tp
  FROM co_o2 WHERE event = 'transaction'""")
    q.add("orders_gap", """
  SELECT (b.idx - a.idx)::BIGINT AS delta_index
  FROM co_t a JOIN co_t b ON b.session = a.session AND b.tp = a.tp + 1""")
    return q, t


def describe_sql(src: str, col: str) -> str:
    q, _ = base()
    return q.sql(f"""
SELECT count({col}) AS count, count(*) FILTER (WHERE {col} IS NULL) AS null_count,
       {O.r6(f'avg({col})')} AS mean, {O.r6(f'stddev_samp({col})')} AS std,
       {O.r6(f'min({col})')} AS min, {O.r6(f'quantile_cont({col}, 0.25)')} AS q25,
       {O.r6(f'quantile_cont({col}, 0.5)')} AS q50, {O.r6(f'quantile_cont({col}, 0.75)')} AS q75,
       {O.r6(f'max({col})')} AS max
FROM {src}""")


def histogram_sql(src: str, col: str, bins: int, where: str = "TRUE") -> str:
    q, _ = base()
    q.add(f"h_src_{bins}", f"SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {where}")
    q.add(f"h_rng_{bins}", f"""
  SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
  FROM (SELECT min(v) AS mn, max(v) AS mx FROM h_src_{bins}) m""")
    q.add(f"h_cnt_{bins}", f"""
  SELECT least(floor((s.v - r.lo) * CAST({bins} AS DOUBLE) / (r.hi - r.lo)), {bins - 1})::BIGINT AS bin,
         count(*) AS n
  FROM h_src_{bins} s, h_rng_{bins} r GROUP BY 1""")
    width = f"((r.hi - r.lo) / CAST({bins} AS DOUBLE))"
    return q.sql(f"""
SELECT b.bin, round(r.lo + b.bin * {width}, 6) AS lower, round(r.lo + (b.bin + 1) * {width}, 6) AS upper,
       coalesce(c.n, 0) AS n
FROM h_rng_{bins} r, (SELECT range AS bin FROM range(0, {bins})) b LEFT JOIN h_cnt_{bins} c USING (bin)""")


def _eps(spark, d, written=False):
    return P.events_per_session(train(spark, d, written))


def _epi(spark, d, written=False):
    return P.events_per_item(train(spark, d, written))


_PER_ITEM = {"views_count": VIEW, "carts_count": CART, "purchases_count": ORDER}

q, t = base()
register("events_per_session", q.sql("SELECT session, events_count FROM eps"))(_eps)

register("describe_events_per_session", describe_sql("eps", "events_count"))(
    lambda spark, d: rounded(P.describe(_eps(spark, d), "events_count")))
register("describe_events_per_item", describe_sql("epi", "events_count"))(
    lambda spark, d: rounded(P.describe(_epi(spark, d), "events_count")))
for _name, _label in (("views_count", "views"), ("carts_count", "carts"), ("purchases_count", "purchases")):
    register(f"describe_{_label}_per_item", describe_sql(f"per_{_name}", _name))(
        lambda spark, d, _n=_name: rounded(P.describe(P.per_item_counts(train(spark, d), _PER_ITEM[_n], _n), _n)))
register("describe_session_length", describe_sql("slen", "session_length_minutes"))(
    lambda spark, d: rounded(P.describe(P.session_length(train(spark, d, written=True)), "session_length_minutes", many=True)))
register("describe_inter_event_gaps", describe_sql("gaps", "time_between_sec"))(
    lambda spark, d: rounded(P.describe(P.inter_event_gaps(train(spark, d)), "time_between_sec", many=True)))
register("describe_clicks_between_carts", describe_sql("carts_gap", "delta_index"))(
    lambda spark, d: rounded(P.describe(P.clicks_between_carts(train(spark, d)), "delta_index")))
register("describe_clicks_between_orders", describe_sql("orders_gap", "delta_index"))(
    lambda spark, d: rounded(P.describe(P.clicks_between_orders(train(spark, d)), "delta_index")))

q, t = base()
register("session_size_shares", q.sql(f"""
SELECT {O.pct("count(*) FILTER (WHERE events_count < 100)", "count(*)")} AS pct_lt_100,
       {O.pct("count(*) FILTER (WHERE events_count < 10)", "count(*)")} AS pct_lt_10,
       {O.pct("count(*) FILTER (WHERE events_count < 5)", "count(*)")} AS pct_lt_5,
       {O.pct("count(*) FILTER (WHERE events_count = 2)", "count(*)")} AS pct_eq_2
FROM eps"""))(lambda spark, d: rounded(P.session_size_shares(_eps(spark, d))))

register("session_size_histogram", histogram_sql("eps", "events_count", 120))(
    lambda spark, d: rounded(P.histogram(_eps(spark, d, written=True), "events_count", 120)))
register("session_size_histogram_lt30", histogram_sql("eps", "events_count", 30, "events_count < 30"))(
    lambda spark, d: rounded(P.histogram(_eps(spark, d, written=True).where(F.col("events_count") < 30), "events_count", 30)))

q, t = base()
register("event_type_counts", q.sql(f"SELECT event, count(event) AS count FROM {t} GROUP BY event"))(
    lambda spark, d: P.event_type_counts(train(spark, d)))

q, t = base()
register("events_per_item", q.sql("SELECT itemid, events_count FROM epi"))(
    lambda spark, d: _epi(spark, d, written=True))

q, t = base()
register("item_count_distribution", q.sql(
    "SELECT events_count, count(events_count) AS itemids_count FROM epi GROUP BY events_count"))(
    lambda spark, d: P.item_count_distribution(_epi(spark, d)))

_b = P.ACTIVITY_BOUNDS
_case = " ".join(f"WHEN events_count <= {b} THEN {i}" for i, b in enumerate(_b))
_labels = ", ".join(f"({i}, '{s}')" for i, s in enumerate(P.activity_bin_labels(_b)))
q, t = base()
register("item_activity_bins", q.sql(f"""
SELECT l.bin::BIGINT AS bin, l.label, {O.pct("coalesce(c.n, 0)", "(SELECT count(*) FROM epi)")} AS pct
FROM (VALUES {_labels}) l(bin, label)
LEFT JOIN (SELECT CASE {_case} ELSE {len(_b)} END AS bin, count(*) AS n FROM epi GROUP BY 1) c
  ON c.bin = l.bin"""))(lambda spark, d: rounded(P.item_activity_bins(_epi(spark, d, written=True))))

for _name, _label in (("views_count", "views"), ("carts_count", "carts"), ("purchases_count", "purchases")):
    q, t = base()
    register(f"{_label}_per_item", q.sql(f"SELECT itemid, {_name} FROM per_{_name}"))(
        lambda spark, d, _n=_name: P.per_item_counts(train(spark, d), _PER_ITEM[_n], _n))

q, t = base()
register("distinct_counts", q.sql(
    f"SELECT count(DISTINCT session) AS n_sessions, count(DISTINCT itemid) AS n_items FROM {t}"))(
    lambda spark, d: P.distinct_counts(train(spark, d)))

_cov = []
for _e, _tag in ((VIEW, "view"), (CART, "cart"), (ORDER, "order")):
    _n = f"count(DISTINCT itemid) FILTER (WHERE event = '{_e}')"
    _cov += [f"{_n} AS n_{_tag}_items", f"{O.pct(_n, 'count(DISTINCT itemid)')} AS pct_{_tag}_items"]
q, t = base()
register("item_coverage", q.sql(
    f"SELECT count(DISTINCT itemid) AS n_items, {', '.join(_cov)} FROM {t}"))(
    lambda spark, d: rounded(P.item_coverage(train(spark, d))))

# The same from one table of items, which is written once.
def _items(spark, d):
    return materialize(P.item_profile(train(spark, d)), "item-profile")


q, t = base()
register("item_profile", q.sql(f"""
SELECT itemid, count(*) AS n_rows, count(*) FILTER (WHERE event = 'view') AS n_view,
       count(*) FILTER (WHERE event = 'addtocart') AS n_addtocart, count(*) FILTER (WHERE event = 'transaction') AS n_transaction
FROM {t} GROUP BY itemid"""))(lambda spark, d: P.item_profile(train(spark, d)))
for _name, _of in (("events_per_item", P.profile_events_per_item), ("item_coverage", lambda p: rounded(P.profile_item_coverage(p))),
                   ("item_count_distribution", lambda p: P.item_count_distribution(P.profile_events_per_item(p))),
                   ("carts_per_item", lambda p: P.profile_per_item_counts(p, CART, "carts_count"))):
    register(f"profile_{_name}", REGISTRY[_name][1])(lambda spark, d, _f=_of: _f(_items(spark, d)))


def _sketch_errors(spark, d):
    """Distinct counts of every week by daily sketches, against the exact ones."""
    rows = train(spark, d, written=True).withColumn("week", F.expr("timestamp div 604800"))
    daily = materialize(P.daily_sketches(rows), "daily-sketches").withColumn("week", F.expr("day div 7"))
    near = daily.groupBy("week").agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"near_{c}") for c in ("sessions", "items")])
    exact = rows.groupBy("week").agg(F.count_distinct("session").alias("n_sessions"), F.count_distinct("itemid").alias("n_items"))
    ok = lambda c: (F.abs(F.col(f"near_{c}") - F.col(f"n_{c}")) <= F.col(f"n_{c}") * 0.01).alias(f"{c}_within_1_percent")
    return exact.join(near, "week").select("week", "n_sessions", "n_items", ok("sessions"), ok("items"))


q, t = base()
register("distinct_counts_by_sketch", q.sql(f"""
SELECT timestamp // 604800 AS week, count(DISTINCT session) AS n_sessions, count(DISTINCT itemid) AS n_items,
       true AS sessions_within_1_percent, true AS items_within_1_percent FROM {t} GROUP BY 1"""))(_sketch_errors)

q, t = base()
register("session_length", q.sql("SELECT session, round(session_length_minutes, 6) AS session_length_minutes FROM slen"))(
    lambda spark, d: rounded(P.session_length(train(spark, d))))

q, t = base()
register("session_length_shares", q.sql("SELECT " + ", ".join(
    f"{O.pct(f'count(*) FILTER (WHERE session_length_minutes < {m})', 'count(*)')} AS pct_lt_{m}_min"
    for m in P.LENGTH_THRESHOLDS_MIN) + " FROM slen"))(
    lambda spark, d: rounded(P.session_length_shares(P.session_length(train(spark, d)))))

q, t = base()
register("longest_session_events", q.sql(f"""
SELECT timestamp, event, itemid, session, seq FROM {t}
WHERE session = (SELECT session FROM slen ORDER BY session_length_minutes DESC, session ASC LIMIT 1)"""))(
    lambda spark, d: (lambda tr: P.longest_session_events(tr, P.session_length(tr)))(train(spark, d, written=True)))

q, t = base()
register("inter_event_gaps", q.sql("SELECT time_between_sec FROM gaps"))(
    lambda spark, d: P.inter_event_gaps(train(spark, d)))

q, t = base()
register("clicks_between_carts", q.sql("SELECT session, delta_index FROM carts_gap"))(
    lambda spark, d: P.clicks_between_carts(train(spark, d)))

q, t = base()
register("clicks_between_orders", q.sql("SELECT delta_index FROM orders_gap"))(
    lambda spark, d: P.clicks_between_orders(train(spark, d)))
