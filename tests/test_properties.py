"""Random small inputs checked against a direct, row-by-row reading of the rules."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartpath.operators.labels import cut_test_set
from cartpath.operators.sessions import sessionize

EVENTS = ["view", "addtocart", "transaction"]
SCHEMA = "timestamp long, visitorid long, event string, itemid long, transactionid long, seq long"
SESS = "timestamp long, event string, itemid long, session long, seq long"

row = st.tuples(st.integers(0, 12_000), st.integers(1, 4), st.sampled_from(EVENTS), st.integers(1, 5))
SET = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_sessions(rows, gap):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], rows[i][0], i))
    groups, prev = [], None
    for i in order:
        ts, v = rows[i][0], rows[i][1]
        if prev is None or prev[1] != v or ts - prev[0] >= gap:
            groups.append([])
        groups[-1].append(i)
        prev = (ts, v)
    kept = [g for g in groups if len({rows[i][0] for i in g}) > 1]
    return {i: n + 1 for n, g in enumerate(kept) for i in g}


@SET
@given(st.lists(row, max_size=40))
def test_sessionize_matches_direct_reading(spark, rows):
    df = spark.createDataFrame([(t, v, e, i, None, n) for n, (t, v, e, i) in enumerate(rows)], SCHEMA)
    got = {r.seq: r.session for r in sessionize(df, gap_sec=1800, bucket_sec=700).collect()}
    assert got == brute_sessions(rows, 1800)


def cut_by_definition(events, session, seed=42):
    """events: list of (itemid, event) in session order -> (kept count, cart set, order set).

    The labels are the items of the cart and order events from the cut on; the cut may fall
    up to one before the last such event, so that something is left to predict."""
    actions = [p for p, (_, ev) in enumerate(events) if ev != "view"]
    most = max(actions[-1] - 1, 0) if actions else 0
    cut = 1
    if most:
        cut += int(hashlib.md5(f"{seed}-{session}".encode()).hexdigest()[:8], 16) % most
    behind = events[cut:]
    return (cut, *({item for item, ev in behind if ev == kind} for kind in ("addtocart", "transaction")))


@SET
@given(st.lists(st.lists(st.tuples(st.integers(1, 6), st.sampled_from(EVENTS)), min_size=2, max_size=12),
                min_size=1, max_size=6))
def test_cut_matches_direct_reading(spark, sessions):
    rows, n = [], 0
    for s, events in enumerate(sessions, start=1):
        for k, (item, ev) in enumerate(events):
            rows.append((1000 + 5 * k, ev, item, s, n))
            n += 1
    trimmed, labels, points = cut_test_set(spark.createDataFrame(rows, SESS))
    kept = {}
    for r in trimmed.collect():
        kept[r.session] = kept.get(r.session, 0) + 1
    lab = {r.session: (set(r.addtocart or []), set(r.transaction or [])) for r in labels.collect()}
    for s, events in enumerate(sessions, start=1):
        split, c, o = cut_by_definition(events, s)
        assert kept[s] == split
        assert lab[s] == (c, o)


def brute_steps(rows, kind):
    """rows: (ts, event, item, session, seq). The notebook's steps between carts / orders,
    read row by row over the frame sorted by (session, time, seq)."""
    rows = sorted(rows, key=lambda r: (r[3], r[0], r[4]))
    if kind == "carts":
        r1 = [r for r in rows if r[1] != "transaction"]
        kept = []
        for i, r in enumerate(r1):
            nxt = r1[i + 1] if i + 1 < len(r1) else None
            if nxt is None or nxt[3] != r[3]:
                continue
            if r[1] == "addtocart" and nxt[1] == "addtocart" and r[2] == nxt[2]:
                continue
            kept.append(r)
        mark = "addtocart"
    else:
        seen, kept = set(), []
        for r in rows:
            key = (r[3], r[0], r[1])
            if r[1] != "addtocart" and key not in seen:
                seen.add(key)
                kept.append(r)
        mark = "transaction"
    marked = [(i, r[3]) for i, r in enumerate(kept) if r[1] == mark]
    return sorted((s, j - i) for (i, s), (j, s2) in zip(marked, marked[1:]) if s == s2)


@SET
@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from(EVENTS), st.integers(1, 3), st.integers(1, 3)),
                max_size=40))
def test_steps_match_direct_reading(spark, raw):
    from cartpath.operators.profile import clicks_between_carts, clicks_between_orders
    rows = [(t, e, i, s, n) for n, (t, e, i, s) in enumerate(raw)]
    df = spark.createDataFrame(rows, SESS) if rows else spark.createDataFrame([], SESS)
    carts = sorted((r.session, r.delta_index) for r in clicks_between_carts(df).collect())
    orders = sorted(r.delta_index for r in clicks_between_orders(df).collect())
    assert carts == brute_steps(rows, "carts")
    assert orders == sorted(d for _, d in brute_steps(rows, "orders"))


@SET
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from(EVENTS), st.integers(1, 4), st.integers(1, 3)),
                max_size=40))
def test_label_counts_and_gaps_match_direct_reading(spark, raw):
    from cartpath.operators.labels import ground_truth_counts, session_positions
    from cartpath.operators.profile import inter_event_gaps
    rows = [(t, e, i, s, n) for n, (t, e, i, s) in enumerate(raw)]
    df = spark.createDataFrame(rows, SESS) if rows else spark.createDataFrame([], SESS)
    by_session = {}
    for r in sorted(rows, key=lambda r: (r[3], r[0], r[4])):
        by_session.setdefault(r[3], []).append(r)
    want_counts, want_gaps = {}, []
    for s, evs in by_session.items():
        for i in range(len(evs) - 1):
            later = evs[i + 1:]
            want_counts[evs[i][4]] = (len({x[2] for x in later if x[1] == "addtocart"}),
                                      len({x[2] for x in later if x[1] == "transaction"}))
            want_gaps.append(evs[i + 1][0] - evs[i][0])
    pos = session_positions(df)
    got = {}
    seq_of = {(r[3], p): r[4] for s, evs in by_session.items() for p, r in enumerate(evs)}
    for r in ground_truth_counts(pos).collect():
        got[seq_of[(r.session, r.pos)]] = (r.n_cart_labels, r.n_order_labels)
    assert got == want_counts
    assert sorted(r.time_between_sec for r in inter_event_gaps(df).collect()) == sorted(want_gaps)


def brute_split(rows, train_weeks, test_weeks, week=100):
    """rows: (ts, event, item, session, seq) -> (train seqs, test seqs), read row by row."""
    if not rows:
        return set(), set()
    max_ts = max(r[0] for r in rows)
    test_start = max_ts - test_weeks * week
    train_start = test_start - train_weeks * week
    by_s = {}
    for r in sorted(rows, key=lambda r: (r[3], r[0], r[4])):
        by_s.setdefault(r[3], []).append(r)
    qual = {s for s, evs in by_s.items() if any(e[1] != "view" for e in evs[1:])}

    def keep(part):
        ok = {}
        for r in part:
            ok.setdefault(r[3], set()).add(r[0])
        return {s for s, ts in ok.items() if len(ts) > 1} & qual

    train_rows = [r for r in rows if train_start <= r[0] < test_start]
    train_s = keep(train_rows)
    test_rows = [r for r in rows if r[0] >= test_start and r[3] not in train_s]
    test_s = keep(test_rows)
    return ({r[4] for r in train_rows if r[3] in train_s}, {r[4] for r in test_rows if r[3] in test_s})


@SET
@given(st.lists(st.tuples(st.integers(0, 600), st.sampled_from(EVENTS), st.integers(1, 3), st.integers(1, 6)),
                max_size=40), st.integers(1, 3), st.integers(1, 2))
def test_split_matches_direct_reading(spark, raw, train_weeks, test_weeks):
    import cartpath.operators.split as S
    rows = [(t, e, i, s, n) for n, (t, e, i, s) in enumerate(raw)]
    df = spark.createDataFrame(rows, SESS) if rows else spark.createDataFrame([], SESS)
    old = S.WEEK_SEC
    S.WEEK_SEC = 100  # short weeks so that random data straddles the cut points
    try:
        train, test = S.train_test_split(df, train_weeks, test_weeks)
        got = ({r.seq for r in train.collect()}, {r.seq for r in test.collect()})
    finally:
        S.WEEK_SEC = old
    assert got == brute_split(rows, train_weeks, test_weeks)


def brute_scores(labels, preds, k):
    """labels: {s: {type: set}} ; preds: {s: {type: list}} -> (recall_c, recall_o, mrr_c, mrr_o)."""
    tot = {t: sum(min(len(v.get(t) or ()), k) for v in labels.values()) for t in ("addtocart", "transaction")}
    hit = {t: 0 for t in tot}
    for s, lab in labels.items():
        for t in tot:
            if lab.get(t) and s in preds and preds[s].get(t):
                hit[t] += len(set(preds[s][t][:k]) & lab[t])
    rr = {t: [] for t in tot}
    for s, p in preds.items():
        if s not in labels:
            continue
        for t in tot:
            if t in p and labels[s].get(t):
                first = next((i for i, x in enumerate(p[t], 1) if x in labels[s][t]), None)
                rr[t].append(1 / first if first else 0)
    rec = [hit[t] / tot[t] if tot[t] else None for t in ("addtocart", "transaction")]
    mrr = [sum(v) / len(v) if v else None for v in (rr["addtocart"], rr["transaction"])]
    return tuple(rec + mrr)


maybe_set = st.one_of(st.none(), st.sets(st.integers(1, 6), max_size=4))
maybe_list = st.one_of(st.none(), st.lists(st.integers(1, 6), max_size=6))


@SET
@given(st.dictionaries(st.integers(1, 6), st.tuples(maybe_set, maybe_set), min_size=1, max_size=6),
       st.dictionaries(st.integers(1, 8), st.tuples(maybe_list, maybe_list), max_size=6), st.integers(1, 4))
def test_scores_match_direct_reading(spark, lab, prd, k):
    from cartpath.operators.evaluation import get_scores
    labels = {s: {t: v for t, v in zip(("addtocart", "transaction"), pair) if v is not None}
              for s, pair in lab.items()}
    preds = {s: {t: v for t, v in zip(("addtocart", "transaction"), pair) if v is not None}
             for s, pair in prd.items()}
    ldf = spark.createDataFrame(
        [(s, sorted(v["addtocart"]) if "addtocart" in v else None,
          sorted(v["transaction"]) if "transaction" in v else None) for s, v in labels.items()],
        "session long, addtocart array<long>, transaction array<long>")
    pdf = spark.createDataFrame([(s, t, p) for s, v in preds.items() for t, p in v.items()],
                                "session long, event_type string, preds array<long>")
    r = get_scores(ldf, pdf, k, strict=False).first()
    got = (r.recall_cart, r.recall_order, r.mrr_cart, r.mrr_order)
    want = brute_scores(labels, preds, k)
    assert all((a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-12)
               for a, b in zip(got, want)), (got, want)
