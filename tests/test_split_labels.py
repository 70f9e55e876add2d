"""Train/test split and the cut of test sessions, on small session tables worked out by hand."""

from pyspark.sql import functions as F

from cartpath.operators.labels import (cut_at, cut_test_set, ground_truth_counts, label_index,
                                       session_positions, split_points)
from cartpath.operators.split import (leakage_check, qualifying_sessions, split_bounds, split_session_counts,
                                      train_test_split)

SESS = "timestamp long, event string, itemid long, session long, seq long"
WEEK = 604800
END = 10 * WEEK
CUT = END - WEEK          # one test week
START = CUT - WEEK        # one train week
CODES = {"v": "view", "c": "addtocart", "o": "transaction"}


def sessions(spark, **by_name):
    """name=[(time, code), ...] -> session table, sessions numbered in the given order."""
    rows = []
    for s, evs in enumerate(by_name.values(), start=1):
        for t, code in evs:
            rows.append((t, CODES[code], 60 + s, s, len(rows)))
    return spark.createDataFrame(rows, SESS)


def times(df, session):
    return sorted(r.timestamp for r in df.where(F.col("session") == session).collect())


def ids(df):
    return sorted({r.session for r in df.select("session").collect()})


def last(t=END):
    """A session that sets the last second."""
    return [(t - 5, "v"), (t, "c")]


def test_cut_points(spark):
    b = split_bounds(sessions(spark, a=last()), 1, 1).first()
    assert (b.max_ts, b.test_start, b.train_start) == (END, CUT, START)


def test_windows_include_their_start_only(spark):
    df = sessions(spark, early=[(START - 1, "v"), (START, "c")], at_start=[(START, "v"), (START + 1, "c")],
                  at_cut=[(CUT, "v"), (CUT + 1, "o")], last=last())
    train, test = train_test_split(df, 1, 1)
    assert ids(train) == [2] and ids(test) == [3, 4]  # session 1 keeps one second in the window


def test_lower_bound_removes_old_sessions(spark):
    df = sessions(spark, old=[(START - 900, "v"), (START - 800, "c")], new=[(START + 50, "v"), (START + 60, "c")], last=last())
    assert ids(train_test_split(df, 1, 1)[0]) == [2]
    assert ids(train_test_split(df, 2, 1)[0]) == [1, 2]


def test_qualifying_needs_an_action_after_the_first_event(spark):
    df = sessions(spark, views=[(1, "v"), (2, "v")], first_only=[(1, "c"), (2, "v")], later=[(1, "v"), (2, "o")],
                  twice=[(1, "o"), (2, "c")], before_window=[(START - 50, "c"), (START - 40, "o"), (START + 1, "v"), (START + 9, "v")],
                  last=last())
    assert ids(qualifying_sessions(df)) == [3, 4, 5, 6]
    # Judged on the whole session: the window itself holds only views of session 5.
    assert times(train_test_split(df, 1, 1)[0], 5) == [START + 1, START + 9]


def test_straddling_sessions(spark):
    df = sessions(
        spark,
        both=[(CUT - 20, "v"), (CUT - 10, "c"), (CUT + 10, "v"), (CUT + 20, "c")],   # train keeps its part
        one_before=[(CUT - 10, "v"), (CUT + 10, "c"), (CUT + 30, "v")],              # one train second: test
        one_each=[(CUT - 7, "v"), (CUT + 7, "c")],                                   # in neither set
        same_second=[(CUT - 9, "v"), (CUT - 9, "c"), (CUT + 3, "v"), (CUT + 4, "v")],
        last=last())
    train, test = train_test_split(df, 1, 1)
    assert times(train, 1) == [CUT - 20, CUT - 10] and times(test, 2) == [CUT + 10, CUT + 30]
    assert ids(train) == [1] and ids(test) == [2, 4, 5]
    check = leakage_check(train, test).first()
    assert (check.train_max_ts, check.test_min_ts, check.time_ok, check.shared_sessions) == (CUT - 10, CUT + 3, True, 0)
    assert tuple(split_session_counts(train, test).first()) == (1, 3)
    leaky = leakage_check(train, train.unionByName(test)).first()
    assert not leaky.time_ok and leaky.shared_sessions == 1


def test_no_sessions(spark):
    train, test = train_test_split(spark.createDataFrame([], SESS), 1, 1)
    assert train.count() == test.count() == 0
    assert tuple(split_session_counts(train, test).first()) == (0, 0)


def test_text_items_and_no_sequence(spark):
    rows = [(START + 1, "view", "x-1", 1), (START + 5, "addtocart", "x-2", 1), (END - 1, "view", "y", 2), (END, "transaction", "y", 2)]
    df = spark.createDataFrame(rows, "timestamp long, event string, itemid string, session long")
    train, test = train_test_split(df, 1, 1)
    assert train.columns == ["timestamp", "event", "itemid", "session"]
    assert sorted(r.itemid for r in train.collect()) == ["x-1", "x-2"] and ids(test) == [2]


def one_session(spark, text, start=50):
    """"v3 c3 o4" -> one session with events a second apart (item after the code)."""
    rows = [(start + i, CODES[w[0]], int(w[1:]), 1, i) for i, w in enumerate(text.split())]
    return spark.createDataFrame(rows, SESS)


def test_labels_of_every_event(spark):
    # position:                 0  1  2  3  4  5  6
    pos = session_positions(one_session(spark, "v2 c2 v9 c7 o2 c2 v7"))
    index = {(r.event, r.itemid): r.last_pos for r in label_index(pos).collect()}
    assert index == {("addtocart", 2): 5, ("addtocart", 7): 3, ("transaction", 2): 4}
    counts = {r.pos: (r.n_cart_labels, r.n_order_labels) for r in ground_truth_counts(pos).collect()}
    # Item 2 is a cart label up to position 4 (it is put in the cart again at 5), item 7 up to 2.
    assert counts == {0: (2, 1), 1: (2, 1), 2: (2, 1), 3: (1, 1), 4: (1, 0), 5: (0, 0)}


def test_labels_of_tied_events(spark):
    """A view, then the same cart click twice in one second: two equal rows."""
    rows = [(10, "view", 3, 1, 0), (11, "addtocart", 3, 1, 1), (11, "addtocart", 3, 1, 1)]
    counts = ground_truth_counts(session_positions(spark.createDataFrame(rows, SESS))).collect()
    assert {r.pos: r.n_cart_labels for r in counts} == {0: 1, 1: 1} and len(counts) == 2
    no_seq = spark.createDataFrame([(5, "transaction", 1, 1), (5, "view", 9, 1), (5, "addtocart", 4, 1), (5, "view", 2, 1)],
                                   "timestamp long, event string, itemid long, session long")
    order = [(r.event, r.itemid) for r in session_positions(no_seq).orderBy("pos").collect()]
    assert order == [("view", 2), ("view", 9), ("addtocart", 4), ("transaction", 1)]


def test_large_item_ids_do_not_change_the_order(spark):
    """Without a sequence the event's rank decides before the item, whatever the item's size."""
    big = 1 << 50
    rows = [(5, "view", big, 1), (5, "addtocart", 0, 1), (5, "transaction", None, 1), (5, "transaction", 0, 1)]
    df = spark.createDataFrame(rows, "timestamp long, event string, itemid long, session long")
    order = [(r.event, r.itemid) for r in session_positions(df).orderBy("pos").collect()]
    assert order == [("view", big), ("addtocart", 0), ("transaction", None), ("transaction", 0)]


def cut(spark, text, split):
    trimmed, labels = cut_at(one_session(spark, text), spark.createDataFrame([(1, split)], "session long, split_idx long"))
    lab = labels.first()
    return [r.itemid for r in trimmed.orderBy("pos").collect()], lab.addtocart, lab.transaction


def test_cut_at_a_point(spark):
    assert cut(spark, "v5 v6 c6 o5 v1", 1) == ([5], [6], [5])
    assert cut(spark, "v5 v6 c6 o5 v1", 3) == ([5, 6, 6], None, [5])
    assert cut(spark, "v5 v6 c6 o5 v1", 4) == ([5, 6, 6, 5], None, None)
    assert cut(spark, "v5 c9 c2 c9", 1) == ([5], [2, 9], None)


def test_split_point_range(spark):
    def points(text):
        return split_points(session_positions(one_session(spark, text))).first()

    assert points("v1 c1").split_idx == 1                      # nothing to draw from
    assert points("v1 v2 v3").last_label_pos is None and points("v1 v2 v3").split_idx == 1
    assert points("c1 v2 v3").last_possible_idx == 0
    assert points("v1 v2 c3 v4").last_possible_idx == 1        # the cart at 2 must stay behind the cut
    assert 1 <= points("v1 v2 v3 v4 o5 v6").split_idx <= 3


def test_drawn_split_in_range_and_labels_later(spark):
    rows = []
    for s in range(1, 60):
        n = 2 + s % 9
        for i in range(n):
            rows.append((1000 + i, ["view", "addtocart", "transaction"][(s * i) % 3], 100 + (s + i) % 7, s, s * 100 + i))
    test = spark.createDataFrame(rows, SESS)
    trimmed, labels, points = cut_test_set(test)
    pts = {r.session: r for r in points.collect()}
    for r in pts.values():
        lp = r.last_label_pos
        hi = lp - 1 if lp is not None and lp >= 2 else 0
        assert (r.split_idx == 1) if hi == 0 else (1 <= r.split_idx <= hi)
    kept = trimmed.groupBy("session").agg(F.count(F.lit(1)).alias("k")).collect()
    assert all(r.k == pts[r.session].split_idx for r in kept)
    # same draw on a second run (keyed by session, not by visiting order)
    again = {r.session: r.split_idx for r in cut_test_set(test.repartition(5))[2].collect()}
    assert again == {s: r.split_idx for s, r in pts.items()}
    assert labels.count() == len(pts)
