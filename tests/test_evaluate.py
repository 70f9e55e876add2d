"""Scoring: hits, session map, capped counts, recall, reciprocal ranks, checks of the input."""

import pytest

from cartpath.operators import evaluation as E

LAB = "session long, addtocart array<long>, transaction array<long>"
PRED = "session long, event_type string, preds array<long>"
CART, ORDER = "addtocart", "transaction"


def labels_of(spark, *rows):
    return spark.createDataFrame(list(rows), LAB)


def preds_of(spark, *rows):
    return spark.createDataFrame(list(rows), PRED)


# Own sample: 40 has carts 7, 8 and order 8; 41 only an order; 42 only carts and no prediction.
def sample(spark):
    labels = labels_of(spark, (40, [7, 8], [8]), (41, None, [5]), (42, [1, 2, 3], []))
    preds = preds_of(spark, (40, CART, [9, 8, 7]), (40, ORDER, [8]), (41, CART, [5]), (41, ORDER, [6, 4, 5]))
    return labels, preds


@pytest.mark.parametrize("labels, preds, k, hits", [
    ([11, 12], [12, 50, 11], 20, 2),       # both found
    ([11, 12], [12, 50, 11], 2, 1),        # the second hit stands behind the cut
    ([11, 12], [50, 51], 20, 0),           # nothing found
    ([], [12], 20, None),                  # an empty set
    (None, [12], 20, None),                # a missing type
    ([11], None, 20, None),                # a null list
    ([11], [], 20, None),                  # an empty list
    ([11], [11, 11, 11], 3, 1),            # a repeated id counts once
])
def test_hits_of_one_type(spark, labels, preds, k, hits):
    for i, name in enumerate(("cart_hits", "order_hits")):
        lab = labels_of(spark, (3, labels, None) if i == 0 else (3, None, labels))
        by = spark.createDataFrame([(3, preds, None) if i == 0 else (3, None, preds)],
                                   "session long, addtocart_preds array<long>, transaction_preds array<long>")
        row = E.session_hits(lab, by, k).first()
        assert row[name] == hits and row[("order_hits", "cart_hits")[i]] is None


def test_every_label_session_is_scored(spark):
    labels, preds = sample(spark)
    got = {r.session: (r.cart_hits, r.order_hits)
           for r in E.evaluate_sessions(labels, E.predictions_by_session(preds), 2).collect()}
    assert got == {40: (1, 1), 41: (None, 0), 42: (0, None)}


def test_capped_counts(spark):
    labels, _ = sample(spark)
    assert tuple(E.num_events(labels, 2).first()) == (4, 2)
    assert tuple(E.num_events(labels, 20).first()) == (5, 2)
    assert tuple(E.num_events(labels.limit(0), 20).first()) == (0, 0)


def test_capped_counts_with_legacy_size_of_null(spark):
    """With ANSI off and legacy sizeOfNull, size(null) is -1: absent sets must still count 0."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.legacy.sizeOfNull")}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.legacy.sizeOfNull", "true")
    try:
        labels, preds = sample(spark)
        counts = tuple(E.num_events(labels, 20).first())
        scores = tuple(E.get_scores(labels, preds, 2).first())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert counts == (5, 2) and scores == (1 / 4, 1 / 2, 1 / 2, 2 / 3)


def test_recall_and_zero_denominator(spark):
    hits = spark.createDataFrame([(1, 3, None), (2, None, 0), (3, 1, None)], "session long, cart_hits long, order_hits long")
    totals = spark.createDataFrame([(16, 0)], "n_carts long, n_orders long")
    assert tuple(E.recall(hits, totals).first()) == (0.25, None)


def test_scores_of_the_sample(spark):
    labels, preds = sample(spark)
    # Carts: 1 of 2 + 2 capped labels; orders: 1 of 2. First hits: cart rank 2 (session 41 has no
    # cart labels), orders rank 1 and, not cut at k, rank 3.
    assert tuple(E.get_scores(labels, preds, 2).first()) == (1 / 4, 1 / 2, 1 / 2, (1 + 1 / 3) / 2)
    assert tuple(E.mrr(preds, labels).first()) == (1 / 2, (1 + 1 / 3) / 2)


def test_reciprocal_rank_rows(spark):
    labels, preds = sample(spark)
    got = {(r.session, r.event_type): r.rr for r in E.reciprocal_ranks(preds, labels).collect()}
    assert got == {(40, CART): 1 / 2, (40, ORDER): 1.0, (41, ORDER): 1 / 3}
    misses = preds_of(spark, (40, CART, [1]), (42, CART, []), (42, ORDER, [1]))
    got = {(r.session, r.event_type): r.rr for r in E.reciprocal_ranks(misses, labels).collect()}
    assert got == {(40, CART): 0.0, (42, CART): 0.0}
    assert tuple(E.mrr(preds.limit(0), labels).first()) == (None, None)


def test_duplicate_prediction_raises(spark):
    labels, preds = sample(spark)
    twice = preds.union(preds_of(spark, (40, CART, [9, 8, 7])))
    for score in (lambda: E.predictions_by_session(twice), lambda: E.mrr(twice, labels), lambda: E.get_scores(labels, twice)):
        with pytest.raises(Exception, match="duplicate addtocart prediction"):
            score().collect()


def test_duplicate_label_session_raises(spark):
    labels, preds = sample(spark)
    twice = labels.union(labels_of(spark, (41, None, [5])))
    for score in (lambda: E.mrr(preds, twice), lambda: E.get_scores(twice, preds)):
        with pytest.raises(Exception, match="duplicate label session"):
            score().collect()


def test_unlabelled_prediction_raises_unless_lenient(spark):
    labels, preds = sample(spark)
    more = preds.union(preds_of(spark, (77, CART, [7])))
    for score in (lambda **k: E.mrr(more, labels, **k), lambda **k: E.get_scores(labels, more, 2, **k)):
        with pytest.raises(Exception, match="no labels for predicted session"):
            score().collect()
    assert tuple(E.get_scores(labels, more, 2, strict=False).first()) == tuple(E.get_scores(labels, preds, 2).first())
    assert tuple(E.mrr(more, labels, strict=False).first()) == tuple(E.mrr(preds, labels).first())


def test_scores_read_each_input_once(spark, tmp_path):
    """Executed scans: one of the labels, one of the predictions, also without exchange reuse."""
    for name, df in zip(("labels", "preds"), sample(spark)):
        df.write.parquet(str(tmp_path / name))
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = E.get_scores(spark.read.parquet(str(tmp_path / "labels")), spark.read.parquet(str(tmp_path / "preds")), 2)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert plan.count("FileScan") == 2, plan
