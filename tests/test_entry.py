"""Driver contract: entry() runs, every query has a callable, oracles name known queries."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) > 0
    assert df.count() >= 0


def test_oracles_cover_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    assert all(isinstance(s, str) and s.strip() for s in o.values())


def test_query_runs_on_small_data(spark):
    from conftest import SF_SMALL
    for name in ("sessionize", "test_labels", "get_scores", "item_categories", "clicks_between_carts"):
        assert E.queries()[name](spark, SF_SMALL).count() >= 0
