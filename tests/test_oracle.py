"""Registered queries against their DuckDB SQL on the smallest provided tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

NAMES = ["sessionize", "session_dense_id", "test_set", "split_leakage_check", "trimmed_sessions",
         "test_labels", "ground_truth_events", "ground_truth_events_tied", "train_set_1w", "test_set_1w", "session_boundary",
         "session_length_shares", "get_scores", "item_categories", "clicks_between_carts",
         "clicks_between_orders", "describe_inter_event_gaps", "session_size_histogram",
         "item_activity_bins", "eval_predictions_parsed"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(r[i] for i in order) for r in data)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(dcols, res.fetchall())
