"""Time-based train/test split without leakage (the reference's ``create_train_test_split``).

* cut points: ``test_start = max(timestamp) - test_weeks`` and ``train_start = test_start -
  train_weeks`` over the sessionized rows;
* qualifying sessions: a non-view event somewhere after the session's first event,
  judged on the whole session before any time cut;
* train: rows in [train_start, test_start) of qualifying sessions that still span more than
  one second inside that window;
* test: rows from test_start on, of qualifying sessions that are not in the final train
  set and still span more than one second.

All decisions about a session are one aggregate (partial, map-side combined) on the session
key: first event, number of non-view events, first and last second inside each window. It
gives every session its set, and one join of the rows with that table (one row per
session) gives both sets, so they cost two scans of the sessions. The cut points come from one global
max (a one-column aggregate read first, like the reference's ``.item()``) and enter the
filters as literals, so the parquet scan of a written, time-sorted sessions table skips row
groups outside the windows; with ``literal=False`` they stay a lazy scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TEST_WEEKS, TRAIN_WEEKS, VIEW, WEEK_SEC
from ..functions.columns import time_order

TS = "timestamp"
COLS = ["timestamp", "event", "itemid", "session", "seq"]


def split_bounds(sessions: DataFrame, train_weeks: int = TRAIN_WEEKS,
                 test_weeks: int = TEST_WEEKS) -> DataFrame:
    """One row: max_ts, test_start, train_start."""
    m = sessions.agg(F.max(TS).alias("max_ts"))
    return m.select("max_ts",
                    (F.col("max_ts") - F.lit(test_weeks * WEEK_SEC)).alias("test_start"),
                    (F.col("max_ts") - F.lit((test_weeks + train_weeks) * WEEK_SEC)).alias("train_start"))


def _qualifies(order: Sequence[str]):
    """Aggregate: a non-view event after the session's first event."""
    first = F.min_by(F.col("event") != VIEW, F.struct(*order))
    return F.count_if(F.col("event") != VIEW) > F.coalesce(first.cast("int"), F.lit(0))


def qualifying_sessions(sessions: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Sessions with a cart or order (any non-view event) after their first event."""
    rows, order = time_order(sessions, tie)
    return rows.groupBy("session").agg(_qualifies(order).alias("_q")).where("_q").select("session")


def cut_points(sessions: DataFrame, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS,
               literal: bool = True):
    """(test_start, train_start) columns: literals (pushed down to the scan) or a lazy
    scalar subquery over the sessions' max time."""
    if literal:
        max_ts = sessions.agg(F.max(TS)).first()[0]
        if max_ts is None:  # no sessions: empty windows
            return F.lit(None).cast("long"), F.lit(None).cast("long")
        test_start = max_ts - test_weeks * WEEK_SEC
        return F.lit(test_start), F.lit(test_start - train_weeks * WEEK_SEC)
    max_ts = sessions.agg(F.max(TS)).scalar()
    test_start = max_ts - F.lit(test_weeks * WEEK_SEC)
    return test_start, test_start - F.lit(train_weeks * WEEK_SEC)


def split_rows(sessions: DataFrame, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS,
               tie: str | Sequence[str] | None = None, literal_cut: bool = True) -> DataFrame:
    """The rows of both sets with a column ``part`` ("train" or "test")."""
    test_start, train_start = cut_points(sessions, train_weeks, test_weeks, literal_cut)
    ts = F.col(TS)
    in_train, in_test = (ts >= train_start) & (ts < test_start), ts >= test_start

    def spans(inside):
        return F.coalesce(F.max(F.when(inside, ts)) > F.min(F.when(inside, ts)), F.lit(False))

    keyed, order = time_order(sessions, tie)
    flags = keyed.groupBy("session").agg(_qualifies(order).alias("_q"), spans(in_train).alias("_train"), spans(in_test).alias("_test"))
    # A session is in one set: train if it survives there, else test.
    flags = flags.where(F.col("_q") & (F.col("_train") | F.col("_test"))).select(
        "session", F.when(F.col("_train"), "train").otherwise("test").alias("part"))
    rows = sessions.where(in_train | in_test).withColumn("_window", F.when(in_test, "test").otherwise("train"))
    cols = [c for c in COLS if c in sessions.columns]
    return rows.join(flags, "session").where(F.col("_window") == F.col("part")).select(*cols, "part")


def train_test_split(sessions: DataFrame, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS,
                     tie: str | Sequence[str] | None = None, literal_cut: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train_set, test_set), both with columns timestamp, event, itemid, session and seq
    where the sessions have it. Lazy: write ``split_rows`` once where both sets are read."""
    rows = split_rows(sessions, train_weeks, test_weeks, tie, literal_cut)
    return tuple(rows.where(F.col("part") == p).drop("part") for p in ("train", "test"))


def train_sessions(train: DataFrame) -> DataFrame:
    return train.select("session").distinct()


def _by_session(train: DataFrame, test: DataFrame) -> DataFrame:
    """(session, first and last second in each set): both sets are read once."""
    both = (train.select("session", F.col(TS).alias("_train"), F.lit(None).cast("long").alias("_test"))
            .unionByName(test.select("session", F.lit(None).cast("long").alias("_train"), F.col(TS).alias("_test"))))
    return both.groupBy("session").agg(F.max("_train").alias("_train"), F.min("_test").alias("_test"))


def leakage_check(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: train_max_ts, test_min_ts, time_ok (test starts after train ends) and
    shared_sessions (sessions in both sets; must be 0)."""
    out = _by_session(train, test).agg(
        F.max("_train").alias("train_max_ts"), F.min("_test").alias("test_min_ts"),
        F.count_if(F.col("_train").isNotNull() & F.col("_test").isNotNull()).alias("shared_sessions"))
    return out.select("train_max_ts", "test_min_ts", (F.col("test_min_ts") > F.col("train_max_ts")).alias("time_ok"), "shared_sessions")


def split_session_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    return _by_session(train, test).agg(F.count("_train").alias("n_train_sessions"), F.count("_test").alias("n_test_sessions"))
