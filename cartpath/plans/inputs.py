"""Shared inputs of the registered queries, derived by Spark from the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TEST_WEEKS, TRAIN_WEEKS
from ..functions.materialize import materialize
from ..operators.sessions import mark_sessions, sessionize
from ..operators.split import split_rows
from ..sources.driver import click_events

# Gaps used by the registered queries: the reference's 30 minutes for sessionization and
# the split; one day for labels, scores and profiling, where 30-minute sessions of the
# stand-in data are too short to carry labels.
GAP_SHORT = 1800
GAP_LONG = 86400


def marked(spark: SparkSession, sf_dir: str, gap: int = GAP_SHORT) -> DataFrame:
    return mark_sessions(click_events(spark, sf_dir), gap)


def sessions(spark: SparkSession, sf_dir: str, gap: int = GAP_SHORT, written: bool = False) -> DataFrame:
    """Sessionized events; ``written`` stores them once for plans that read them often."""
    out = sessionize(click_events(spark, sf_dir), gap)
    # Time-sorted inside each file: row-group min/max stats then let the split's literal
    # time filters skip row groups (a local sort, no extra shuffle).
    return materialize(out.sortWithinPartitions("timestamp"), f"sessions-{gap}") if written else out


def split(spark: SparkSession, sf_dir: str, gap: int = GAP_SHORT,
          train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS, written: bool = False):
    """(train, test); the sessions they come from are written once, and with ``written``
    the rows of both sets are, in one pass, for plans that read them more than once."""
    rows = split_rows(sessions(spark, sf_dir, gap, written=True), train_weeks, test_weeks)
    if written:
        rows = materialize(rows, f"split-{gap}", partition_by="part")
    return tuple(rows.where(F.col("part") == p).drop("part") for p in ("train", "test"))
