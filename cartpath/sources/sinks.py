"""File sinks: CSV with header for tables, JSON lines for nested records.

Writers are distributed (one part file per task); no result passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CART, ORDER
from ..operators.labels import LIST_LIMIT, session_event_lists


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_sessions(df: DataFrame, path: str) -> None:
    """Train or test set as CSV with header; ``seq`` where the table has it."""
    cols = ["timestamp", "event", "itemid", "session", "seq"]
    write_csv(df.select(*[c for c in cols if c in df.columns]), path)


def write_item_categories(df: DataFrame, path: str) -> None:
    """Item categories as CSV, globally sorted by (itemid, categoryid, parentid): the part
    files are range partitions, so their concatenation is in order."""
    write_csv(df.orderBy("itemid", "categoryid", "parentid"), path)


def write_trimmed_sessions(df: DataFrame, path: str) -> None:
    """Trimmed test sessions as JSON lines, one line per kept event (session, pos, itemid,
    timestamp, event). One line per event instead of one list per session keeps a very
    long session from becoming one giant record."""
    df.select("session", "pos", "itemid", "timestamp", "event").write.mode("overwrite").json(path)


def write_trimmed_session_lists(df: DataFrame, path: str, limit: int = LIST_LIMIT) -> None:
    """Trimmed test sessions as JSON lines ``{"session": s, "events": [{"itemid", "timestamp",
    "event"}, ...]}``, one list per session in order of position. A session of more than ``limit``
    events goes on in further lines with ``"start"``, the position of their first event."""
    session_event_lists(df, limit).write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_labels(labels: DataFrame, path: str) -> None:
    """Labels as JSON lines ``{"session": s, "labels": {"addtocart": [...]}}``; a type
    without items is left out (null struct fields are not written)."""
    out = labels.select("session", F.struct(F.col(CART).alias(CART), F.col(ORDER).alias(ORDER)).alias("labels"))
    out.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_predictions(preds: DataFrame, path: str) -> None:
    """Predictions as CSV ``<session>_<type>,<id> <id> ...`` with a header line."""
    out = preds.select(
        F.concat(F.col("session").cast("string"), F.lit("_"), F.col("event_type")).alias("session_type"),
        F.array_join(F.transform("preds", lambda x: x.cast("string")), " ").alias("labels"))
    write_csv(out, path)
