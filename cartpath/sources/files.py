"""File sources: every read has an explicit schema and fails fast on malformed rows.

Several paths are read in one scan (a list of paths is a union of the part files).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import CART, ORDER
from ..functions.columns import empty_long_array, ms_to_seconds


def _csv(spark: SparkSession, schema, paths: str | Sequence[str], check_header: bool = True) -> DataFrame:
    """The header of every file must name the schema's columns in order (else it raises)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", not check_header).csv(paths))


def read_click_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw events CSV (timestamp in ms) -> timestamp in whole seconds."""
    df = _csv(spark, schemas.RAW_EVENTS, paths)
    return df.withColumn("timestamp", ms_to_seconds(F.col("timestamp")))


def read_sessions(spark: SparkSession, paths: str | Sequence[str], text_items: bool = False) -> DataFrame:
    """Train/test set CSV: timestamp, event, itemid, session and, where the files have it,
    seq. Item ids are numbers, or text with ``text_items``. A row without item id raises:
    labels are sets of item ids, and a set-building aggregate would silently drop the
    missing one."""
    first = [paths] if isinstance(paths, str) else list(paths)
    header = spark.read.option("header", True).csv(first[0]).columns
    schema = schemas.sessions("seq" in header, text_items)
    df = _csv(spark, schema, paths)
    checked = F.when(F.col("itemid").isNull(),
                     F.raise_error(F.lit("session table row without itemid"))).otherwise(F.col("itemid"))
    return df.withColumn("itemid", checked.cast(schema["itemid"].dataType))


def read_category_tree(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return _csv(spark, schemas.CATEGORY_TREE, paths)


def read_item_properties(spark: SparkSession, paths: str | Sequence[str], seconds: bool = True) -> DataFrame:
    """Item property part files stacked in one scan; timestamp ms -> s unless ``seconds``
    is False."""
    df = _csv(spark, schemas.ITEM_PROPERTIES, paths)
    return df.withColumn("timestamp", ms_to_seconds(F.col("timestamp"))) if seconds else df


def read_item_categories(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return _csv(spark, schemas.ITEM_CATEGORIES, paths)


def _label_set(col):
    s = F.array_sort(F.array_distinct(F.coalesce(col, empty_long_array())))
    return F.when(F.size(s) > 0, s)


def read_labels(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON lines ``{"session": s, "labels": {"addtocart": [...], "transaction": [...]}}`` ->
    (session, addtocart, transaction); a missing or empty type is null."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(schemas.LABELS_JSON).option("mode", "FAILFAST").json(paths)
    return df.select("session", _label_set(F.col("labels.addtocart")).alias(CART),
                     _label_set(F.col("labels.transaction")).alias(ORDER))


def read_trimmed_sessions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schemas.TRIMMED_EVENT_JSON).option("mode", "FAILFAST").json(paths)


def read_trimmed_session_lists(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON lines ``{"session": s, "events": [{"itemid", "timestamp", "event"}, ...]}`` (one
    list per session, or several with the ``start`` of each) -> the same rows as
    ``read_trimmed_sessions``, with ``pos``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(schemas.TRIMMED_LIST_JSON).option("mode", "FAILFAST").json(paths)
    rows = df.select("session", "start", F.posexplode("events").alias("_at", "e"))
    pos = (F.coalesce("start", F.lit(0)) + F.col("_at")).cast("long")
    return rows.select("session", pos.alias("pos"), "e.itemid", "e.timestamp", "e.event")


def read_predictions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Predictions CSV (header, then ``<session>_<type>,<id> <id> ...``) ->
    (session, event_type, preds ARRAY<LONG> in rank order); an empty list is allowed."""
    # Their first line is a header of any wording.
    df = _csv(spark, schemas.PREDICTIONS_CSV, paths, check_header=False)
    key = F.split(F.trim(F.col("session_type")), "_")
    ids = F.trim(F.col("labels"))
    preds = F.when(ids.isNull() | (ids == ""), empty_long_array()).otherwise(
        F.transform(F.split(ids, " "), lambda x: x.cast("long")))
    return df.select(key.getItem(0).cast("long").alias("session"), key.getItem(1).alias("event_type"),
                     preds.alias("preds"))
