"""Adapters from the provided parquet tables to the click-log data model.

The public shop data the reference runs on is not available; the ``events`` table stands
in for it with these rules (all column expressions, so the scan keeps its pruning):

* timestamp  = whole seconds of ``ts`` (rounded down, wall clock taken as UTC)
* visitorid  = ``user_id``
* event      = purchase -> transaction, signup -> addtocart, view/click/error -> view
* itemid     = ``k`` of the JSON ``props``
* transactionid = ``event_id`` for transactions
* seq        = ``event_id`` (source order; breaks ties inside one second)

Item properties: every event gives one row, property ``categoryid`` for view and click
events, else ``available``; value = (k + day of month) % 17 as text. The category tree is
derived from the category values seen: ids below 13 are in the tree, 0..3 are roots and
the parent of any other id c is c % 4 (ids 13..16 stay unknown on purpose).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CART, ORDER, VIEW
from ..functions.columns import epoch_seconds

# Fixed values of the stand-in data rules above.
CATEGORY_MOD = 17
TREE_SIZE = 13
ROOT_COUNT = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_name(event_type: Column) -> Column:
    return (F.when(event_type == "purchase", F.lit(ORDER))
             .when(event_type == "signup", F.lit(CART))
             .otherwise(F.lit(VIEW)))


def _item(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("long")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in seconds: timestamp, visitorid, event, itemid, transactionid, seq."""
    ev = table(spark, sf_dir, "events")
    ts = epoch_seconds(F.col("ts"), ev.schema["ts"].dataType)
    return ev.select(
        ts.alias("timestamp"),
        F.col("user_id").alias("visitorid"),
        _event_name(F.col("event_type")).alias("event"),
        _item(F.col("props")).alias("itemid"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("transactionid"),
        F.col("event_id").alias("seq"),
    )


def raw_click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in the shop's export layout (millisecond time, text item ids)."""
    ev = click_events(spark, sf_dir)
    return ev.select((F.col("timestamp") * 1000).alias("timestamp"), "visitorid", "event",
                     F.col("itemid").cast("string").alias("itemid"), "transactionid")


def item_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item property rows (timestamp in ms, itemid, property, value)."""
    ev = table(spark, sf_dir, "events")
    ts = epoch_seconds(F.col("ts"), ev.schema["ts"].dataType)
    prop = F.when(F.col("event_type").isin("view", "click"), F.lit("categoryid")).otherwise(F.lit("available"))
    value = ((_item(F.col("props")) + F.dayofmonth(F.col("ts"))) % CATEGORY_MOD).cast("string")
    return ev.select((ts * 1000).alias("timestamp"), _item(F.col("props")).alias("itemid"),
                     prop.alias("property"), value.alias("value"))


def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(categoryid, parentid) derived from the category values in the item properties."""
    props = item_properties(spark, sf_dir)
    cats = (props.where(F.col("property") == "categoryid")
                 .select(F.col("value").cast("long").alias("categoryid"))
                 .where(F.col("categoryid") < TREE_SIZE)
                 .distinct())
    parent = F.when(F.col("categoryid") >= ROOT_COUNT, F.col("categoryid") % ROOT_COUNT)
    return cats.select("categoryid", parent.cast("long").alias("parentid"))
