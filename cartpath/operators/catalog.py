"""Item -> category -> parent table for the train window (the reference's
``product_category_tree``).

* the window is anchored on the latest train timestamp: ``test_start = anchor -
  test_weeks`` and ``train_start = test_start - train_weeks`` (as in the reference, this
  subtracts the test weeks once more; pass explicit bounds for the plain train window);
* keep the ``categoryid`` property rows, typed to integers (a bad value raises);
* join the category tree for the parent; a root or unknown category is its own parent;
  only one parent level is resolved;
* keep rows inside [train_start, test_start), then distinct (itemid, categoryid, parentid);
  (itemid, categoryid) is made distinct before the tree join, so the few hot categories join
  one row per item instead of one per property change.

The tree join is left to AQE: it broadcasts the tree only when its measured size is below
the broadcast threshold and shuffles both sides otherwise. The time filter is applied
before the join, on the raw millisecond column (floor(ms / 1000) >= a is ms >= 1000 a), so
it reaches the parquet / CSV scan; the bounds are read first from the one-row frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TEST_WEEKS, TRAIN_WEEKS, WEEK_SEC
from ..functions.columns import ms_to_seconds

TS = "timestamp"


def anchor_bounds(train: DataFrame, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS) -> DataFrame:
    """One row: train_max_ts, test_start, train_start."""
    m = train.agg(F.max(TS).alias("train_max_ts"))
    return m.select("train_max_ts",
                    (F.col("train_max_ts") - F.lit(test_weeks * WEEK_SEC)).alias("test_start"),
                    (F.col("train_max_ts") - F.lit((test_weeks + train_weeks) * WEEK_SEC)).alias("train_start"))


def category_rows(item_properties: DataFrame) -> DataFrame:
    """(timestamp in seconds, itemid, categoryid) from property rows with ms timestamps."""
    return (item_properties.where(F.col("property") == "categoryid")
            .select(ms_to_seconds(F.col(TS)).alias(TS), "itemid",
                    F.col("value").cast("long").alias("categoryid")))


def with_parent(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """Add ``parentid``; a category without a parent (root or not in the tree) is its own."""
    j = rows.join(tree.select("categoryid", "parentid"), "categoryid", "left")
    return j.withColumn("parentid", F.coalesce(F.col("parentid"), F.col("categoryid")))


def item_categories(item_properties: DataFrame, tree: DataFrame, bounds: DataFrame) -> DataFrame:
    """Distinct (itemid, categoryid, parentid) seen in [train_start, test_start)."""
    b = bounds.select("train_start", "test_start").first()
    if b is None or b["train_start"] is None:
        in_window = F.lit(False)
    else:
        in_window = (F.col(TS) >= F.lit(b["train_start"] * 1000)) & (F.col(TS) < F.lit(b["test_start"] * 1000))
    rows = category_rows(item_properties.where(in_window)).select("itemid", "categoryid").distinct()
    out = with_parent(rows, tree)
    # A tree may list several parents of a category, or one twice.
    return out.select("itemid", "categoryid", "parentid").distinct()
