"""Queries of the item-category table (train set of the 1800 s split)."""

from __future__ import annotations

from ..operators.catalog import anchor_bounds, category_rows, item_categories, with_parent
from ..sources.driver import category_tree, item_properties
from . import oracle as O
from .inputs import GAP_SHORT as G
from .inputs import split
from .registry import register


def _train(spark, d):
    return split(spark, d, G)[0]


q = O.Q(); n = O.categories(q, G)
register("train_max_ts", q.sql(f"SELECT train_max_ts, test_start, train_start FROM {n['bounds']}"))(
    lambda spark, d: anchor_bounds(_train(spark, d)))

q = O.Q(); n = O.categories(q, G)
register("item_category_raw", q.sql(f"SELECT timestamp, itemid, categoryid FROM {n['raw']}"))(
    lambda spark, d: category_rows(item_properties(spark, d)))

q = O.Q(); n = O.categories(q, G)
register("category_parent", q.sql(f"SELECT timestamp, itemid, categoryid, parentid FROM {n['parent']}"))(
    lambda spark, d: with_parent(category_rows(item_properties(spark, d)), category_tree(spark, d))
    .select("timestamp", "itemid", "categoryid", "parentid"))

q = O.Q(); n = O.categories(q, G)
register("item_categories", q.sql(f"SELECT itemid, categoryid, parentid FROM {n['item_categories']}"))(
    lambda spark, d: item_categories(item_properties(spark, d), category_tree(spark, d),
                                     anchor_bounds(_train(spark, d))))
