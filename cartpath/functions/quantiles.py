"""Exact quantiles without a map of all values in one task.

Spark's ``percentile`` merges value -> count maps; with very many distinct values the last map does
not fit a task. Here the values are counted (partial counts, one row a value), the counts are
ranged by value and written, and a running count over the ranges gives each value its ranks:
the rows that hold the wanted ranks are picked by a filter. A task sorts its range only, which
spills, and what is broadcast is one row a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import ordered, with_running_sums


def value_ranks(df: DataFrame, col: str, num_partitions: int | None = None) -> DataFrame:
    """(value, n, upto, total): each distinct value (not null) with its count, the number of rows
    up to it in ascending order, and of all rows."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("_all", F.lit(0)))
    rows = ordered(counts, ["_all"], ["value"], "value-counts", num_partitions, unique=True)
    return with_running_sums(rows, ["_all"], {"upto": F.col("n")}, totals=["upto"]).select(
        "value", "n", "upto", F.col("upto_total").alias("total"))


def exact_quantiles(df: DataFrame, col: str, quantiles: Sequence[float], num_partitions: int | None = None) -> Column:
    """The quantiles of a column as an array (a scalar subquery), linear between the two nearest
    ranks as ``percentile`` has them; null where there is no value."""
    ranks = value_ranks(df, col, num_partitions)
    place = [(F.col("total") - 1) * F.lit(float(q)) for q in quantiles]

    def at(rank: Column) -> Column:
        """The value whose ranks, counted from 0, include ``rank``."""
        return F.max(F.when((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")), F.col("value").cast("double")))

    found = ranks.agg(F.max("total").alias("total"), *[at(f(x)).alias(f"{name}{i}") for i, x in enumerate(place)
                                                       for name, f in (("low", F.floor), ("high", F.ceil))])

    def between(i: int) -> Column:
        low, high, x = F.col(f"low{i}"), F.col(f"high{i}"), place[i]
        return F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return found.select(F.array(*[between(i) for i in range(len(quantiles))])).scalar()
