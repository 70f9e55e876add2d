"""Column expressions: all built-in Spark functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CART, VIEW


def epoch_seconds(col: Column, dtype: T.DataType) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp, rounded down, independent of the
    session time zone for wall-clock (NTZ) values."""
    if isinstance(dtype, T.TimestampNTZType):
        # Wall-clock value taken as UTC, whatever the session time zone is.
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(col)
    return col.cast("long")


def ms_to_seconds(col: Column) -> Column:
    """Millisecond epoch to whole seconds (floor division)."""
    return F.floor(col / F.lit(1000)).cast("long")


def empty_long_array() -> Column:
    return F.array().cast(T.ArrayType(T.LongType()))


def ids_text(arr: Column) -> Column:
    """A set of ids as sorted, comma-joined text (stable for comparisons and reports);
    null for a missing or empty set."""
    return F.when(F.size(arr) > 0, F.array_join(F.array_sort(arr), ","))


def keyed_draw(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random non-negative integer per key (first 32 bits of md5).

    Stable under any partitioning, unlike one generator walked over the rows."""
    digest = F.md5(F.concat(F.lit(str(seed)), F.lit("-"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hits_at_k(labels: Column, preds: Column, k: int) -> Column:
    """Number of unique ids among the first k predictions that are labels; null when the
    labels or the predictions are missing or empty."""
    return F.when(
        (F.coalesce(F.size(labels), F.lit(0)) > 0) & (F.coalesce(F.size(preds), F.lit(0)) > 0),
        F.size(F.array_intersect(F.slice(preds, 1, k), labels)).cast("long"),
    )


def first_hit_rank(labels: Column, preds: Column) -> Column:
    """1-based rank of the first prediction that is a label (no cut at k); null if none."""
    # The intersection keeps the order of its first argument, so its head is the first hit.
    return F.array_position(preds, F.get(F.array_intersect(preds, labels), F.lit(0)))


def pct(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double"))


def time_order(df: DataFrame, tie: str | Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` and its order columns: time, then the tie columns.

    ``tie`` names one column or several; by default ``seq`` where the table has it, else
    the event's rank (view, cart, order) and the item, in helper columns ``_tie0`` and
    ``_tie1`` that are added (items that are text go by their number first, ``_tie1``, then as text,
    ``_tie2``)."""
    if tie is not None:
        return df, ["timestamp", *([tie] if isinstance(tie, str) else tie)]
    if "seq" in df.columns:
        return df, ["timestamp", "seq"]
    rank = F.when(F.col("event") == VIEW, 0).when(F.col("event") == CART, 1).otherwise(2)
    df = df.withColumn("_tie0", rank)
    if isinstance(df.schema["itemid"].dataType, T.StringType):
        df = df.withColumn("_tie1", F.col("itemid").try_cast("long")).withColumn("_tie2", F.col("itemid"))
        return df, ["timestamp", "_tie0", "_tie1", "_tie2"]
    return df.withColumn("_tie1", F.col("itemid")), ["timestamp", "_tie0", "_tie1"]
