"""Profiles of a session table (the reference's exploratory notebook), as DataFrames.

All statistics are aggregates with map-side partial aggregation. Quantiles use Spark's
exact ``percentile``, whose buffer is a value -> count map: its size is bounded by the
number of distinct values (counts), not by the number of rows; for measures with very many
distinct values ``many=True`` finds the same quantiles over ranges of values, and ``approx=True``
uses ``percentile_approx``.
Ordered steps inside sessions (gaps, steps between carts and orders) use the skew-safe
running sums and next rows of ``functions.sequence`` over written range partitions.
Nothing is rounded here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CART, ORDER, VIEW
from ..functions.columns import pct, time_order
from ..functions.quantiles import exact_quantiles
from ..functions.sequence import PLACE, ordered, place_of, with_next, with_running_sums

TS = "timestamp"
QUANTILES = (0.25, 0.5, 0.75)
# Fixed values of the notebook: item activity bounds and the size / length thresholds.
ACTIVITY_BOUNDS = (1, 3, 5, 10, 20)
SIZE_THRESHOLDS_LT = (100, 10, 5)
SIZE_EXACT = 2
LENGTH_THRESHOLDS_MIN = (15, 30, 60, 120)


def events_per_session(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("session").agg(F.count(F.lit(1)).alias("events_count"))


def describe(df: DataFrame, col: str, approx: bool = False, many: bool = False) -> DataFrame:
    """One row: count, null_count, mean, std (sample), min, q25, q50, q75, max. ``many`` is for
    measures with very many distinct values: the same exact quantiles, found over ranges of values
    (``functions.quantiles``; ``df`` is then read twice)."""
    c = F.col(col)
    qs = list(QUANTILES)
    q = F.percentile_approx(c, qs, 1_000_000) if approx else F.percentile(c, qs)
    quantiles = [] if many and not approx else [q.alias("_q")]
    row = df.agg(F.count(c).alias("count"), F.count_if(c.isNull()).alias("null_count"),
                 F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("min"), *quantiles, F.max(c).cast("double").alias("max"))
    if not quantiles:
        row = row.withColumn("_q", exact_quantiles(df, col, qs))
    r = lambda e, n: e.cast("double").alias(n)
    return row.select("count", "null_count", r(F.col("mean"), "mean"), r(F.col("std"), "std"),
                      r(F.col("min"), "min"), r(F.col("_q")[0], "q25"), r(F.col("_q")[1], "q50"),
                      r(F.col("_q")[2], "q75"), r(F.col("max"), "max"))


def session_size_shares(eps: DataFrame) -> DataFrame:
    """One row: % of sessions with < 100, < 10, < 5 events and with exactly 2."""
    n = F.count(F.lit(1))
    c = F.col("events_count")
    cols = [pct(F.count_if(c < t), n).alias(f"pct_lt_{t}") for t in SIZE_THRESHOLDS_LT]
    cols.append(pct(F.count_if(c == SIZE_EXACT), n).alias(f"pct_eq_{SIZE_EXACT}"))
    return eps.agg(*cols)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with every bin emitted (also empty ones):
    (bin, lower, upper, n). The maximum falls in the last bin; a constant column uses
    [v - 0.5, v + 0.5] like numpy."""
    rng = df.agg(F.min(col).cast("double").alias("_mn"), F.max(col).cast("double").alias("_mx"))
    rng = rng.select(F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    # The range is a scalar subquery (one global aggregate, computed once).
    r = rng.select(F.struct("_lo", "_hi")).scalar()
    rows = df.where(F.col(col).isNotNull())
    idx = F.floor((F.col(col).cast("double") - r["_lo"]) * F.lit(float(bins)) / (r["_hi"] - r["_lo"]))
    counts = rows.select(F.least(idx, F.lit(bins - 1)).cast("long").alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    all_bins = rng.select("_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    out = all_bins.join(counts, "bin", "left")
    return out.select("bin", (F.col("_lo") + F.col("bin") * width).alias("lower"),
                      (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
                      F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def event_type_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("event").agg(F.count("event").alias("count"))


def events_per_item(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("itemid").agg(F.count("itemid").alias("events_count"))


def item_count_distribution(epi: DataFrame) -> DataFrame:
    return epi.groupBy("events_count").agg(F.count("events_count").alias("itemids_count"))


def activity_bin_labels(bounds: Sequence[int] = ACTIVITY_BOUNDS) -> list[str]:
    labels = [f"<= {bounds[0]}"]
    labels += [f"{bounds[i - 1] + 1} - {bounds[i]}" for i in range(1, len(bounds))]
    labels.append(f"> {bounds[-1]}")
    return labels


def item_activity_bins(epi: DataFrame, bounds: Sequence[int] = ACTIVITY_BOUNDS) -> DataFrame:
    """% of items per activity bin: <= b0, (b0, b1], ..., > b_last; every bin is emitted."""
    c = F.col("events_count")
    idx = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        idx = F.when(c <= bounds[i], F.lit(i)).otherwise(idx)
    labels = activity_bin_labels(bounds)
    counts = epi.select(idx.cast("long").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    total = epi.agg(F.count(F.lit(1))).scalar()
    bins = epi.sparkSession.createDataFrame([(i, s) for i, s in enumerate(labels)], "bin long, label string")
    out = bins.join(counts, "bin", "left")
    return out.select("bin", "label", pct(F.coalesce(F.col("_n"), F.lit(0)), total).alias("pct"))


def per_item_counts(sessions: DataFrame, event: str, name: str) -> DataFrame:
    return (sessions.where(F.col("event") == event)
            .groupBy("itemid").agg(F.count("itemid").alias(name)))


def item_profile(sessions: DataFrame) -> DataFrame:
    """One row an item: events, and events of each type. Everything below that is counted by item
    (A7 to A14) follows from this table, so a job that writes it scans the sessions once."""
    return sessions.groupBy("itemid").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col("event") == e).alias(f"n_{e}") for e in (VIEW, CART, ORDER)])


def _known(n: str):
    """Counts of a missing item id are zero, as ``count(itemid)`` has them."""
    return F.when(F.col("itemid").isNull(), F.lit(0)).otherwise(F.col(n)).cast("long")


def profile_events_per_item(profile: DataFrame) -> DataFrame:
    """``events_per_item`` of an ``item_profile``."""
    return profile.select("itemid", _known("n_rows").alias("events_count"))


def profile_per_item_counts(profile: DataFrame, event: str, name: str) -> DataFrame:
    """``per_item_counts`` of an ``item_profile``."""
    return profile.where(F.col(f"n_{event}") > 0).select("itemid", _known(f"n_{event}").alias(name))


def profile_item_coverage(profile: DataFrame) -> DataFrame:
    """``item_coverage`` of an ``item_profile``."""
    n = F.count("itemid")
    cols = [n.alias("n_items")]
    for e, tag in ((VIEW, "view"), (CART, "cart"), (ORDER, "order")):
        k = F.count_if(F.col(f"n_{e}") > 0)
        cols += [k.alias(f"n_{tag}_items"), pct(k, n).alias(f"pct_{tag}_items")]
    return profile.where(F.col("itemid").isNotNull()).agg(*cols)


SKETCH_BITS = 16


def daily_sketches(sessions: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One row a day and event type with sketches of its sessions and items (HyperLogLog, 2^bits
    registers: a standard error of about 1.04 / 2^(bits / 2), 0.4 % at 16). Sketches of any days and
    types are put together by ``distinct_of_sketches``, so distinct counts of a window read a
    few rows instead of the events, and a new day only adds its own."""
    day = F.floor(F.col(TS) / 86400).cast("long")
    return sessions.groupBy(day.alias("day"), "event").agg(
        F.hll_sketch_agg("session", F.lit(bits)).alias("sessions"), F.hll_sketch_agg("itemid", F.lit(bits)).alias("items"))


def distinct_of_sketches(sketches: DataFrame) -> DataFrame:
    """One row: n_sessions and n_items over all rows of ``daily_sketches`` given (filter them to a
    window of days or to event types first)."""
    return sketches.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(f"n_{c}") for c in ("sessions", "items")])


def distinct_counts(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.count_distinct("session").alias("n_sessions"),
                        F.count_distinct("itemid").alias("n_items"))


def item_coverage(sessions: DataFrame) -> DataFrame:
    """Distinct items overall and with a view / cart / order, with their share in %."""
    per_item = sessions.groupBy("itemid").agg(
        *[F.max((F.col("event") == e).cast("int")).alias(f"_{e}") for e in (VIEW, CART, ORDER)])
    n = F.count("itemid")
    cols = [n.alias("n_items")]
    for e, tag in ((VIEW, "view"), (CART, "cart"), (ORDER, "order")):
        k = F.sum(F.col(f"_{e}")).cast("long")
        cols += [F.coalesce(k, F.lit(0).cast("long")).alias(f"n_{tag}_items"), pct(k, n).alias(f"pct_{tag}_items")]
    return per_item.where(F.col("itemid").isNotNull()).agg(*cols)


def session_length(sessions: DataFrame) -> DataFrame:
    """(session, session_length_minutes) = (last - first timestamp) / 60."""
    ext = sessions.groupBy("session").agg(F.min(TS).alias("_mn"), F.max(TS).alias("_mx"))
    return ext.select("session", ((F.col("_mx") - F.col("_mn")) / 60.0).alias("session_length_minutes"))


def session_length_shares(lengths: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    c = F.col("session_length_minutes")
    return lengths.agg(*[pct(F.count_if(c < t), n).alias(f"pct_lt_{t}_min") for t in LENGTH_THRESHOLDS_MIN])


def longest_session_events(sessions: DataFrame, lengths: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """All events of the longest session (ties: smallest session id), in time order."""
    top = lengths.orderBy(F.col("session_length_minutes").desc(), F.col("session").asc()).limit(1)
    # A top-1 result: one row, so the broadcast is bounded.
    rows, order = time_order(sessions, tie)
    return rows.join(F.broadcast(top.select("session")), "session", "left_semi").orderBy(*order).select(*sessions.columns)


def inter_event_gaps(sessions: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Seconds from each event to the next one of the same session."""
    rows, order = time_order(sessions, tie)
    rows = ordered(rows.select("session", *order, *place_of(rows)), ["session"], order, "gaps")
    nxt = with_next(rows, ["session"], [TS])
    return nxt.where("next_found").select((F.col(f"next_{TS}") - F.col(TS)).alias("time_between_sec"))


def clicks_between_carts(sessions: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """(session, delta_index): steps between consecutive carts of a session, after removing
    orders, the last remaining event of each session and all but the last of a run of
    carts of the same item (the notebook's definition). The sessions are read once."""
    keyed, order = time_order(sessions, tie)
    rows = keyed.where(F.col("event") != ORDER).select("session", *dict.fromkeys([*order, "event", "itemid", *place_of(keyed)]))
    rows = with_next(ordered(rows, ["session"], order, "cart-steps"), ["session"], ["event", "itemid"])
    repeat = ((F.col("event") == CART) & (F.col("next_event") == CART) & (F.col("itemid") == F.col("next_itemid")))
    rows = rows.where(F.col("next_found") & ~F.coalesce(repeat, F.lit(False))).select("session", "event", *PLACE)
    # The kept rows keep their places, so no second ordering is needed.
    return _step_deltas(rows, F.col("event") == CART).select("session", "delta_index")


def clicks_between_orders(sessions: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """(delta_index): steps between consecutive orders of a session, after removing carts
    and collapsing rows equal in (session, timestamp, event) to their first occurrence."""
    keyed, order = time_order(sessions, tie)
    ties = [c for c in order if c != TS]
    rows = (keyed.where(F.col("event") != CART)
            .groupBy("session", TS, "event").agg(F.min(F.struct(*ties)).alias("_first")))
    rows = ordered(rows, ["session"], [TS, "_first"], "order-steps", unique="seq" in ties)
    return _step_deltas(rows, F.col("event") == ORDER).select("delta_index")


def _step_deltas(rows: DataFrame, marker) -> DataFrame:
    """(session, delta_index): for each marked ``ordered`` row with a later marked row in its
    session, the difference of their positions.

    A running count of marked rows splits a session into segments, each starting at a
    marked row; a segment's row count is the step to the next marked row, so the deltas
    are a partial aggregate. The session's last segment, known by its total, does not count."""
    numbered = with_running_sums(rows, ["session"], {"_seg": marker.cast("long")}, totals=["_seg"])
    return (numbered.where((F.col("_seg") >= 1) & (F.col("_seg") < F.col("_seg_total")))
            .groupBy("session", "_seg").agg(F.count(F.lit(1)).alias("delta_index")).select("session", "delta_index"))
