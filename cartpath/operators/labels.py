"""Ground truth and the cut of test sessions (the reference's ``testset_labels``).

For an event at 0-based position i of a session, its labels are the items of the cart
events and of the order events strictly after i. A session of n >= 2 events is cut after
``split_idx`` events: with p the position of the session's last cart or order event, the
last event that still has a label is ``last_possible_idx = p - 1`` (0 if there is none or
p < 2), and ``split_idx`` is 1 when that is 0, else a draw from 1..last_possible_idx. The
labels of the cut are the items of cart/order events at positions >= split_idx.

The draw is keyed by (seed, session) through md5, so it does not depend on partitioning or
on the order in which sessions are visited (the reference walks one global generator over
an unordered group-by, which no seed pins down).

Spark formulation: positions come from the skew-safe ``with_position`` (written range
partitions), per-session decisions are aggregates, and the cut is one join of the rows with a
one-row-per-session table. Per-event label sets are represented linearly by a label index
(session, event, itemid, last_pos): item x is a label of event i iff last_pos(x) > i. Cut into
chunks of positions, the index gives the sets themselves: an event's set is the tail of its
own chunk and every later chunk of its session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CART, LABEL_EVENTS, ORDER, SEED
from ..functions.columns import keyed_draw, time_order
from ..functions.sequence import PLACE, in_order, ordered, with_group_values, with_position, with_running_sums, without_place

TS = "timestamp"
#: Positions of a session whose label items stand in one array.
CHUNK = 4096
#: Events of a session in one list.
LIST_LIMIT = 100_000


def is_label():
    return F.col("event").isin(*LABEL_EVENTS)


def _positioned(rows: DataFrame, tie: str | Sequence[str] | None) -> DataFrame:
    """``session_positions`` with the rows' places, which the order by ``pos`` follows as well."""
    keyed, order = time_order(rows, tie)
    placed = with_position(ordered(keyed, ["session"], order, "positions"), ["session"])
    return in_order(placed.select(*without_place(rows).columns, "pos", *PLACE), ["session", "pos"])


def session_positions(rows: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Each event with its 0-based ``pos`` in the session (time, then ``tie``): the long
    form of the per-session event lists. Rows equal in time and tie get positions in the
    order they are written in, once; everything later goes by ``pos``."""
    return without_place(_positioned(rows, tie))


def label_index(positioned: DataFrame) -> DataFrame:
    """(session, event, itemid, last_pos) for every cart/order item of a session."""
    return (positioned.where(is_label())
            .groupBy("session", "event", "itemid").agg(F.max("pos").alias("last_pos")))


def ground_truth_counts(positioned: DataFrame) -> DataFrame:
    """Every event but the last of each session with the number of distinct cart items
    and order items after it (the sizes of its label sets).

    An item counts for event i iff its last occurrence is after i, so the count is the
    session's "last occurrence" markers less those up to and including i: a running sum
    in the order of ``pos``, which is unique in a session, and the session's total."""
    rows = ordered(positioned.select("session", "pos", TS, "event", "itemid"), ["session"], ["pos"], "ground-truth", unique=True)
    ends = label_index(rows).groupBy("session", F.col("last_pos").alias("pos")).agg(
        F.count_if(F.col("event") == CART).alias("_c_end"),
        F.count_if(F.col("event") == ORDER).alias("_o_end"))
    rows = rows.join(ends, ["session", "pos"], "left")
    sums = {"_c": F.coalesce("_c_end", F.lit(0)), "_o": F.coalesce("_o_end", F.lit(0)), "_n": F.lit(1)}
    rows = with_running_sums(rows, ["session"], sums, totals=list(sums))
    return (rows.where(F.col("pos") < F.col("_n_total") - 1)
                .select("session", "pos", TS, "event", "itemid",
                        (F.col("_c_total") - F.col("_c")).alias("n_cart_labels"),
                        (F.col("_o_total") - F.col("_o")).alias("n_order_labels")))


def label_chunks(positioned: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The label index in pieces: (session, chunk, last, carts, orders) with the (last_pos, itemid)
    of the cart and of the order items whose last occurrence is at positions chunk * ``chunk`` up
    to the next chunk, in order of position; ``last`` is the largest of these positions. A piece
    holds at most ``chunk`` items, whatever the session's length, and all pieces together one entry
    for each item of a session and type."""
    if chunk < 1:
        raise ValueError("a chunk holds at least one position")
    entry = F.struct("last_pos", "itemid")

    def items(event: str):
        return F.array_sort(F.collect_list(F.when(F.col("event") == event, entry)))

    return (label_index(positioned).withColumn("chunk", F.floor(F.col("last_pos") / chunk).cast("long"))
            .groupBy("session", "chunk").agg(F.max("last_pos").alias("last"), items(CART).alias("carts"), items(ORDER).alias("orders")))


def ground_truth_sets(positioned: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The label sets of every event but the last of each session: (session, pos, chunk,
    cart_items, order_items), one row for each chunk of the session with a label after the
    event; an event without labels has one row, with nulls.

    Of the chunk that the event stands in, its items are those that occur last behind it, of a
    later chunk all. An item stands in one chunk of a session, so an event's rows are disjoint
    and their union is its set. No row holds more than ``chunk`` items, and the rows of events
    meet the pieces in one join by session (whose row side AQE can split), with no window."""
    ends = positioned.groupBy("session").agg(F.max("pos").alias("_end"))
    pieces = label_chunks(positioned, chunk).withColumnRenamed("session", "_session")
    rows = positioned.select("session", "pos").join(ends, "session").where(F.col("pos") < F.col("_end"))
    rows = rows.join(pieces, (F.col("session") == F.col("_session")) & (F.col("last") > F.col("pos")), "left")

    def behind(items: str):
        later = F.filter(items, lambda x: x["last_pos"] > F.col("pos"))
        return F.transform(later, lambda x: x["itemid"])

    return rows.select("session", "pos", "chunk", behind("carts").alias("cart_items"), behind("orders").alias("order_items"))


def whole_sets(sets: DataFrame) -> DataFrame:
    """One row for each event of ``ground_truth_sets``: its whole sets, sorted (null: no items). An
    array is then as large as the set: at most the catalogue."""
    def whole(items: str):
        return _nonempty(F.array_sort(F.flatten(F.collect_list(items)))).alias(items)

    return sets.groupBy("session", "pos").agg(whole("cart_items"), whole("order_items"))


def session_event_lists(rows: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """The per-session event lists of positioned rows: (session, start, events), events in order
    of position. A session of more than ``limit`` events goes on in further records: ``start`` is
    the position of a record's first event (null for the first record), so no list, and no
    task's group, is longer than ``limit``."""
    if limit < 1:
        raise ValueError("a list holds at least one event")
    event = F.struct("pos", "itemid", TS, "event")
    part = F.floor(F.col("pos") / limit).cast("long")
    lists = rows.groupBy("session", part.alias("_part")).agg(F.array_sort(F.collect_list(event)).alias("_events"))
    bare = F.transform("_events", lambda e: F.struct(e["itemid"].alias("itemid"), e[TS].alias(TS), e["event"].alias("event")))
    return lists.select("session", F.when(F.col("_part") > 0, F.col("_part") * limit).alias("start"), bare.alias("events"))


def _with_split_idx(per: DataFrame, seed: int) -> DataFrame:
    """Add last_possible_idx and split_idx to rows with session and last_label_pos."""
    last_possible = F.when(F.col("last_label_pos") >= 2, F.col("last_label_pos") - 1).otherwise(F.lit(0))
    per = per.withColumn("last_possible_idx", last_possible.cast("long"))
    draw = F.pmod(keyed_draw(F.col("session"), seed), F.greatest(F.col("last_possible_idx"), F.lit(1)))
    split = F.when(F.col("last_possible_idx") == 0, F.lit(1)).otherwise(1 + draw)
    return per.withColumn("split_idx", split.cast("long"))


def split_points(positioned: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per session with at least 2 events: n_events, last_label_pos,
    last_possible_idx, split_idx."""
    per = positioned.groupBy("session").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max(F.when(is_label(), F.col("pos"))).alias("last_label_pos"))
    return _with_split_idx(per.where(F.col("n_events") >= 2), seed)


def cut_rows(rows: DataFrame, seed: int = SEED, tie: str | Sequence[str] | None = None) -> DataFrame:
    """The positioned rows of all sessions with at least 2 events, each with its session's
    n_events, last_label_pos, last_possible_idx and split_idx. The rows are exchanged once, to
    be ordered (not at all where they are an ordered table already): what a session decides
    comes from its range's windows and the broadcast ends of ranges, not from a join by session."""
    placed = with_group_values(_positioned(rows, tie), ["session"], {
        "n_events": (F.sum, F.lit(1).cast("long")), "last_label_pos": (F.max, F.when(is_label(), F.col("pos")))})
    return _with_split_idx(without_place(placed).where(F.col("n_events") >= 2), seed)


def points_of(cut: DataFrame) -> DataFrame:
    """The split points of ``cut_rows``: one row per session."""
    return cut.where(F.col("pos") == 0).select("session", "n_events", "last_label_pos", "last_possible_idx", "split_idx")


def with_split(positioned: DataFrame, points: DataFrame) -> DataFrame:
    """Rows of cut sessions with their session's ``split_idx`` (one join per session key;
    AQE splits a hot session's partition of the row side)."""
    return positioned.join(points.select("session", "split_idx"), "session")


def trimmed_sessions(cut_rows: DataFrame) -> DataFrame:
    """The kept prefix: events at positions < split_idx."""
    return (cut_rows.where(F.col("pos") < F.col("split_idx"))
                    .select("session", "pos", "itemid", TS, "event"))


def _nonempty(arr):
    return F.when(F.size(arr) > 0, arr)


def test_labels(cut_rows: DataFrame, points: DataFrame) -> DataFrame:
    """(session, addtocart, transaction): sorted distinct items after the cut; a type with
    no item is null (its key is absent in the JSON labels file). The arrays hold distinct
    item ids, so their size is bounded by the catalogue, not by the session's length."""
    later = cut_rows.where((F.col("pos") >= F.col("split_idx")) & is_label())
    sets = later.groupBy("session").agg(
        _nonempty(F.array_sort(F.collect_set(F.when(F.col("event") == CART, F.col("itemid"))))).alias(CART),
        _nonempty(F.array_sort(F.collect_set(F.when(F.col("event") == ORDER, F.col("itemid"))))).alias(ORDER))
    return points.select("session").join(sets, "session", "left")


def cut_test_set(test: DataFrame, seed: int = SEED,
                 tie: str | Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Test set -> (trimmed events, labels, split points)."""
    cut = cut_rows(test, seed, tie)
    return trimmed_sessions(cut), test_labels(cut, points_of(cut)), points_of(cut)


def cut_at(test: DataFrame, split_idx: DataFrame,
           tie: str | Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cut sessions at a given (session, split_idx) instead of the draw (the reference's
    ``split_events(events, split_idx)``) -> (trimmed events, labels)."""
    positioned = session_positions(test, tie)
    cut = with_split(positioned, split_idx)
    return trimmed_sessions(cut), test_labels(cut, split_idx)
