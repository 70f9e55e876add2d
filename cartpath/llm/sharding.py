"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (operator 9).

The ring has ``bins`` equal arcs. Every shard owns ``virtual_nodes`` points on it; a row's
hash gives its arc, and the row belongs to the first virtual node clockwise. A shard takes
its own rows in ring order up to its capacity; the rest continues clockwise, first come
first served, to the next virtual node whose shard has room (a shard offers its room in
equal shares at its virtual nodes).

Everything is decided on counts per arc, a table bounded by ``bins + shards *
virtual_nodes`` rows whatever the input: the queue of overflowing rows around the circle
is a prefix sum that starts where the balance of overflow and room is least. The rows
themselves are numbered inside their arc, over written ranges of (arc, place), so that an arc with
many equal rows is cut into ranges too, and a small broadcast table of segments gives shard and slot.
Only DataFrame functions are used.

Defined cases: a null text has size 8 and crc 0; a null id is a key like any other; rows
that agree in id, size and crc share a ring position and may swap slots; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import ordered, with_position
from .common import materialize

BINS = 8192
VIRTUAL_NODES = 64


def _whole(order=None):
    """Window over a table of bounded size."""
    w = Window.partitionBy(F.lit(0))
    return w.orderBy(*order) if order else w


def _ring(counts: DataFrame, n_shards: int, virtual_nodes: int, bins: int, slack: float) -> DataFrame:
    """Segments (bin, lo, hi, shard, base): ranks lo..hi-1 of a bin go to a shard, from slot base on."""
    spark = counts.sparkSession
    arcs = (spark.range(bins).select(F.col("id").alias("bin")).join(counts, "bin", "left")
            .select("bin", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("node"),
                    F.lit(0).alias("copy"), F.coalesce("n", F.lit(0)).alias("n")))
    nodes = spark.range(n_shards * virtual_nodes).select(
        (F.col("id") % n_shards).cast("int").alias("node"), F.floor(F.col("id") / n_shards).cast("int").alias("copy"))
    nodes = nodes.select(F.pmod(F.xxhash64(F.lit("virtual node"), "node", "copy"), F.lit(bins)).alias("bin"),
                         F.lit(1).alias("kind"), "node", "copy", F.lit(0).cast("long").alias("n"))
    ring = ["bin", "kind", "node", "copy"]
    after = _whole(ring).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    upto = _whole(ring).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    items = arcs.unionByName(nodes)
    items = items.select("*", F.coalesce(
        F.first("node", ignorenulls=True).over(after),
        F.first("node", ignorenulls=True).over(_whole(ring).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    ).alias("shard"), F.sum("n").over(_whole()).alias("total"), F.row_number().over(_whole(ring)).alias("at"))
    # Capacities: floor or ceiling of the even share, or the share with slack.
    if slack:
        cap = F.ceil(F.col("total") * (1 + slack) / n_shards).cast("long")
    else:
        cap = F.expr(f"total div {n_shards}") + (F.col("shard") < F.col("total") % n_shards).cast("long")
    mine = Window.partitionBy("shard")
    before = mine.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    items = items.select("*", cap.alias("cap"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.sum("n").over(mine).alias("load"))
    items = items.withColumn("own", F.greatest(F.lit(0), F.least("n", F.col("cap") - F.col("before"))))
    room = F.greatest(F.lit(0).cast("long"), F.col("cap") - F.col("load"))
    items = items.select(
        "at", "bin", "kind", "shard", "n", "own", (F.col("n") - F.col("own")).alias("over"),
        F.when(F.col("kind") == 1, F.floor((F.col("copy") + 1) * room / virtual_nodes) - F.floor(F.col("copy") * room / virtual_nodes))
        .otherwise(0).cast("long").alias("room"))
    # The queue around the circle: start after the least balance, where it is empty.
    items = items.withColumn("balance", F.sum(F.col("over") - F.col("room")).over(upto_at()))
    items = items.select("*", F.min(F.struct("balance", "at")).over(_whole()).alias("least"),
                         F.sum(F.col("over") - F.col("room")).over(_whole()).alias("net"))
    items = items.withColumn("turn", (F.col("at") <= F.col("least.at")).cast("int"))
    turned = ["turn", "at"]
    upto_t = _whole(turned).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    items = items.withColumn("flow", F.col("balance") - F.col("least.balance") + F.col("turn") * F.col("net"))
    items = items.withColumn("queue", F.col("flow") - F.least(F.lit(0), F.min("flow").over(upto_t)))
    items = items.withColumn("served", F.lag("queue", 1, 0).over(_whole(turned)) + F.col("over") - F.col("queue"))
    prior = _whole(turned).rowsBetween(Window.unboundedPreceding, -1)
    items = items.select("*", F.coalesce(F.sum("over").over(prior), F.lit(0)).alias("over_at"),
                         F.coalesce(F.sum("served").over(prior), F.lit(0)).alias("served_at"))
    # Unit i of the overflow meets unit i of the room that is used.
    gives = items.filter("over > 0").select(F.col("over_at").alias("x"), "bin", "own", "over_at", F.lit(None).cast("int").alias("to"))
    takes = items.filter("served > 0").select(F.col("served_at").alias("x"), F.lit(None).cast("long").alias("bin"),
                                              F.lit(None).cast("long").alias("own"), F.lit(None).cast("long").alias("over_at"),
                                              F.col("shard").alias("to"))
    cuts = _whole([F.col("x"), F.col("bin").isNull(), F.col("bin"), F.col("to")])
    seen = cuts.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total_over = items.agg(F.coalesce(F.sum("over"), F.lit(0)).alias("v")).scalar()
    parts = gives.unionByName(takes).select(
        "x", F.coalesce(F.lead("x").over(cuts), total_over).alias("end"),
        *[F.last(c, ignorenulls=True).over(seen).alias(c) for c in ("bin", "own", "over_at", "to")])
    moved = parts.filter(F.col("end") > F.col("x")).select(
        "bin", (F.col("own") + F.col("x") - F.col("over_at")).alias("lo"),
        (F.col("own") + F.col("end") - F.col("over_at")).alias("hi"), F.col("to").alias("shard"))
    stay = items.filter("own > 0").select("bin", F.lit(0).cast("long").alias("lo"), F.col("own").alias("hi"), "shard")
    every = stay.unionByName(moved)
    base = Window.partitionBy("shard").orderBy("bin", "lo").rowsBetween(Window.unboundedPreceding, -1)
    return every.withColumn("base", F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(base), F.lit(0)))


def upto_at():
    return _whole(["at"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def shard_documents(docs: DataFrame, n_shards: int = 24, virtual_nodes: int = VIRTUAL_NODES, bins: int = BINS,
                    slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``slack`` 0 fills the shards to counts at most one apart; a larger value bounds a
    shard by ``(1 + slack)`` times the even share and moves fewer rows."""
    if n_shards < 1 or virtual_nodes < 1 or bins < 2 or bins & (bins - 1):
        raise ValueError("n_shards and virtual_nodes must be positive, bins a power of two")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    rows = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 32))
    rows = rows.withColumn("bin", F.shiftright("place", 32 - (bins.bit_length() - 1)))
    rows = materialize(rows, "shard-keys")  # narrow: read for the counts and for the numbering
    segments = _ring(rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n")), n_shards, virtual_nodes, bins, slack)
    # Ranges of ring places: an arc of many equal rows is cut like any other.
    ranked = with_position(ordered(rows, ["bin"], ["place", "doc_id", "text_crc32", "size"], "shard-places"), ["bin"], "rank")
    # At most 2 * bins + n_shards * virtual_nodes segments, whatever the input.
    s = F.broadcast(segments.withColumnRenamed("bin", "arc"))
    out = ranked.join(s, (ranked["bin"] == s["arc"]) & (ranked["rank"] >= s["lo"]) & (ranked["rank"] < s["hi"]))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                      (F.col("base") + F.col("rank") - F.col("lo")).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
