"""Mixing sources to target weights along a time-varying curriculum (operator 1).

Every source gets a target of words: a share by weight of ``budget`` times all words,
capped at ``cap`` times its own words, the excess shared again by weight (one level at
which ``min(cap, level * weight)`` sums to the budget). Its weight changes over the run:
a schedule of knots is integrated to a cumulative demand, and a document that starts at
word ``c`` of its source's shuffled stream stands at the training position where the
demand reaches ``c`` (the inverse of the integral, a quadratic per piece). Documents are
then range-sorted by position.

The stream of a source is ordered by a hash of the id. Offsets in it are running sums over
written ranges of (source, hash, place), so a source with a third of all rows, and one row
that is repeated as often, are cut into ranges like any others. Only the table of sources (one
row each) is ordered as a whole; it is broadcast if it is small and else joined with salts.

Defined cases: null or empty texts have size 0 and are never taken; a null source is a
source of its own, last in order; rows equal in id, size and source are interchangeable;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import ordered, with_running_sums
from .common import join_few, materialize, pass_id, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Relative weight at evenly spaced knots of the run, repeating over the sources:
#: early, steady and late sources.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
KEY_BITS = 60


def demand_position(share: Column, knots: Sequence[float]) -> Column:
    """Training position in [0, 1] at which the integral of the schedule reaches ``share`` of its total."""
    if len(knots) < 2 or min(knots) < 0 or max(knots) <= 0:
        raise ValueError("a schedule needs two knots, none negative, one positive")
    step = 1.0 / (len(knots) - 1)
    area = sum((a + b) / 2 * step for a, b in zip(knots, knots[1:]))
    out, done = None, 0.0
    for i, (a, b) in enumerate(zip(knots, knots[1:])):
        a, b = a / area, b / area
        rest = F.greatest(F.lit(0.0), share - F.lit(done))
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + rest * F.lit(2 * (b - a) / step)))
        here = F.lit(i * step) + F.least(F.lit(step), F.when(rest == 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(a) + root)))
        done += (a + b) / 2 * step
        out = F.when(share < F.lit(done), here) if out is None else out.when(share < F.lit(done), here)
    return out.otherwise(F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> also turn (rank of the source), weight and target."""
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    t = sizes.withColumn("turn", F.row_number().over(by_name) - 1).withColumn("weight", w)
    t = t.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    level = everything.orderBy(F.col("most") / F.col("weight"), "turn")
    t = t.select(
        "*", F.sum("source_size").over(everything).alias("all"),
        F.coalesce(F.sum("most").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("below"),
        F.sum("weight").over(level.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("above"))
    t = t.withColumn("level", (F.col("all") * F.lit(float(budget)) - F.col("below")) / F.col("above"))
    t = t.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"),
                                           F.struct(F.col("most") / F.col("weight"), "turn", "level"))).over(everything)["level"])
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return t.select("source", "source_size", "turn", "weight", target.alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.5, cap: float = 2.0,
                schedules: Sequence[Sequence[float]] = SCHEDULES, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken and the
    training positions of its first and second pass (null where it is not taken).

    ``cap`` is at most 2 here: a source is read twice at most. A document that crosses its
    source's target counts up to it, so the words taken of a source are its target rounded
    down. ``keep`` names further columns to carry."""
    if not 0 < cap <= 2:
        raise ValueError("cap must be in (0, 2]")
    if min(weights) <= 0:
        raise ValueError("weights must be positive")
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", F.col("source").alias("source"), size.alias("size"), *keep)
    digest = F.md5(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("size").cast("string")))
    rows = rows.withColumn("key", F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long"))
    # A source may be null.
    rows = rows.withColumns({"none": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))})
    rows = materialize(rows, "mix-keys")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, budget, cap).withColumnRenamed("source", "_ts")
    # Words before a document in its source's shuffled stream, over ranges of the stream.
    stream = ordered(rows, ["none", "name"], ["key", "doc_id", "size", *keep], "mix-stream")
    stream = with_running_sums(stream, ["none", "name"], {"upto": F.col("size")})
    out = join_few(stream, materialize(targets, "mix-targets"), "source", "_ts")
    c, whole = F.col("upto") - F.col("size"), F.floor("target").cast("long")
    take = [F.greatest(F.lit(0), F.least("size", whole - c - k * F.col("source_size"))).cast("long") for k in range(2)]
    share = [(c + k * F.col("source_size")) / F.col("target") for k in range(2)]

    def position(x: Column) -> Column:
        p = None
        for i, knots in enumerate(schedules):
            at = F.col("turn") % len(schedules) == i
            p = F.when(at, demand_position(x, knots)) if p is None else p.when(at, demand_position(x, knots))
        return p

    return out.select("doc_id", "source", "size", "source_size", "target", (take[0] + take[1]).alias("taken"),
                      *[F.when(take[k] > 0, position(share[k])).alias(f"position{k + 1}") for k in range(2)], *keep)


def training_order(docs: DataFrame, **how) -> DataFrame:
    """The documents the mix takes, a row for each pass, range-sorted by training position."""
    docs = stored(docs, "documents")
    mixed = mix_sources(pass_id(docs, "_llm_row"), keep=("_llm_row",), **how)
    passes = mixed.select("_llm_row", F.explode(F.array_compact(F.array("position1", "position2"))).alias("_llm_position"))
    return (pass_id(docs, "_llm_row").join(passes, "_llm_row").orderBy("_llm_position", "doc_id", "_llm_row").select(*docs.columns))
