"""Ordered steps inside large groups without putting a whole group into one task.

A window ``partitionBy(session).orderBy(time)`` sends every row of a session to one task;
one bot session can hold a large share of all rows, even of one second. Here the rows are
range-partitioned by (group, order) and sorted, and written once with the number of their
range partition and their row number in it. Sampled bounds spread a hot group over as many
partitions as its share of the rows asks for, whatever the burst: rows equal in every order
column are told apart by their place in the source (unless the order ends in a unique
sequence), so one click repeated a million times within a second spreads like any others.

That range partitioning is the only exchange of the rows. The written table is bucketed by
range number, so Spark knows that a range's rows lie together, and windows over (group, range)
just sort what a task has read. Rows are in group order, so only the first and the last
group of a range can go on in another one: a summary of at most two rows a range, whose size the
number of ranges bounds, is broadcast and stitches them. Running sums add the totals of
earlier ranges, the row before a range's first row is the last row of the range before.

Being written, the order is also total and fixed: rows equal in every order column keep
the place they were written at, and every step that reads the table agrees on it. Steps
can be filtered and chained; no second table is written for them. The order is noted with the
range number's column, so that ``ordered`` knows such a table (also one read back from
a folder, ``read_ordered``) and neither exchanges nor writes its rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import shuffle_partitions
from .bucketing import bucket_table
from .materialize import bucketed, is_stored, materialize

PART, ROW, BUCKET = "_part", "_row", "_bucket"
#: Where a row lies; a step that narrows the columns keeps these.
PLACE = [PART, ROW, BUCKET]
_TIE = "_tie_place"
_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row inside partition


def in_order(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Note that the places of ``df`` follow ``cols`` (of an ``ordered`` table that was filtered
    to equal values of the columns in front of them)."""
    if buckets is None:
        buckets = df.schema[PART].metadata["buckets"]
    note = {"order": list(cols), "buckets": buckets}
    return df.withColumn(PART, F.col(PART).alias(PART, metadata=note))


def is_ordered(df: DataFrame, cols: Sequence[str]) -> bool:
    """Whether ``df`` is an ``ordered`` table, or comes from one by steps that keep places, whose
    order begins with ``cols``."""
    if not set(PLACE) <= set(df.columns):
        return False
    return df.schema[PART].metadata.get("order", [])[:len(cols)] == list(cols)


def place_of(df: DataFrame) -> list[str]:
    """The columns that a step has to keep beside its own: the places, where ``df`` has them."""
    return [c for c in PLACE if c in df.columns]


def without_place(df: DataFrame) -> DataFrame:
    return df.drop(*PLACE)


def ordered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "ordered",
            num_partitions: int | None = None, unique: bool | None = None, path: str | None = None) -> DataFrame:
    """``df`` in (group, order) order, written with its range partition and row number; as it
    is where it has that order already.

    ``unique``: whether the order columns tell all rows of a group apart (by default where
    ``seq`` is one of them). Else the row's place in ``df`` is the last order column; ``df`` is
    written first unless it is a scan of files, so that this place is the same in every attempt.
    ``path``: a folder to keep the table in (see ``read_ordered``) instead of an intermediate one."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    cols = [*group, *order]
    if is_ordered(df, cols) and path is None:
        return df
    note, df = cols, without_place(df)
    if not ("seq" in order if unique is None else unique):
        df = df if is_stored(df) else materialize(df, f"{name}-source")
        df = df.withColumn(_TIE, F.monotonically_increasing_id())
        cols = [*cols, _TIE]
    rows = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).drop(_TIE)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn(PART, F.shiftrightunsigned("_mid", _ROW_BITS))
              .withColumn(ROW, F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
              .drop("_mid"))
    # One row a range, as many as the partitions asked for.
    rows = rows.join(F.broadcast(bucket_table(spark, n, PART, BUCKET)), PART)
    buckets = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    return materialize(in_order(rows, note, buckets), name, buckets=(buckets, BUCKET), path=path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The ``ordered`` table in a folder, its buckets and order known again."""
    schema = spark.read.parquet(path).schema
    note = schema[PART].metadata
    return in_order(bucketed(spark, path, schema, note["buckets"], BUCKET), note["order"], note["buckets"])


def _of_range(group: Sequence[str]):
    """The rows of a group in one range: a window that needs no exchange of ``ordered`` rows."""
    return Window.partitionBy(*group, PART, BUCKET)


def _ends(rows: DataFrame, group: Sequence[str], aggregates: dict) -> DataFrame:
    """(_part, group, aggregates) of the first and the last group of each range: at most two rows
    a range. The groups between them end inside their range."""
    parts = rows.groupBy(*group, PART, BUCKET).agg(*[a.alias(n) for n, a in aggregates.items()])
    key, item = F.struct(*group), F.struct(*group, *aggregates)
    ends = parts.groupBy(PART, BUCKET).agg(F.array_distinct(F.array(F.min_by(item, key), F.max_by(item, key))).alias("_e"))
    return ends.select(PART, F.inline("_e"))


def with_group_values(rows: DataFrame, group: Sequence[str], values: dict) -> DataFrame:
    """Add values of the whole ``group`` to ``ordered`` rows: ``values`` maps each output column to
    (aggregate, expression), the aggregate being one that puts partial results together itself
    (``F.sum``, ``F.min``, ``F.max``). No row is exchanged."""
    group, names = list(group), list(values)
    rows = rows.select("*", *[values[n][1].alias(f"_v{i}") for i, n in enumerate(names)])
    ends = _ends(rows, group, {f"_w{i}": values[n][0](f"_v{i}") for i, n in enumerate(names)})
    whole = ends.groupBy(*group).agg(*[values[n][0](f"_w{i}").alias(f"_all{i}") for i, n in enumerate(names)])
    rows = rows.select("*", *[values[n][0](f"_v{i}").over(_of_range(group)).alias(f"_own{i}") for i, n in enumerate(names)])
    # At most two rows a range: a proven bound.
    out = rows.join(F.broadcast(whole), group, "left")
    out = out.select("*", *[F.coalesce(f"_all{i}", f"_own{i}").alias(n) for i, n in enumerate(names)])
    return out.drop(*[f"_{k}{i}" for i in range(len(names)) for k in ("v", "all", "own")])


def with_running_sums(rows: DataFrame, group: Sequence[str], values: dict, totals: Sequence[str] = ()) -> DataFrame:
    """Add running (inclusive) sums inside ``group`` to ``ordered`` rows: ``values`` maps each
    output column to a value expression. For the outputs named in ``totals`` the group's
    whole sum is added too, as ``<name>_total``."""
    group, names = list(group), list(values)
    rows = rows.select("*", *[values[n].alias(f"_v{i}") for i, n in enumerate(names)])
    ends = _ends(rows, group, {f"_tot{i}": F.sum(f"_v{i}") for i in range(len(names))})
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    stitch = ends.select(
        *group, PART, *[F.coalesce(F.sum(f"_tot{i}").over(earlier), F.lit(0)).alias(f"_off{i}") for i in range(len(names))],
        *[F.sum(f"_tot{names.index(n)}").over(of_group).alias(f"_all{names.index(n)}") for n in totals])
    run = _of_range(group).orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(f"_v{i}").over(run).alias(f"_run{i}") for i in range(len(names))],
                       *[F.sum(f"_v{names.index(n)}").over(_of_range(group)).alias(f"_own{names.index(n)}") for n in totals])
    # At most two rows a range: a proven bound.
    out = rows.join(F.broadcast(stitch), [*group, PART], "left")
    for i, n in enumerate(names):
        out = out.withColumn(n, (F.coalesce(f"_off{i}", F.lit(0)) + F.col(f"_run{i}")).cast("long"))
    for n in totals:
        i = names.index(n)
        out = out.withColumn(f"{n}_total", F.coalesce(f"_all{i}", f"_own{i}").cast("long"))
    return out.drop(*[f"_{k}{i}" for i in range(len(names)) for k in ("v", "run", "off", "own", "all")])


def with_position(rows: DataFrame, group: Sequence[str], out: str = "pos") -> DataFrame:
    """0-based position of each ``ordered`` row inside its group (a skew-safe row_number)."""
    return with_running_sums(rows, group, {out: F.lit(1).cast("long")}).withColumn(out, F.col(out) - 1)


def _beside(rows: DataFrame, group: Sequence[str], cols: Sequence[str], prefix: str, ahead: bool) -> DataFrame:
    group, cols = list(group), list(cols)
    step = F.lead if ahead else F.lag
    key, here = F.struct(*group), F.struct(*cols)
    found = rows.withColumn("_in", step(here).over(_of_range(group).orderBy(ROW)))
    # One row a range: its first and last row. The next range's first row (or the one before's last) may go on.
    mine, other = (F.max_by, F.min_by) if ahead else (F.min_by, F.max_by)
    ends = rows.groupBy(PART, BUCKET).agg(
        (F.max if ahead else F.min)(ROW).alias("_at"), mine(key, ROW).alias("_key"),
        other(key, ROW).alias("_other_key"), other(here, ROW).alias("_other"))
    by_range = Window.orderBy(PART)
    ends = ends.select(PART, "_at", "_key", step("_other_key").over(by_range).alias("_next_key"), step("_other").over(by_range).alias("_next"))
    ends = ends.where(F.col("_key") == F.col("_next_key")).select(PART, "_at", F.col("_next").alias("_out"))
    found = found.join(F.broadcast(ends), PART, "left")
    value = F.coalesce(F.col("_in"), F.when(F.col(ROW) == F.col("_at"), F.col("_out")))
    return found.select(*rows.columns, value.isNotNull().alias(prefix + "found"), *[value[c].alias(prefix + c) for c in cols])


def with_next(rows: DataFrame, group: Sequence[str], cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """Attach ``cols`` of the next ``ordered`` row of the group (null after the last) and
    ``<prefix>found``."""
    return _beside(rows, group, cols, prefix, True)


def with_previous(rows: DataFrame, group: Sequence[str], cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Attach ``cols`` of the previous ``ordered`` row of the group (null before the first)
    and ``<prefix>found``."""
    return _beside(rows, group, cols, prefix, False)
