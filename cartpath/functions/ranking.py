"""Dense 1..N ids in a global order without a single-partition window.

``dense_rank().over(Window.orderBy(...))`` moves every row into one partition. Here the
keys are range-partitioned (Spark samples the key distribution, so a hot prefix is spread
over several partitions), sorted inside each partition and numbered locally; the per
partition row counts (one row per partition, so bounded by the partition count) are turned
into offsets by a tiny window and broadcast back.

The locally numbered keys are written once (one row per key, a small table next to the
events) and both the counts and the numbering read that table: the two branches cannot
disagree on which key sits in which partition, whatever the exchange-reuse settings or
retries, and a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import shuffle_partitions
from .materialize import materialize

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row inside partition


def with_dense_id(keys: DataFrame, order: Sequence[str], out: str = "id",
                  num_partitions: int | None = None) -> DataFrame:
    """Number the (unique) rows of ``keys`` 1..N in ``order``."""
    n = num_partitions or shuffle_partitions(keys.sparkSession)
    ranged = (keys.repartitionByRange(n, *order)
                  .sortWithinPartitions(*order)
                  .withColumn("_mid", F.monotonically_increasing_id())
                  .withColumn("_part", F.shiftrightunsigned("_mid", _ROW_BITS))
                  .withColumn("_row", F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    ranged = materialize(ranged, "dense-id-keys")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # ``offsets`` has at most ``n`` rows (n = the shuffle partition count): a proven bound,
    # so broadcasting it is safe.
    return (ranged.join(F.broadcast(offsets), "_part")
                  .withColumn(out, (F.col("_off") + F.col("_row") + 1).cast("long"))
                  .drop("_mid", "_part", "_row", "_off"))
