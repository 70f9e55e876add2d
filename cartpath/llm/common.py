"""Shared helpers: inputs, written intermediates, slices of Arrow batches, shipping the code.

Row rules used by every operator of this subpackage: a row of the input gives one row of
the result (or its pieces); ``doc_id`` may be null or repeated and is only carried along;
columns the operator does not name are ignored, so extra or clashing columns never matter.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.materialize import is_stored, materialize

__all__ = ["documents", "labels", "materialize", "ship", "text_slices", "id_crc32", "join_few", "pass_id", "stored"]

#: Bytes of text that a Python step handles at once.
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_crc32(col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` if it only reads files, else ``df`` written and read back: what ``pass_id`` numbers."""
    return df if is_stored(df) else materialize(df, name)


def pass_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` (a stored table, see ``stored``) with a row number that is the same in every pass over it.

    The number is Spark's partition index and row index of the scan; both follow from the
    stored files and the session's split size alone, so a retried task numbers alike."""
    return df.withColumn(name, F.monotonically_increasing_id())


def join_few(rows: DataFrame, few: DataFrame, key: str, other: str, bound: int = 100_000, salts: int = 64) -> DataFrame:
    """``rows`` with the row of ``few`` (a written table) whose ``other`` equals ``key``, null being a
    key like any other: a broadcast up to ``bound`` rows, beyond it a join over salts, since one
    key may hold a large share of all rows."""
    same = F.col(key).eqNullSafe(F.col(other))
    if few.count() <= bound:
        return rows.join(F.broadcast(few), same).drop(other)
    salted = few.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    return rows.join(salted, (F.col("_salt") == F.col("_salt2")) & same).drop(other, "_salt", "_salt2")


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, cut so that a slice holds about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(size.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text (null: empty)."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def ship(spark: SparkSession) -> None:
    """Make this package importable for the executors' Python workers (once per session)."""
    sc = spark.sparkContext
    if getattr(sc, "_cartpath_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="cartpath-code-"), "cartpath_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._cartpath_shipped = True
