"""Stage tables: what one job hands to the next.

A session table is kept in the order of session and time, cut into ranges that bound a task's
rows however long a session is, as Parquet in buckets of the range. The order and the
number of buckets are noted in the files' schema, so a later job that reads the folder
knows them again: positions, cuts, labels, gaps and steps then need no exchange of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import time_order
from ..functions.sequence import ordered, read_ordered


def write_sessions(sessions: DataFrame, path: str) -> DataFrame:
    """Write a session table to ``path`` in the order of session and time -> the stage table."""
    rows, order = time_order(sessions)
    return ordered(rows, ["session"], order, path=path)


def read_sessions(spark: SparkSession, path: str, text_items: bool = False) -> DataFrame:
    """The stage table in ``path``. Item ids become numbers unless ``text_items``; a row without
    one raises (see ``files.read_sessions``)."""
    df = read_ordered(spark, path)
    kind = "string" if text_items else "long"
    missing = F.raise_error(F.lit("session table row without itemid"))
    return df.withColumn("itemid", F.when(F.col("itemid").isNull(), missing).otherwise(F.col("itemid")).cast(kind))
