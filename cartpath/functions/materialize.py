"""Written intermediate tables in the shared checkpoint folder.

A table that several branches of a plan read (sessions, train and test sets) is written
once as parquet below ``spark.checkpoint.dir`` and read back: this cuts the lineage, so a
lost executor costs a re-read instead of a recomputation of the whole chain, and the
read-back carries exact size statistics for AQE's join choices.

With ``buckets`` the table is written in buckets of a column, so that Spark knows its rows to be
clustered by that column: windows and aggregates by it (and more columns) need no
exchange. Spark keeps buckets for catalogue tables only: such a folder has a table name,
which goes when the folder is deleted.

Every written folder is remembered for its session. ``temporary(spark)`` deletes at its
end what was written inside it, ``cleanup(spark)`` what the session has written so far;
both remove only folders that this module made.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..config import scratch_path

_written: dict[str, list[str]] = {}


def _paths(spark: SparkSession) -> list[str]:
    return _written.setdefault(spark.sparkContext.applicationId, [])


def materialize(df: DataFrame, name: str, partition_by: str | None = None, buckets: tuple[int, str] | None = None,
                path: str | None = None) -> DataFrame:
    """``df`` written and read back, where asked partitioned by a column, or in (number, column)
    buckets; with a ``path`` it is no intermediate table and stays there."""
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, name)
        _paths(spark).append(path)
    writer = df.write.mode("overwrite")
    if buckets:
        table = _table_name(path)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer.bucketBy(*buckets).format("parquet").option("path", path).saveAsTable(table)
        return spark.table(table)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.parquet(path)


def bucketed(spark: SparkSession, path: str, schema: StructType, number: int, column: str) -> DataFrame:
    """A folder that was written in buckets, as a table whose buckets Spark knows."""
    table = _table_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({column}) INTO {number} BUCKETS LOCATION '{place}'")
    return spark.table(table)


def _table_name(path: str) -> str:
    """The catalogue name of a folder's table: one for each folder and application-wide stable."""
    return "cartpath_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` only reads, filters and projects files: a scan gives every row the same
    place (partition and row number) in each pass and each attempt, a shuffle does not."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() not in ("Project", "Filter", "LogicalRelation", "Relation", "LocalRelation"):
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(p)}")
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        _paths(spark).remove(p)


def discard(*tables: DataFrame) -> None:
    """Delete the intermediate tables that ``tables`` read; only what ``materialize`` has
    written goes, and no DataFrame that reads it can be used any more."""
    for df in tables:
        files = df.inputFiles()
        folders = [p for p in _paths(df.sparkSession) if any(p.rsplit("/", 1)[1] in f for f in files)]
        _delete(df.sparkSession, folders)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now. It does so when the driver has
    collected the objects that stand for them, which may be long after the tables made of
    them are written: they would lie beside everything that follows."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cleanup(spark: SparkSession) -> None:
    """Delete the intermediate tables this session has written; DataFrames that read them
    cannot be used any more."""
    _delete(spark, list(_paths(spark)))


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediate tables written inside the block."""
    before = set(_paths(spark))
    try:
        yield
    finally:
        _delete(spark, [p for p in _paths(spark) if p not in before])
