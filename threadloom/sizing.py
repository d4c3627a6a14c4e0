"""Size checks that stand in front of every broadcast, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A dimension or dictionary with at most this many rows may be copied to every executor.
BROADCAST_ROWS = 200_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when df has at most `rows` rows; reads no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; otherwise leave the choice of join to the optimizer."""
    return F.broadcast(df) if fits(df, rows) else df


def broadcast_known(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast of a frame whose greatest number of rows is known; nothing is counted."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def spread(rows: DataFrame) -> DataFrame:
    """rows over all cores, for much work per row, if fewer splits than there are cores hold them.

    A Parquet file is cut into splits by its size, but a row group is read by one of them: a large file of one row group
    has many splits and all its rows in one task. The splits with rows are counted from the footers alone.
    """
    cores, splits = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    if splits >= cores and rows.select(F.spark_partition_id().alias("split")).distinct().count() >= cores:
        return rows
    return rows.repartition(max(cores, splits))


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path in the folder named by spark.checkpoint.dir (shared by the cluster).

    Only a local session may fall back to a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "threadloom-work")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the working folder and read it back, so later plans restart from stored files."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    """Hadoop file system and path object, for stores that only Spark reaches."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none when there is no such folder."""
    system, place = _located(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read, if it is there."""
    system, place = _located(spark, path)
    system.delete(place, True)
