"""Where a run keeps tables it has to write down."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="chunkwright-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """New path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the copy.

    Used where a table is read several times or where lineage would grow with
    the number of rounds. The copy outlives executors, is read column by column
    and tells Catalyst its true size.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that has fewer partitions than there are cores.

    For settled tables ahead of costly row-by-row expressions. Such a table is
    small, so the extra shuffle is; tables with enough partitions stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
