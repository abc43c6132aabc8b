"""Folders that the driver and all executors see, and tables kept there to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset (tests, a single machine) a folder below the
    warehouse takes its place; on a cluster that is an error, as the folder may be local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_garimpo"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, at: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read again; a lost executor loses nothing of it."""
    path = at or shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder where it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def make_dir(spark: SparkSession, path: str) -> None:
    """Make a folder, where it is not there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def large(df: DataFrame) -> DataFrame:
    """The frame with a hint for a shuffle join; else Spark goes by the bytes of packed files and may broadcast millions of rows."""
    return df.hint("merge")


def small(df: DataFrame, most: int = 200_000) -> DataFrame:
    """The frame with a broadcast hint where it is counted to be small; beyond, with one for a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else large(df)


def free(df: DataFrame) -> DataFrame:
    """The frame, after shuffle files of earlier steps that nothing refers to are given back; else they stay until the driver happens to collect its garbage."""
    df.sparkSession.sparkContext._jvm.System.gc()
    return df
