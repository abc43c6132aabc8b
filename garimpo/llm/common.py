"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words in the contracts.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder that every executor sees, below the cluster's checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset (tests, a single machine) a folder below
    the warehouse takes its place; on a cluster that is an error, as the folder may be local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_garimpo"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, at: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read again: lineage is cut, lost executors lose nothing."""
    path = at or shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`shared_dir` that no later step reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Frames of one call that are written below one folder and removed together when no later step reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, shared_dir(spark)

    def stored(self, df: DataFrame) -> DataFrame:
        return stored(df, f"{self.base}/{uuid.uuid4().hex}")

    def keep(self, df: DataFrame) -> DataFrame:
        """A result, written outside the folder, that outlives the call."""
        return stored(df)

    def clear(self) -> None:
        remove(self.spark, self.base)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


#: Rows of identifiers up to which they are broadcast; beyond, texts are shuffled to them.
FEW_ROWS = 1_000_000


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names made from ``names`` that no column of ``df`` has, letter case aside."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame) -> list[F.Column]:
    """All columns by quoted name, whatever characters it has."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def without(docs: DataFrame, dropped: DataFrame, on: dict[str, F.Column]) -> DataFrame:
    """``docs`` without the rows that ``dropped`` names; ``on``: its columns and what equals them, null included."""
    names = fresh(docs, *[f"_{c}" for c in on])
    dropped = stored(dropped.select(*[F.col(c).alias(name) for c, name in zip(on, names)]).distinct())
    few = F.broadcast(dropped) if dropped.count() <= FEW_ROWS else dropped
    same = [value.eqNullSafe(F.col(name)) for name, value in zip(names, on.values())]
    return docs.join(few, same, "left_anti")
