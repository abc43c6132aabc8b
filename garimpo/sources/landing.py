"""Landing of raw records: stamping, routing and writing by collection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def raw_id(*parts: Column) -> Column:
    """A record's identifier from its content: the same record gets the same one again."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def stamp(records: DataFrame, source: str, collect_id: str, identity: list[str], extra: dict[str, str] | None = None) -> DataFrame:
    """Records with ``collect_id``, lower-case ``data_source``, collection and ``raw_data_id``."""
    entity = F.col("entity_type") if "entity_type" in records.columns else F.lit(None).cast("string")
    return records.withColumns({k: F.lit(v) for k, v in (extra or {}).items()}).withColumns({
        "collect_id": F.lit(collect_id),
        "data_source": F.lower(F.lit(source)),
        "raw_data_collection": F.concat_ws(".", F.lower(F.lit(source)), entity),
        "raw_data_id": raw_id(*[F.col(c) for c in identity]),
    })


def refused(records: DataFrame, identity: list[str], bad: str = "_bad") -> DataFrame:
    """Records with ``error`` where they can't be landed: unreadable (``bad`` is filled), or nothing in any field of their identity."""
    empty = reduce(Column.__and__, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in identity])
    broken = F.col(bad).isNotNull() if bad in records.columns else F.lit(False)
    return records.withColumn("error", F.when(broken, "unreadable record").when(empty, "record without identity"))


def land(stamped: DataFrame, path: str, refused_at: str | None = None) -> None:
    """Into one table partitioned by source, entity and collection run, each run once.

    A run that is landed again takes the place of its rows in the partitions that it writes, so a job may be done again.
    Rows with a filled ``error`` (:func:`refused`) go to ``refused_at``, by run as well, and the others don't depend on them.
    """
    entity = F.coalesce(F.col("entity_type"), F.lit("none")) if "entity_type" in stamped.columns else F.lit("none")
    # The identifier of a run as a folder name that no reader takes for a number or a date.
    rows = stamped.withColumns({"entity_type": entity, "landing_run": F.concat(F.lit("run-"), F.substring(F.sha2(F.col("collect_id"), 256), 1, 20))})

    def put(df: DataFrame, at: str, *folders: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(at)

    if "error" in rows.columns:
        if refused_at:
            put(rows.filter("error is not null"), refused_at, "landing_run")
        rows = rows.filter("error is null").drop("error")
    put(rows, path, "data_source", "entity_type", "landing_run")


def landed(spark: SparkSession, path: str, collect_id: str) -> int:
    """Records that a collection run has written, counted from the table."""
    return spark.read.parquet(path).filter(F.col("collect_id") == collect_id).count()


def union_of(collections: list[DataFrame]) -> DataFrame:
    """All records of several collections; fields that one lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), collections)


def collections_of(spark: SparkSession, path: str, source: str) -> DataFrame:
    """All collections of a source, by its partition."""
    return spark.read.parquet(path).filter(F.col("data_source") == source.lower()).drop("landing_run")
