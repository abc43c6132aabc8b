"""Collection statistics as grouped aggregates; column names are arguments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals(docs: DataFrame, portal: str, collection: Column) -> DataFrame:
    """Documents, portals and collections; a NULL portal counts as one."""
    null_portal = F.max(F.col(portal).isNull().cast("int"))
    return docs.agg(
        F.count("*").alias("documents"), (F.count_distinct(portal) + F.coalesce(null_portal, F.lit(0))).alias("portals"), F.count_distinct(collection).alias("collections")
    )


def by_portal(docs: DataFrame, portal: str, date: Column) -> DataFrame:
    """Count, first and last date of each portal, most documents first."""
    return docs.groupBy(portal).agg(F.count("*").alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date")).orderBy(F.desc("n"), portal)


def recent_dates(docs: DataFrame, date: Column, n: int = 10) -> DataFrame:
    """Counts of the newest dates."""
    return docs.groupBy(date.alias("date")).agg(F.count("*").alias("n")).orderBy(F.desc("date")).limit(n)


def by_collect(docs: DataFrame, collect_id: str, portal: str, ts: str, key: str) -> DataFrame:
    """For each collection run: the portal of its first row, its size and when it began, newest first."""
    return (
        docs.filter(F.col(collect_id).isNotNull()).groupBy(collect_id)
        .agg(F.min_by(portal, key).alias("portal"), F.count("*").alias("n"), F.min(ts).alias("began"))
        .orderBy(F.desc("began"), collect_id)
    )


def portal_report(docs: DataFrame, portal: str, name: str, date: Column, collection: str) -> DataFrame:
    """One row on one portal: total, its dates and collections with counts; no row for an unknown portal."""
    own = docs.filter(F.col(portal) == name)

    def counted(key: Column) -> DataFrame:
        pairs = own.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
        return pairs.agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("list"), F.sum("n").alias("total"))

    dates, collections = counted(date), counted(F.col(collection))
    return dates.filter("total > 0").select(F.lit(name).alias("portal"), "total", F.col("list").alias("dates")).join(
        collections.select(F.col("list").alias("collections"), F.col("total").alias("_t")), F.col("total") == F.col("_t")
    ).drop("_t")


def first_last(docs: DataFrame, portal: str, date: str, key: str, fields: list[str]) -> DataFrame:
    """The first and the last article of each portal, ties by key."""
    at = F.struct(date, key)
    every = F.struct(*fields)
    return docs.filter(F.col(date).isNotNull()).groupBy(portal).agg(F.min_by(every, at).alias("first"), F.max_by(every, at).alias("last"))


def portals(docs: DataFrame, portal: str) -> DataFrame:
    return docs.groupBy(portal).agg(F.count("*").alias("n")).orderBy(F.desc("n"), portal)


def collection_counts(docs: DataFrame, source: str, entity: str, key: str, sample: str) -> DataFrame:
    """Size of each collection and the keys of its first record."""
    return docs.groupBy(source, entity).agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.json_object_keys(F.min_by(sample, key))), ",").alias("sample_keys")
    )


def open_pendencies(pendencies: DataFrame) -> DataFrame:
    """How many pendencies each missing entity holds up."""
    return pendencies.filter(~F.col("resolved")).groupBy("missing_entity").agg(F.count("*").alias("n"))


def run_summary(runs: DataFrame, portal: str, error: Column) -> DataFrame:
    """Success and article count of each portal of a run."""
    return runs.groupBy(portal).agg(F.count_if(error.isNull()).alias("articles"), F.coalesce(F.bool_and(error.isNull()), F.lit(True)).alias("success"), F.count_if(error.isNotNull()).alias("errors"))


def fk_profile(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """For each (name, rows, fk, referenced rows, pk): rows, matched, orphans, nulls.

    The foreign keys are counted first, so a reference is looked up once for each distinct value.
    """
    out = []
    for name, rows, fk, ref, pk in checks:
        values = rows.groupBy(F.col(fk).cast("string").alias("v")).agg(F.count("*").alias("n"))
        known = ref.select(F.col(pk).cast("string").alias("k")).distinct()
        joined = values.join(known, F.col("v") == F.col("k"), "left")
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
        out.append(
            joined.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), total(F.col("k").isNotNull()).alias("matched"),
                total(F.col("v").isNotNull() & F.col("k").isNull()).alias("orphans"), total(F.col("v").isNull()).alias("nulls"),
            ).withColumn("fk", F.lit(name))
        )
    return reduce(DataFrame.unionByName, out)
