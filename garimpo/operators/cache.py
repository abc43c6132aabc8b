"""Reuse of earlier collections: a request whose settings a stored one has all of gets its records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that steer the cache and are no part of what is asked for.
FLAGS = ("no_cache", "use_cache")


def canonical(config: Column) -> Column:
    """One text for a map of settings, whatever the order of its keys; flags and NULL values set aside."""
    return F.to_json(F.array_sort(F.map_entries(settings(config))))


def config_hash(config: Column) -> Column:
    return F.sha2(canonical(config), 256)


def flag(config: Column, name: str, default: bool) -> Column:
    return F.coalesce(F.lower(config[name]) == "true", F.lit(default))


def settings(config: Column) -> Column:
    """A map of settings without flags and NULL values."""
    return F.map_filter(config, lambda k, v: ~k.isin(*FLAGS) & v.isNotNull())


def entry(e: Column) -> Column:
    """One setting (key and value) as text."""
    return F.to_json(F.struct(e["key"], e["value"]))


def distinct_configs(configs: DataFrame) -> DataFrame:
    """``collect_id, has``: each map of settings once, with its earliest collection."""
    known = configs.select("collect_id", settings(F.col("config")).alias("has"))
    return known.groupBy(canonical(F.col("has")).alias("c")).agg(F.min("collect_id").alias("collect_id"), F.first("has").alias("has")).drop("c")


def by_setting(known: DataFrame) -> DataFrame:
    """``s, collect_id, has``: stored configs under each of their settings."""
    return known.select(F.explode(F.transform(F.map_entries("has"), entry)).alias("s"), "collect_id", "has")


def asked_settings(asked: DataFrame) -> DataFrame:
    """``hash, config, s``: requests (``hash, config``) under each of their settings."""
    return asked.select("hash", "config", F.explode(F.transform(F.map_entries("config"), entry)).alias("s"))


def rarest(each: DataFrame, often: DataFrame) -> DataFrame:
    """``hash, s, config``: of each request the setting that the fewest stored configs have (``often``: ``s, n``).

    A setting that no config has is the rarest of all: nothing holds the request.
    """
    return each.join(often, "s", "left").groupBy("hash").agg(F.min_by("s", F.struct(F.coalesce("n", F.lit(0)), F.col("s"))).alias("s"), F.first("config").alias("config"))


def held_by(rare: DataFrame, index: DataFrame) -> DataFrame:
    """``hash, collect_id``: the earliest config below a request's rarest setting that has all its settings."""
    held = rare.join(index, "s").filter(F.forall(F.map_entries("config"), lambda e: F.element_at(F.col("has"), e["key"]) == e["value"]))
    return held.groupBy("hash").agg(F.min("collect_id").alias("collect_id"))


def holding(asked: DataFrame, configs: DataFrame) -> DataFrame:
    """``hash, collect_id``: for each distinct request (``hash, config``) the earliest stored config that has all its settings.

    The rarest setting of a request proposes configs, whole maps decide; a request without
    settings is held by every config.
    """
    index = by_setting(distinct_configs(configs))
    held = held_by(rarest(asked_settings(asked), index.groupBy("s").agg(F.count("*").alias("n"))), index)
    first = configs.agg(F.min("collect_id").alias("collect_id")).filter("collect_id is not null")
    free = asked.filter(F.size("config") == 0).select("hash").join(F.broadcast(first))  # one row
    return held.unionByName(free)


def wanted(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests with ``_hash`` where they look for stored records, distinct requests ``hash, config``)."""
    look = flag(F.col("config"), "use_cache", True) & ~flag(F.col("config"), "no_cache", False)
    rows = requests.withColumn("_hash", F.when(look, config_hash(F.col("config"))))
    return rows, rows.filter("_hash is not null").groupBy(F.col("_hash").alias("hash")).agg(F.first(settings(F.col("config"))).alias("config"))


def answered(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Requests of :func:`wanted` with ``action`` and ``collect_id`` by what is ``known`` (``hash, collect_id``)."""
    found = rows.join(known.withColumnRenamed("hash", "_h"), F.col("_hash") == F.col("_h"), "left")
    action = F.when(~flag(F.col("config"), "use_cache", True), "bypass").when(F.col("collect_id").isNotNull(), "hit").otherwise("miss")
    return found.withColumn("action", action).drop("_h", "_hash")


def lookup(requests: DataFrame, configs: DataFrame) -> DataFrame:
    """Requests with ``action`` (hit, miss, bypass) and the ``collect_id`` of a hit, the earliest stored one.

    A hit is a stored config that has all settings of the request, and maybe more.
    ``use_cache`` false: bypass, nothing is stored.  ``no_cache``: collected anew and stored.
    """
    rows, asked = wanted(requests)
    return answered(rows, holding(asked, configs))


def republish(hits: DataFrame, records: DataFrame, source: str) -> DataFrame:
    """The stored records of every hit, with ``raw_data_id`` and ``data_source`` filled in."""
    r = records.withColumns({
        "raw_data_id": F.coalesce("raw_data_id", "_id"), "data_source": F.coalesce("data_source", F.lower(F.lit(source))),
    }).drop("_id")
    return hits.select("request_id", "collect_id").join(r, "collect_id")
