"""A table of stored collections that a stream of requests reads by the settings it asks for.

Every stored config is there under each of its settings, dealt by the setting's hash to buckets, which are
partition folders.  A batch writes one *run* of its own.  Runs are merged as digits carry: every ``FAN`` runs of
a level become one run of the next, so a row is rewritten once a level and batch n is served by at most
``(FAN - 1) * log(n)`` runs, of which only the buckets of the asked settings are opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.operators import cache
from garimpo.sources.shared import remove

INDEX = "s string, collect_id string, has map<string,string>, bucket int"
#: Runs of one level that are merged to one of the next.
FAN = 8
#: The setting that all configs have: only the earliest config of a run is listed below it.
ANY = ""


def cover(n: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that hold batches 0 to n - 1."""
    out, start = [], 0
    while start < n:
        level = 0
        while start % fan ** (level + 1) == 0 and start + fan ** (level + 1) <= n:
            level += 1
        out.append((level, start))
        start += fan**level
    return out


class Store:
    """Stored configs below ``path`` in ``buckets`` buckets; the number of buckets stays as the first batch had it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, fan: int = FAN):
        self.spark, self.path, self.buckets, self.fan = spark, path, buckets, fan

    def _run(self, level: int, start: int) -> str:
        return f"{self.path}/level={level}/start={start}"

    def _bucket(self, s: Column) -> Column:
        return F.pmod(F.xxhash64(s), F.lit(self.buckets)).cast("int")

    def _read(self, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], INDEX)
        parts = [self.spark.read.schema(INDEX).option("basePath", self._run(*r)).parquet(self._run(*r)) for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _write(self, index: DataFrame, level: int, start: int) -> None:
        # One file for each bucket, whatever the partitions.
        index.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(self._run(level, start))

    def _of(self, batch: int, settings: DataFrame) -> DataFrame:
        """The index of all batches before ``batch``, only the buckets of ``settings`` (``s``), at most ``buckets`` of them."""
        asked = [r.b for r in settings.select(self._bucket(F.col("s")).alias("b")).distinct().collect()]
        return self._read(cover(batch, self.fan)).filter(F.col("bucket").isin(asked))

    def holding(self, asked: DataFrame, batch: int) -> DataFrame:
        """``hash, collect_id`` of the requests (``hash, config``) that a config stored before ``batch`` holds: the earliest.

        Settings are counted first, and only the configs below each request's rarest one are read.
        """
        each = cache.asked_settings(asked).persist()
        often = self._of(batch, each).join(each.select("s").distinct(), "s", "left_semi").groupBy("s").agg(F.count("*").alias("n"))
        rare = cache.rarest(each, often).persist()
        held = cache.held_by(rare, self._of(batch, rare).drop("bucket"))
        first = self._of(batch, self.spark.createDataFrame([(ANY,)], "s string")).filter(F.col("s") == ANY).agg(F.min("collect_id").alias("collect_id")).filter("collect_id is not null")
        free = asked.filter(F.size("config") == 0).select("hash").join(F.broadcast(first))  # one row
        return held.unionByName(free)

    def add(self, configs: DataFrame, batch: int) -> None:
        """Store the configs (``collect_id, config``) of a batch and merge the runs that it completes; doing it again changes nothing."""
        known = cache.distinct_configs(configs).persist()
        first = known.agg(F.min("collect_id").alias("collect_id")).filter("collect_id is not null")
        index = cache.by_setting(known).unionByName(first.select(F.lit(ANY).alias("s"), "collect_id", F.create_map().cast("map<string,string>").alias("has")))
        self._write(index.withColumn("bucket", self._bucket(F.col("s"))), 0, batch)
        known.unpersist()
        level, size = 1, self.fan
        while (batch + 1) % size == 0:
            start, step = batch + 1 - size, size // self.fan
            runs = [(level - 1, start + i * step) for i in range(self.fan)]
            self._write(self._merged(self._read(runs)), level, start)
            # A batch done again may still read the runs just merged; those merged the time before no one reads.
            for i in range(self.fan if start else 0):
                remove(self.spark, self._run(level - 1, start - size + i * step))
            level, size = level + 1, size * self.fan

    def _merged(self, index: DataFrame) -> DataFrame:
        """A config stored several times once, and one row below ``ANY``: the earliest."""
        kept = F.when(F.col("s") != ANY, cache.canonical(F.col("has")))
        return index.groupBy("bucket", "s", kept.alias("c")).agg(F.min("collect_id").alias("collect_id"), F.first("has").alias("has")).select("s", "collect_id", "has", "bucket")
