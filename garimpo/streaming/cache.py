"""The cached collector over a stream of requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.operators import cache
from garimpo.sources.shared import stored
from garimpo.streaming.settings import Store


def serve(stream: DataFrame, out: str, checkpoint: str, collect: Callable[[DataFrame], DataFrame], buckets: int = 64) -> None:
    """Requests (``request_id, config``) to ``out/actions``, ``out/configs`` and ``out/records``.

    A hit republishes the records of its collection; a miss collects, stores its
    configuration and stamps its ``collect_id``.  Equal requests of one batch are collected once.  What was stored is
    looked up in ``out/index``, of which a batch opens only what it asks for.
    """
    store = Store(stream.sparkSession, f"{out}/index", buckets)

    def one(batch: DataFrame, number: int) -> None:
        rows, asked = cache.wanted(batch)
        found = cache.answered(rows, stored(store.holding(asked, number))).persist()
        new = found.filter("action = 'miss'").withColumn("_h", cache.config_hash(F.col("config")))
        made = new.groupBy("_h").agg(F.min_by(F.struct("request_id", "config"), "request_id").alias("r"))
        configs = made.select(F.concat(F.lit("c"), F.col("r.request_id").cast("string")).alias("collect_id"), F.col("r.config").alias("config")).persist()
        configs.write.mode("overwrite").parquet(f"{out}/configs/batch={number}")
        collect(configs).write.mode("overwrite").parquet(f"{out}/records/batch={number}")
        found.select("request_id", "action", "collect_id").write.mode("overwrite").parquet(f"{out}/actions/batch={number}")
        store.add(configs, number)
        for df in (found, configs):
            df.unpersist()

    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
