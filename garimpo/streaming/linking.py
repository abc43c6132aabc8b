"""The linker as a consumer of database events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.operators import filters

EVENT = "routing_key string, ids_gerados_db string"


def news_id(ids: Column) -> Column:
    """The news item's id at either of the two places where events hold it."""
    return F.coalesce(F.get_json_object(ids, "$.inserted_ids.noticia"), F.get_json_object(ids, "$.data.insert.noticia")).cast("bigint")


def wanted(events: DataFrame, queue: str, bindings: DataFrame) -> DataFrame:
    """``id_noticia`` of events that are routed to the queue and name a news item."""
    own = filters.route(events, bindings.filter(F.col("queue") == queue))
    return own.select(news_id(F.col("ids_gerados_db")).alias("id_noticia")).filter("id_noticia is not null").distinct()


def run(stream: DataFrame, queue: str, bindings: DataFrame, link: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Link the news of each batch; ``link`` takes ``id_noticia`` rows and joins the static tables."""

    def one(batch: DataFrame, number: int) -> None:
        link(wanted(batch, queue, bindings)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
