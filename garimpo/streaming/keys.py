"""Foreign keys over a stream: records wait in state until what they refer to arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "child_id string, fk string, child string, parent string"


def resolve(stream: DataFrame) -> DataFrame:
    """Stream of ``row_id, fk, is_parent, body`` to stream of children with their parent's body, each once.

    A join of the stream with itself, whose state Spark keeps without calls to Python for each key.  Of several parents of one key
    the first that comes counts; a key of NULL refers to nothing.  There is no time limit, as a record may come at any time, so both sides stay in state.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    known = stream.filter(F.col("fk").isNotNull())
    parents = known.filter("is_parent").select(F.col("fk").alias("_fk"), F.col("body").alias("parent")).dropDuplicates(["_fk"])
    children = known.filter("not is_parent").select(F.col("row_id").alias("child_id"), "fk", F.col("body").alias("child"))
    return children.join(parents, F.col("fk") == F.col("_fk")).select("child_id", "fk", "child", "parent")


def run(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Resolve all that is there into Parquet and stop."""
    q = resolve(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
