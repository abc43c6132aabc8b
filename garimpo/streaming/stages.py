"""Stages over streams: parse, check, process, publish, with dead letters.

A stage treats each message by itself.  Where its code or its expressions fail for some messages, these become
dead letters and the others are published; where storage or the cluster fails, the stream stops and
the batch is done again.
"""

from __future__ import annotations

import builtins
import re
import traceback
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from garimpo.sources.shared import remove, shared_dir, stored
from garimpo.streaming.keys import STATE_STORE

#: What a stage writes, a folder each.
OUTPUTS = ("published", "failed", "unparsable")
#: Columns of failures.
FAILED = ("error", "error_type", "stack_trace", "original_message")
Step = Callable[[DataFrame], DataFrame]
#: Classes of SQL states that speak of the data or of user code: data exceptions, raised errors, failed functions.
_DATA_STATES = ("22", "P0", "39")
#: Slices of a failing batch that are tried before the stage counts as broken altogether.
MOST_TRIES = 500
#: Characters of an error's text and trace that a dead letter keeps; the messages themselves are whole.
ERROR_CHARS, TRACE_CHARS = 2_000, 8_000


@dataclass
class Stage:
    """``pre``, ``process`` and ``post`` are transforms; rows with a filled ``error`` after them have failed."""

    process: Step
    pre: Step = field(default=lambda df: df)
    post: Step = field(default=lambda df: df)

    def __call__(self, rows: DataFrame) -> DataFrame:
        return rows.transform(self.pre).transform(self.process).transform(self.post)


def per_record(f: Callable[[dict], dict | None], schema: str) -> Step:
    """A step that calls ``f`` for each record, over Arrow batches; what it raises is that record's failure.

    ``f`` takes the record's fields and gives those of ``schema``, or none: then nothing is published.
    Errors of storage and memory are no record's fault and end the task.
    """

    def step(rows: DataFrame) -> DataFrame:
        names = [x.split()[0] for x in schema.split(", ")]
        out = [*names, *FAILED]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                done = []
                for r in pdf.to_dict("records"):
                    message = r.pop("original_message", None)
                    try:
                        if (x := f(r)) is not None:
                            done.append((*(x.get(n) for n in names), None, None, None, message))
                    except (OSError, MemoryError):
                        raise
                    except Exception as e:
                        done.append((*[None] * len(names), str(e)[:ERROR_CHARS] or type(e).__name__, type(e).__name__, traceback.format_exc()[:TRACE_CHARS], message))
                yield pd.DataFrame(done, columns=out, dtype=object)

        return rows.mapInPandas(run, f"{schema}, {', '.join(f'{x} string' for x in FAILED)}")

    return step


def messages(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A stream of text lines in files, each a JSON message; a broker's topic gives the same column ``value``."""
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(path)


def once(stream: DataFrame, id_field: str = "raw_data_id", within: str = "7 days") -> DataFrame:
    """The stream without messages that come again: of one ``id_field`` only the first, in any batch and after any restart.

    Identifiers are kept in state for ``within``; messages without one all pass.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    named = stream.withColumn("_id", F.get_json_object("value", f"$.{id_field}"))
    first = named.filter("_id is not null").withColumn("_at", F.current_timestamp()).withWatermark("_at", within).dropDuplicatesWithinWatermark(["_id"])
    return first.select("value").unionByName(named.filter("_id is null").select("value"))


def parsed(values: DataFrame, schema: str) -> DataFrame:
    """Fields of the messages, ``original_message`` and ``unparsable``."""
    broken = F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = values.select(F.col("value").alias("original_message"), broken.alias("m")).select("original_message", "m.*")
    empty = F.trim(F.coalesce("original_message", F.lit(""))) == ""
    return rows.withColumn("unparsable", F.col("_bad").isNotNull() | empty).drop("_bad")


def split(rows: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """(published, failed) of parsed messages: results that are there, and failures with their message."""
    good = stage(rows)
    for name in FAILED:  # a stage without failures may leave them out
        if name not in good.columns:
            good = good.withColumn(name, F.lit(None).cast("string"))
    kind = F.coalesce("error_type", F.lit("ValidationError")).alias("error_type")
    failed = good.filter("error is not null").select("error", kind, "stack_trace", "original_message")
    return good.filter("error is null").drop(*FAILED), failed


def _of_user_code(trace: str) -> bool:
    """Whether a Python worker's trace ends with an error of the code, not of storage or memory."""
    last = [x for x in trace.strip().splitlines() if re.match(r"[A-Za-z_][\w.]*(:|$)", x)]
    kind = getattr(builtins, last[-1].partition(":")[0].rpartition(".")[2], None) if last else None
    return not (isinstance(kind, type) and issubclass(kind, (OSError, MemoryError)))


def data_error(e: Exception) -> bool:
    """Whether an error comes of the data or of the stage's code, not of storage, memory or the cluster."""
    if isinstance(e, PythonException):
        return _of_user_code(getattr(e, "_desc", None) or str(e))
    java = getattr(e, "_origin", None) or getattr(e, "java_exception", None)
    while java is not None:
        if java.getClass().getName().endswith(".PythonException"):
            return _of_user_code(java.getMessage() or "")
        state = java.getSqlState() if "getSqlState" in dir(java) else None
        if state and state[:2] in _DATA_STATES:
            return True
        java = java.getCause()
    return False


class Bisection:
    """A batch that fails as a whole, divided until every failing message stands alone.

    Messages are numbered and written first, so that every slice is the same whenever it is read.  A slice
    is a range of the numbers' hashes, of which either half is tried.  ``k`` bad ones of n messages cost about ``2 k log2(n)`` runs.
    """

    def __init__(self, rows: DataFrame, publish: Callable[[DataFrame, int], None], most: int = MOST_TRIES):
        self.path = shared_dir(rows.sparkSession)
        self.rows = stored(rows.withColumn("_h", F.xxhash64(F.monotonically_increasing_id())), self.path)
        self.publish, self.most, self.tries, self.bad = publish, most, 0, []

    def _slice(self, low: int, high: int) -> DataFrame:
        return self.rows.filter((F.col("_h") >= low) & (F.col("_h") <= high))

    def run(self) -> list[tuple[int, Exception, str]]:
        """(hash, error, trace) of each message that fails by itself; all others are published."""
        todo = [(-(2**63), 2**63 - 1)]
        while todo:
            low, high = todo.pop()
            self.tries += 1
            if self.tries > self.most:
                raise RuntimeError(f"the stage fails for too many messages of a batch: {self.most} slices tried, {len(self.bad)} bad ones found")
            part = self._slice(low, high)
            try:
                self.publish(part.drop("_h"), self.tries)
            except Exception as e:
                if not data_error(e):
                    raise
                ends = part.agg(F.min("_h").alias("low"), F.max("_h").alias("high")).first()
                if ends.low == ends.high:
                    self.bad.append((ends.low, e, traceback.format_exc()))
                else:
                    mid = (ends.low + ends.high) // 2
                    todo += [(ends.low, mid), (mid + 1, ends.high)]
        return self.bad

    def failed(self) -> DataFrame | None:
        """The dead letters of the messages that fail by themselves."""
        out = None
        for h, e, trace in self.bad:
            texts = [F.lit(x).alias(name) for x, name in zip((str(e)[:ERROR_CHARS], type(e).__name__, trace[:TRACE_CHARS]), FAILED)]
            own = self._slice(h, h).select(*texts, "original_message")
            out = own if out is None else out.unionByName(own)
        return out

    def clear(self) -> None:
        remove(self.rows.sparkSession, self.path)


def run(stream: DataFrame, schema: str, stage: Stage, out: str, checkpoint: str, id_field: str | None = "raw_data_id", within: str = "7 days") -> None:
    """Run a stage over all that is there and stop.

    Each batch writes its own folder, so a batch that is done again overwrites itself; messages that are
    delivered again within ``within``, by ``id_field``, are dropped (``None``: all pass).  Messages for which the stage fails
    go to the failed ones with the error's type and stack trace, the others are published.  An error of
    storage or of the cluster stops the stream and leaves the batch to the next run.
    """
    if id_field:
        stream = once(stream, id_field, within)

    def one(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, parsed(batch, schema).persist()
        at = lambda name, part="": f"{out}/{name}/batch={number}{part}"
        for name in OUTPUTS:
            remove(spark, at(name))  # what a run before this one may have left

        def publish(part: DataFrame, k: int) -> None:
            for name, df in zip(OUTPUTS, split(part, stage)):
                try:
                    df.write.mode("overwrite").parquet(at(name, f"/slice={k}"))
                except Exception:
                    for x in OUTPUTS[:2]:
                        remove(spark, at(x, f"/slice={k}"))
                    raise

        rows.filter("unparsable").select("original_message").write.mode("overwrite").parquet(at("unparsable", "/slice=0"))
        good = rows.filter("not unparsable").drop("unparsable")
        try:
            publish(good, 0)
        except Exception as e:
            if not data_error(e):
                raise
            parts = Bisection(good, publish)
            parts.run()
            letters = parts.failed()
            if letters is not None:
                letters.write.mode("overwrite").parquet(at("failed", "/slice=0"))
            parts.clear()
        rows.unpersist()

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_out(spark: SparkSession, out: str, name: str, schema: str | StructType | None = None) -> DataFrame:
    """All that a stage wrote to one of its outputs."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{out}/{name}").drop("batch", "slice")
