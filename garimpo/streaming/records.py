"""Records with any number of foreign keys over a stream, released once all that they refer to is resolved.

Records are joined with what answers their first key, then with what answers the second, and so on: each of these joins of
streams keeps who waits and what has been resolved, and a record that leaves the last one is resolved.  With a time limit two stateful operators take
their place.  *References* are keyed by (entity, field, value): the resolved record that has this value, and who waits for it.  *Records* are
keyed by (entity, id): their body, the keys that are still open, and the documents already found.

A resolved record may itself be what others wait for.  The table of resolved records is therefore also a source of the
same stream: what a batch resolves comes back in the next one as references.  A batch so handles
only the records that it reaches, a chain of n records takes n batches whatever the order of arrival, and records that only
point at each other in a circle wait for good: the least fixpoint.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from garimpo.operators.keys import Dependency
from garimpo.sources.shared import make_dir
from garimpo.streaming.keys import STATE_STORE

MESSAGE = "entity string, id string, body string"
RESOLVED = "entity string, id string, body string, found map<string,string>"
#: As it lies in files: the partition column comes last.
_STORED = "id string, body string, found map<string,string>, entity string"
#: State on disk, with a bound on what an executor keeps of it in memory, and written as changes.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Shares of the reference that records without a further key meet.
FREE = 256
_MET = "entity string, id string, body string, fk string, open array<string>"


class References(StatefulProcessor):
    """Per reference: the document that resolves it, once it has come, and the records that wait for it."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.document = handle.getValueState("document", "body string", self.ttl_ms)
        self.waiting = handle.getListState("waiting", "entity string, id string, fk string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new, found = [], []
        for r in rows:
            if r.resolves:
                found.append((r.id, r.body))
            else:
                new.append((r.entity, r.id, r.fk))
        known = self.document.get()
        if known is None:
            if not found:
                self.waiting.appendList(new)
                return
            body = min(found)[1]  # the first that came; of one batch, the smallest id
            self.document.update((body,))
            for entity, id_, fk in self.waiting.get():
                yield Row(entity=entity, id=id_, body=body, fk=fk, open=None)
            self.waiting.clear()
        else:
            body = known[0]
        for entity, id_, fk in new:
            yield Row(entity=entity, id=id_, body=body, fk=fk, open=None)

    def close(self) -> None:
        pass


class Records(StatefulProcessor):
    """Per record: body, open keys and documents found; the whole record comes out once, when the last key is met."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.record = handle.getValueState("record", "body string, keys int, done boolean", self.ttl_ms)
        self.found = handle.getMapState("found", "fk string", "body string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, met, before, first = self.record.get(), {}, {}, None
        for r in rows:
            if r.open is None:
                met.setdefault(r.fk, r.body)
            elif first is None:
                first = (r.body, len(r.open))
        new = known is None and first is not None
        body, keys, done = (*first, False) if new else known or (None, None, False)
        if done:  # a record that comes again changes nothing
            return
        if keys is None or len(met) < keys:  # what came before may complete it
            before = {fk: doc for (fk,), (doc,) in self.found.iterator()}
            for fk, doc in met.items():
                if fk not in before:
                    self.found.updateValue((fk,), (doc,))
            met |= before
        if keys is None or len(met) < keys:
            if new:
                self.record.update((body, keys, False))
            return
        self.record.update((None, keys, True))
        if before:
            self.found.clear()
        yield Row(entity=key[0], id=key[1], body=body, found=met)

    def close(self) -> None:
        pass


def _field(body: Column, name: str) -> Column:
    """The filled value at a dotted path of a JSON body; empty counts as absent."""
    value = F.get_json_object(body, f"$.{name}")
    return F.when(value != "", value)


def _ref(entity: str, field: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.to_json(F.array(F.lit(entity), F.lit(field), value)))


def _wait(d: Dependency) -> Column:
    """The reference that a message's key makes, NULL where it is not filled."""
    ref = _ref(d.ref_entity, d.pk, F.when(F.col("entity") == d.entity, _field(F.col("body"), d.fk)))
    return F.when(ref.isNotNull(), F.struct(ref.alias("ref"), F.lit(d.fk).alias("fk")))


def _waits(messages: DataFrame, deps: list[Dependency], parts: int) -> DataFrame:
    """One event for each filled key; a hot reference's records are spread over ``parts``."""
    own = messages.select("entity", "id", F.explode(F.array_compact(F.array(*[_wait(d) for d in deps]))).alias("k"))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    return own.select("k.ref", part, "k.fk", "entity", "id", F.lit(None).cast("string").alias("body"), F.lit(False).alias("resolves"))


def _answers(resolved: DataFrame, deps: list[Dependency]) -> DataFrame:
    """``entity, id, body, ref``: the references that resolved records answer."""
    pairs = sorted({(d.ref_entity, d.pk) for d in deps})
    each = F.array(*[_ref(e, f, F.when(F.col("entity") == e, _field(F.col("body"), f))) for e, f in pairs]) if pairs else F.array().cast("array<string>")
    return resolved.select("entity", "id", "body", F.explode(each).alias("ref")).filter("ref is not null")


def _offers(resolved: DataFrame, deps: list[Dependency], parts: int) -> DataFrame:
    """One event for each reference that a resolved record answers, in every part."""
    own = _answers(resolved, deps)
    return own.select("ref", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("string").alias("fk"), "entity", "id", "body", F.lit(True).alias("resolves"))


def _keys(deps: list[Dependency]) -> tuple[Column, Column]:
    """(filled keys of a message, whether an empty mandatory one refuses it)."""
    body, entity = F.col("body"), F.col("entity")
    filled = F.array_compact(F.array(*[F.when((entity == d.entity) & _field(body, d.fk).isNotNull(), F.lit(d.fk)) for d in deps]))
    refused = F.lit(False)
    for d in deps:
        if d.mandatory:
            refused = refused | ((entity == d.entity) & _field(body, d.fk).isNull())
    return filled, refused


def resolve(messages: DataFrame, back: DataFrame, deps: list[Dependency], parts: int = 4, ttl_ms: int | None = None) -> DataFrame:
    """Streams of messages and of resolved records (``back``) to the stream of records resolved next (``RESOLVED``).

    Keys and referenced fields are dotted paths of JSON bodies; an empty value is none.  A record without keys is
    resolved at once, one that lacks a mandatory key never.  Of several records with one referenced value the first resolved counts, of one batch
    any of them.  A record that comes again, by (entity, id), is ignored.  There is no time limit unless ``ttl_ms`` sets one.
    """
    for name, value in STATE.items():
        messages.sparkSession.conf.set(name, value)
    filled, refused = _keys(deps)
    own = messages.filter("entity is not null and id is not null").withColumns({"open": filled, "refused": refused}).filter("not refused").drop("refused")
    return _by_key(own, back, deps, parts, ttl_ms) if ttl_ms else _by_joins(own, back, deps, parts)


def _by_joins(own: DataFrame, back: DataFrame, deps: list[Dependency], parts: int) -> DataFrame:
    """One join of streams for each key that a record may have, whose state Spark keeps without calls to Python for each key.

    All records go through all joins, as a branch would be another operator with a state of its own: a record with fewer keys meets a
    reference that every message answers, in ``FREE`` shares.
    """
    steps = max(Counter(d.entity for d in deps).values(), default=0)
    share = F.to_json(F.array(F.lit(None).cast("string"), F.pmod(F.xxhash64("id"), F.lit(FREE)).cast("string")))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    each = F.array_compact(F.array(*[_wait(d) for d in deps])) if deps else F.array().cast("array<struct<ref:string,fk:string>>")
    rows = own.dropDuplicates(["entity", "id"]).select("entity", "id", "body", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("found"), each.alias("keys"))
    offers = _answers(back, deps).select("ref", "body").unionByName(own.select(share.alias("ref"), F.lit(None).cast("string").alias("body")))
    offers = offers.dropDuplicates(["ref"]).select(F.col("ref").alias("_ref"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"), F.col("body").alias("_doc"))
    for k in range(steps):
        key = F.get("keys", F.lit(k))
        met = rows.withColumns({"ref": F.coalesce(key["ref"], share), "part": part}).join(offers, (F.col("ref") == F.col("_ref")) & (F.col("part") == F.col("_part")))
        found = F.when(F.size("keys") > k, F.map_concat("found", F.create_map(key["fk"], F.col("_doc")))).otherwise(F.col("found"))
        rows = met.select("entity", "id", "body", found.alias("found"), "keys")
    return rows.drop("keys")


def _by_key(own: DataFrame, back: DataFrame, deps: list[Dependency], parts: int, ttl_ms: int) -> DataFrame:
    """Two operators with state by key, which expires after ``ttl_ms``."""
    events = _waits(own, deps, parts).unionByName(_offers(back, deps, parts))
    met = events.groupBy("ref", "part").transformWithState(References(ttl_ms), _MET, "Append", "ProcessingTime")
    rows = own.select("entity", "id", "body", F.lit(None).cast("string").alias("fk"), "open").unionByName(met)
    return rows.groupBy("entity", "id").transformWithState(Records(ttl_ms), RESOLVED, "Append", "ProcessingTime")


def run(messages: DataFrame, deps: list[Dependency], out: str, checkpoint: str, parts: int = 4, ttl_ms: int | None = None) -> None:
    """Resolve all that is there, and what that releases, into Parquet below ``out``; then stop.

    The stream may be stopped anywhere and run again with the same folders.  In production the query is left to run:
    the feedback needs no driver.
    """
    spark = messages.sparkSession
    make_dir(spark, out)
    # Partition folders also keep a batch without results from writing an empty file, which would call for another batch.
    back = spark.readStream.schema(_STORED).parquet(out)
    q = resolve(messages, back, deps, parts, ttl_ms).writeStream.format("parquet").partitionBy("entity").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def read_out(spark: SparkSession, out: str) -> DataFrame:
    """All resolved records."""
    return spark.read.schema(_STORED).parquet(out).select("entity", "id", "body", "found")

