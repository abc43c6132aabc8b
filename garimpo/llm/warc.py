"""WARC archives: pages written as transactions, archives read back, transactions assembled.

*Writing* is the text writer with the two empty lines that end a record as its separator: a row
``header, empty line, block`` is a whole record.  Each page gives a request, a response (or revisit)
and a metadata record, the first and last of which name the second in ``WARC-Concurrent-To``.  Files are gzip streams of
about equal size.

*Reading* is the text reader with ``WARC/1.`` as separator, so files of any size stream through
in pieces.  A page may hold those letters, or a whole record, itself; so a record is all pieces in file order
until its ``Content-Length`` is reached.  A gzip file is one split and in order as it is read; plain
files can be cut into several splits, whose pieces are first brought together by file and order.

*Transactions.*  Records join their response or revisit by ``WARC-Concurrent-To``, whichever side names
the other; records that name it only through others are resolved by connected components.
A revisit takes length and digest of its payload from the response that it refers to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.llm.common import FEW_ROWS, Scratch, partitions, remove, shared_dir, stored
from garimpo.llm.components import components

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
#: Bytes of records that a task hands on at a time.
STEP = 8 << 20
EOL, END, MARK = "\r\n", "\r\n\r\n", "WARC/1."
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource")
RECORD = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, record_date string, "
    "content_type string, declared_digest string, block_head string, payload binary, payload_bytes long, payload_digest string, whole boolean"
)


def _header(text) -> F.Column:
    """A value for one header line: line ends become escapes."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(kind, record_id, fields: dict[str, F.Column | None], block) -> F.Column:
    """A record without the empty lines behind it; fields without a value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(EOL)) for name, value in fields.items()]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    first = F.concat(F.lit(f"{MARK}1{EOL}WARC-Type: "), kind, F.lit(f"{EOL}WARC-Record-ID: "), record_id, F.lit(EOL))
    return F.concat(first, *[F.coalesce(x, F.lit("")) for x in lines], length, block)


def write(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives of ``pages`` (``page_id, url, html``) below ``path``.

    Of pages with equal payloads (``html`` in UTF-8; null: empty) of ``LEAST_BYTES`` or more, that with the
    smallest ``page_id`` (null last; ties: smallest ``url``, null last) is a response and the others are revisits
    without payload; rows equal in all three are all responses under one record id.  Smaller payloads are all
    responses.  A null ``page_id`` or ``url`` leaves its field out.  Other columns are not read.  An empty table writes no record.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("string").alias("page"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha2("html", 256)})
    who = F.struct(F.col("page_id").isNull().alias("a"), "page_id", F.col("url").isNull().alias("b"), "url")
    copied = stored(rows.filter(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(F.count("*").alias("n"), F.min(who).alias("head")).filter("n > 1").select(F.col("digest").alias("d"), "head"))
    few = F.broadcast(copied) if copied.count() <= FEW_ROWS else copied
    rows = rows.join(few, F.col("digest") == F.col("d"), "left")
    name = lambda kind, id_, url: F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws("\x1f", F.lit(kind), F.coalesce(id_.cast("string"), F.lit("\x1e")), F.coalesce(url, F.lit("\x1e")), "digest"), 256), F.lit(">"))
    own = lambda kind: name(kind, F.col("page_id"), F.col("url"))
    first = name("response", F.col("head.page_id"), F.col("head.url"))
    again = F.col("d").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("head.page_id")) & F.col("url").eqNullSafe(F.col("head.url")))
    uri, when, digest = _header(F.col("url")), F.lit(date), F.concat(F.lit("sha256:"), "digest")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    place = F.regexp_replace(F.regexp_replace(F.coalesce(uri, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*|#.*$", ""), r"\s", "%20")
    asked = F.concat(F.lit("GET "), F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), place)), F.lit(f" HTTP/1.1{EOL}Host: "), F.coalesce(host, F.lit("")), F.lit(END))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    main = own("response")
    response = _record(kind, main, {
        "WARC-Date": when, "WARC-Target-URI": uri, "WARC-Payload-Digest": digest, "WARC-Refers-To": F.when(again, first), "WARC-Profile": F.when(again, F.lit(REVISIT)),
        "Content-Type": F.lit("application/http; msgtype=response"),
    }, F.when(again, http).otherwise(F.concat(http, "html")))
    request = _record(F.lit("request"), own("request"), {"WARC-Date": when, "WARC-Target-URI": uri, "WARC-Concurrent-To": main, "Content-Type": F.lit("application/http; msgtype=request")}, asked)
    about = F.concat(F.coalesce(F.concat(F.lit("page_id: "), "page", F.lit(EOL)), F.lit("")), F.lit("format: html"), F.lit(EOL))
    metadata = _record(F.lit("metadata"), own("metadata"), {"WARC-Date": when, "WARC-Target-URI": uri, "WARC-Concurrent-To": main, "Content-Type": F.lit("application/warc-fields")}, about)
    rows.select(F.explode(F.array(request, response, metadata)).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def _fields(head: bytes) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for line in head.decode("utf-8", "replace").split(EOL)[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), []).append(value.strip())
    return out


def parse(record: bytes) -> tuple | None:
    """The columns of ``RECORD`` of one record (without ``WARC/1.``); none if it has no type."""
    head, _, block = record.partition(b"\r\n\r\n")
    f = _fields(head)
    one = lambda name: f.get(name, [None])[0]
    if not one("warc-type"):
        return None
    size = length(head)
    whole = size is not None and len(block) >= size
    block = block[: size or 0]
    http = (one("content-type") or "").startswith("application/http")
    top, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    digest = (one("warc-payload-digest") or "").partition(":")[2].lower() or None
    return (
        one("warc-record-id"), one("warc-type").lower(), f.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), one("warc-date"),
        one("content-type"), digest, top.decode("utf-8", "replace"), payload, len(payload), hashlib.sha256(payload).hexdigest(), whole,
    )


def length(head: bytes) -> int | None:
    """``Content-Length`` of a record's header."""
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    return None


#: Length of a record whose header has not ended yet.
OPEN = 1 << 62


def _end(piece: bytes) -> int:
    """Bytes of the record that begins with the piece."""
    head, blank, _ = piece.partition(b"\r\n\r\n")
    return len(head) + 4 + (length(head) or 0) if blank else OPEN


def assembled(pieces: Iterator[tuple[str, bytes]]) -> Iterator[bytes]:
    """Records of ``(file, piece)`` in file order: a piece belongs to the record before it until that is complete.

    The first piece of a file stands before its first mark and is no record.
    """
    file, parts, have, want = None, [], 0, 0
    for name, piece in pieces:
        if name != file:
            if parts:
                yield b"".join(parts)
            file, parts = name, []
            have = want = 0
        elif have < want:
            parts += [MARK.encode(), piece]
            have += len(MARK) + len(piece)
            if want == OPEN:
                parts = [b"".join(parts)]
                want = _end(parts[0])
        else:
            if parts:
                yield b"".join(parts)
            parts, have, want = [piece], len(piece), _end(piece)
    if parts:
        yield b"".join(parts)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        names, values = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield names[i].as_py(), values[i].as_py()


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for record in assembled(_pieces(batches)):
        if row := parse(record):
            rows.append(row)
            size += len(record)
        if size >= STEP:
            yield _batch(rows)
            rows, size = [], 0
    yield _batch(rows)


_TYPES = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, types = zip(*(x.split(" ") for x in RECORD.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _TYPES[t]) for i, t in enumerate(types)], list(names))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: columns ``RECORD``.

    ``payload`` is what follows the HTTP header, or the whole block where there is none; length and digest are
    of these bytes.  ``whole`` is false where a file ends before ``Content-Length``.  Archives may be plain or gzip (one stream or a member
    for each record), versions 1.0 and 1.1.  Files without a record give no rows.
    """
    pieces = spark.read.option("lineSep", MARK).option("recursiveFileLookup", True).text(path)
    file, packed = F.col("_metadata.file_path"), F.col("_metadata.file_name").endswith(".gz")
    named = lambda rows: rows.select(file.alias("file"), F.col("value").cast("binary").alias("value"))
    plain = pieces.filter(~packed).select(file.alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"))
    plain = plain.repartition(partitions(spark), "file").sortWithinPartitions("file", "start", "at").select("file", "value")
    return named(pieces.filter(packed)).mapInArrow(_run, RECORD).unionByName(plain.mapInArrow(_run, RECORD))


def captures(found: DataFrame, scratch: Scratch, payload: bool = True) -> DataFrame:
    """One nested row for each response, revisit or resource record.

    ``record_id, record_type, target_uri, record_date, response`` (``block_head, payload, payload_bytes,
    payload_digest, declared_digest, whole``), ``requests`` and ``metadata`` (arrays of ``record_id, block_head, payload``
    in the order of their ids), ``refers_to`` (record id) and ``of`` (``target_uri, payload_bytes, payload_digest,
    metadata`` of the record referred to; null where that is not in the archives).  Records repeated in the archives are
    repeated rows; records of no capture (such as ``warcinfo``) are in no row.

    All but the payloads of captures is written to ``scratch`` once, and joined there; without ``payload`` that field is null and the archives
    are read a single time.
    """
    primary = F.col("record_type").isin(*PRIMARY)
    small = scratch.stored(found.withColumn("payload", F.when(~primary, F.col("payload"))))
    main, other = small.filter(primary), small.filter(~primary)
    ids = main.filter("record_id is not null").select(F.col("record_id").alias("main")).distinct()
    is_main = lambda c: F.col(c) == F.col("main")
    # Either side may name the other.
    named = other.select("record_id", F.explode("concurrent_to").alias("to")).unionByName(main.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("to")))
    named = scratch.stored(named.filter("record_id is not null and to is not null").join(ids, is_main("record_id"), "left_anti").distinct())
    direct = named.join(ids, is_main("to"), "left_semi").groupBy("record_id").agg(F.min("to").alias("main"))
    rest = scratch.stored(named.join(direct, "record_id", "left_anti").select(F.col("record_id").alias("node")).distinct())
    if rest.limit(1).count():  # records that name a capture through others, few if any
        label = scratch.stored(components(named.select(F.col("record_id").alias("a"), F.col("to").alias("b"))))
        mains = label.join(ids, is_main("node"), "left_semi").groupBy("label").agg(F.min("node").alias("main"))
        direct = direct.unionByName(rest.join(label, "node").join(mains, "label").select(F.col("node").alias("record_id"), "main"))
    part = F.struct("record_id", "block_head", F.col("payload").cast("string").alias("payload"))
    each = lambda kind: F.array_sort(F.collect_set(F.when(F.col("record_type") == kind, part))).alias(kind)
    around = scratch.stored(other.join(direct, "record_id").groupBy("main").agg(each("request"), each("metadata")))
    wanted = main.filter("refers_to is not null").select(F.col("refers_to").alias("record_id")).distinct()
    referred = main.filter("record_type <> 'revisit'").join(wanted, "record_id", "left_semi").groupBy("record_id").agg(F.first(F.struct("target_uri", "payload_bytes", "payload_digest")).alias("r"))
    referred = referred.join(around, is_main("record_id"), "left").select(F.col("record_id").alias("ref"), F.struct("r.*", "metadata").alias("of"))
    rows = (found.filter(primary) if payload else main).join(around, is_main("record_id"), "left").join(referred, F.col("refers_to") == F.col("ref"), "left")
    response = F.struct("block_head", "payload", "payload_bytes", "payload_digest", "declared_digest", "whole").alias("response")
    return rows.select("record_id", "record_type", "target_uri", "record_date", response, F.col("request").alias("requests"), "metadata", "refers_to", "of")


def page_of(metadata) -> F.Column:
    """The ``page_id`` that a capture's metadata records name."""
    return F.regexp_extract(F.array_join(F.transform(metadata, lambda m: m["payload"]), "\n"), r"(?m)^page_id: (-?\d+)", 1).try_cast("long")


def round_trip(pages: DataFrame, keep_archives: str | None = None) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page, from archives written and read back.

    Both figures are of the full payload, for revisits that of the response referred to.  The archives are removed
    unless ``keep_archives`` names a folder for them.  See :func:`write` for nulls, ties and repeated rows.
    """
    spark, path, scratch = pages.sparkSession, keep_archives or shared_dir(pages.sparkSession), Scratch(pages.sparkSession)
    write(pages, path)
    c = captures(records(spark, path), scratch, payload=False)
    again = F.col("record_type") == "revisit"
    out = stored(c.select(
        page_of(F.col("metadata")).alias("page_id"), F.when(again, F.col("of.payload_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("of.payload_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"), "record_type",
        F.when(again, page_of(F.col("of.metadata"))).alias("refers_to"),
    ))
    scratch.clear()
    if not keep_archives:
        remove(spark, path)
    return out


ORACLE = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS b FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS head FROM p)
    SELECT page_id, b AS payload_bytes, d AS payload_digest, CASE WHEN b >= 100 AND page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN b >= 100 AND page_id IS DISTINCT FROM head THEN head END AS refers_to FROM f
"""
