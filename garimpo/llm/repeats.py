"""Removing long repeated byte strings across documents, by suffix arrays over the candidates.

Two equal strings of ``length`` bytes have the same smallest hash among their k-grams.  That
hash deals the work: it decides where two strings meet, so nothing has to be compared
across places.

1. Every task takes the smallest hash of each of its strings; those of one document only
   can't repeat.  Hashes met in two documents of a task are settled there; of such a hash only
   one record is sent on, so a passage that very many documents share stays small.
2. Documents with a repeated hash are read again; the stretches of strings with such a hash
   are dealt by it, equal stretches of a task once.  A hash with very many stretches is
   split by a second hash of each string.
3. Each place sorts the suffixes of its stretches (enhanced suffix array), scans the common
   prefixes into their interval tree and takes the maximal repeats with all occurrences;
   occurrences in documents after the smallest one are marked.
4. Marks are merged for each document and its other bytes kept.

Texts with an equal text of a smaller identifier are marked whole beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import FEW_ROWS, partitions, stored
from garimpo.llm.suffixes import maximal_repeats
from garimpo.llm.words import mixed, trim

LENGTH = 50
GRAM = 18
#: Bytes of texts that a task handles at a time.
CHUNK = 1 << 20
#: Hashes of strings that a task gathers before it sends them on.
GATHERED = 200_000
#: Places for each partition at which stretches are compared; a task holds one at a time.
PLACES = 16
#: Stretches that a task gathers before it sends them on.
SENT = 30_000
#: Documents of one hash above which its stretches are split by a second hash.
HOT = 5_000
_BASE = 0x100000001B3
_SALT = np.uint64(0x9FB21C651E98DF25)
NO_ID = (1 << 63) - 1


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Scrambled polynomial hash of every k-gram, by doubling."""
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    level, size = b.astype(np.uint64) + np.uint64(1), 1
    out, have = None, 0
    while True:
        if k & size:
            if out is None:
                out, have = level, size
            else:
                n = min(len(level), len(out) - size)
                out, have = level[:n] * power(have) + out[size : size + n], have + size
        if have == k:
            return mixed(out[: max(0, len(b) - k + 1)])
        n = len(level) - size
        level, size = level[:n] * power(size) + level[size:], size * 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x, size = np.minimum(x[: len(x) - size], x[size:]), size * 2
    rest = w - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Strings:
    """The fixed-length strings of a few documents: their smallest hashes and runs of equal ones."""

    def __init__(self, texts: list[bytes], length: int, k: int):
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.base = np.cumsum(self.sizes) - self.sizes
        self.data = b"".join(texts)
        b = np.frombuffer(self.data, np.uint8)
        self.starts = self.ends = self.owner = np.empty(0, np.int64)
        self.least = np.empty(0, np.uint64)
        if len(b) < length:
            return
        self.grams = gram_hashes(b, k)
        low = sliding_min(self.grams, length - k + 1)
        n = np.maximum(0, self.sizes - length + 1)
        valid = np.zeros(len(low) + 1, bool)
        edge = np.zeros(len(b) + 1, np.int64)
        np.add.at(edge, self.base[n > 0], 1)
        np.add.at(edge, (self.base + n)[n > 0], -1)
        valid[: len(low)] = np.cumsum(edge)[: len(low)] > 0
        first = np.zeros(len(b) + 1, bool)
        first[self.base[self.sizes > 0]] = True
        new = np.empty(len(low), bool)
        new[0] = True
        new[1:] = (low[1:] != low[:-1]) | first[1 : len(low)] | ~valid[: len(low) - 1]
        self.starts = np.flatnonzero(new & valid[: len(low)])
        # A run ends where the next begins, or with its document's last string.
        self.owner = np.searchsorted(self.base, self.starts, side="right") - 1
        last = (self.base + n)[self.owner]
        self.ends = np.minimum(np.r_[self.starts[1:], len(low)], last)
        self.least = low[self.starts]
        self.low2 = None

    def second(self, length: int, k: int) -> np.ndarray:
        """Smallest hash under another order, for every string."""
        if self.low2 is None:
            self.low2 = sliding_min(mixed(self.grams ^ _SALT), length - k + 1)
        return self.low2


def _chunks(batch: pa.RecordBatch) -> Iterator[slice]:
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(1)]
    start = total = 0
    for i, s in enumerate(sizes):
        if total and total + s > CHUNK:
            yield slice(start, i)
            start, total = i, 0
        total += s
    if start < len(sizes):
        yield slice(start, len(sizes))


def _columns(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "bucket" else pa.binary()) for n, c in zip(names, cols)], names)


def _dealt(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1], True]) if len(b) else [0]
    for s, e in zip(cuts[:-1], cuts[1:]):
        yield (int(b[s]), *(a[order[s:e]].tobytes() for a in arrays))


def repeated_hashes(texts: DataFrame, length: int, k: int, n: int) -> DataFrame:
    """``doc_id, row, h``: hashes of a row that another document has too; ``texts`` are ``doc_id, text, row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nums, hs, ds, rs = batch.column(0).to_numpy(), batch.column(2).to_numpy(), [], [], []
            for part in _chunks(batch):
                x = Strings([v.as_py() or b"" for v in batch.column(1)[part]], length, k)
                hs.append(x.least)
                ds.append(ids[part][x.owner])
                rs.append(nums[part][x.owner])
                if sum(map(len, hs)) > GATHERED:
                    yield packed(np.concatenate(hs), np.concatenate(ds), np.concatenate(rs))
                    hs, ds, rs = [], [], []
            if hs:
                yield packed(np.concatenate(hs), np.concatenate(ds), np.concatenate(rs))
            trim()

    def packed(h: np.ndarray, d: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((r, d, h))
        h, d, r = h[order], d[order], r[order]
        once = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (r[1:] != r[:-1])] if len(h) else np.empty(0, bool)
        h, d, r = h[once], d[once], r[once]
        head = np.r_[True, h[1:] != h[:-1]] if len(h) else np.empty(0, bool)
        # Rows of one identifier are no other document to each other.
        cuts = np.flatnonzero(head)
        several = (d[cuts] != d[np.r_[cuts[1:], len(h)] - 1])[np.cumsum(head) - 1] if len(h) else head
        flag = np.where(several, 2, 0)
        sent = (h % np.uint64(n)).astype(np.int64)
        # 0: one document so far; 1: known to repeat, sent once; 2: settled here, passed through.
        keep = several & head
        rows = list(_dealt(
            np.concatenate([np.where(several, (d ^ r) % n, sent), sent[keep]]),
            np.concatenate([h, h[keep]]), np.concatenate([d, d[keep]]), np.concatenate([r, r[keep]]), np.concatenate([flag, np.ones(keep.sum(), np.int64)]).astype(np.int8),
        ))
        return _columns(["bucket", "h", "d", "r", "flag"], rows)

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        trim()
        h, d, r = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("h", np.uint64), ("d", np.int64), ("r", np.int64)))
        flag = np.frombuffer(b"".join(pdf["flag"]), np.int8)
        through, own = flag == 2, flag != 2
        order = np.lexsort((d[own], h[own]))
        ho, do, ro, fo = h[own][order], d[own][order], r[own][order], flag[own][order]
        head = np.r_[True, ho[1:] != ho[:-1]] if len(ho) else np.empty(0, bool)
        g = np.cumsum(head) - 1
        cuts = np.flatnonzero(head)
        many = np.zeros(len(ho), bool)
        if len(ho):
            differs = np.minimum.reduceat(do, cuts) != np.maximum.reduceat(do, cuts)
            many = (differs | (np.maximum.reduceat(fo, cuts) > 0))[g] & (fo == 0)
        return pd.DataFrame({
            "doc_id": np.concatenate([do[many], d[through]]),
            "row": np.concatenate([ro[many], r[through]]),
            "h": np.concatenate([ho[many], h[through]]).view(np.int64),
        })

    dealt = texts.mapInArrow(run, "bucket int, h binary, d binary, r binary, flag binary")
    return dealt.groupBy("bucket").applyInPandas(settle, "doc_id long, row long, h long")


def marks(texts: DataFrame, length: int, k: int, n: int) -> DataFrame:
    """``doc_id, row, s, e``: byte ranges to remove, for texts with their row and its repeated hashes ``hs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, int] = {}
            spans: list[tuple[int, int, int, int, int, bytes]] = []
            done: list[tuple[int, int, int, int]] = []
            ids, nums, lists, hots = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3), batch.column(4)
            for part in _chunks(batch):
                x = Strings([v.as_py() or b"" for v in batch.column(1)[part]], length, k)
                wanted = np.concatenate([np.asarray(v.values.to_numpy(), np.int64) for v in lists[part]] or [np.empty(0, np.int64)])
                hot = np.concatenate([np.asarray(v.values.to_numpy(), np.int64) for v in hots[part]] or [np.empty(0, np.int64)]).view(np.uint64)
                go = np.isin(x.least, wanted.view(np.uint64))
                starts, ends, owner, least = x.starts[go], x.ends[go], x.owner[go], x.least[go]
                if len(hot) and len(starts):
                    two = x.second(length, k)
                    split = np.isin(least, hot)
                    more = []
                    for s, e, o, h in zip(starts[split], ends[split], owner[split], least[split]):
                        cut = np.flatnonzero(two[s + 1 : e] != two[s : e - 1]) + s + 1
                        for a, b in zip(np.r_[s, cut], np.r_[cut, e]):
                            more.append((a, b, o, int(h) ^ int(two[a])))
                    if more:
                        a, b, o, h = zip(*more)
                        starts, ends, owner = np.r_[starts[~split], a], np.r_[ends[~split], b], np.r_[owner[~split], o]
                        least = np.concatenate([least[~split], np.array(h, np.uint64)])
                docs, own = ids[part][owner], nums[part][owner]
                local = starts - x.base[owner]
                for s, e, h, d, r, a in zip(starts.tolist(), ends.tolist(), least.tolist(), docs.tolist(), own.tolist(), local.tolist()):
                    body = x.data[s : e + length - 1]
                    first = seen.setdefault((h, body), len(spans))
                    # A second place in the same document is sent on like the first.
                    if first == len(spans) or spans[first][1] == d:
                        spans.append((h, d, r, a, e - s + length - 1, body))
                    elif spans[first][1] < d:
                        done.append((d, r, a, a + len(body)))
                    else:
                        old = spans[first]
                        done.append((old[1], old[2], old[3], old[3] + old[4]))
                        spans[first] = (h, d, r, a, len(body), body)
                if len(spans) > SENT:
                    yield packed(spans, done)
                    seen, spans, done = {}, [], []
            yield packed(spans, done)
            trim()

    def packed(spans: list[tuple], done: list[tuple]) -> pa.RecordBatch:
        rows = []
        if spans:
            h = np.array([s[0] for s in spans], np.uint64)
            order = np.argsort(h % np.uint64(n), kind="stable")
            bucket = (h % np.uint64(n)).astype(np.int64)[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for s, e in zip(cuts[:-1], cuts[1:]):
                own = [spans[i] for i in order[s:e]]
                nums = np.array([x[1:5] for x in own], np.int64)
                rows.append((int(bucket[s]), h[order[s:e]].tobytes(), nums.tobytes(), b"".join(x[5] for x in own)))
        if done:
            gone = _merged(np.array(done, np.int64))
            rows += [(b, b"", x, b"") for b, x in _dealt((gone[:, 0] ^ gone[:, 1]) % n, gone)]
        return _columns(["bucket", "h", "nums", "body"], rows)

    def repeats(pdf: pd.DataFrame) -> pd.DataFrame:
        trim()
        out, first = [np.empty((0, 4), np.int64)], {}
        hs, docs, own, starts, bodies = [], [], [], [], []
        for h, nums, body in zip(pdf["h"], pdf["nums"], pdf["body"]):
            nums = np.frombuffer(nums, np.int64).reshape(-1, 4)
            if not h:
                out.append(nums)
                continue
            at, gone = 0, []
            for key, (d, r, a, size) in zip(np.frombuffer(h, np.uint64).tolist(), nums.tolist()):
                text = body[at : at + size]
                at += size
                i = first.setdefault((key, text), len(hs))
                if i == len(hs) or docs[i] == d:
                    hs.append(key)
                    docs.append(d)
                    own.append(r)
                    starts.append(a)
                    bodies.append(text)
                elif docs[i] < d:
                    gone.append((d, r, a, a + size))
                else:
                    gone.append((docs[i], own[i], starts[i], starts[i] + size))
                    docs[i], own[i], starts[i] = d, r, a
            if gone:
                out.append(np.array(gone, np.int64))
        if hs:
            key = np.array(hs, np.uint64)
            _, where, size = np.unique(key, return_inverse=True, return_counts=True)
            some = np.flatnonzero(size[where] > 1)
            d, r, a = np.array(docs)[some], np.array(own)[some], np.array(starts)[some]
            found: list[np.ndarray] = []
            held = 0
            for n_bytes, who, at in maximal_repeats([bodies[i] for i in some], where[some], length, 2 * length):
                later = d[who] > d[who].min()
                if later.any():
                    s = (a[who] + at)[later]
                    found.append(np.stack([d[who][later], r[who][later], s, s + n_bytes], 1))
                    held += len(s)
                    if held > GATHERED:  # intervals of a text that repeats itself are nested
                        found, held = [_merged(np.concatenate(found))], 0
            if found:
                out.append(_merged(np.concatenate(found)))
        got = _merged(np.concatenate(out))
        return pd.DataFrame(dict(zip(("doc_id", "row", "s", "e"), got.T)))

    dealt = texts.mapInArrow(run, "bucket int, h binary, nums binary, body binary")
    return dealt.groupBy("bucket").applyInPandas(repeats, "doc_id long, row long, s long, e long")


def _merged(spans: np.ndarray) -> np.ndarray:
    """(doc, row, start, end) ranges, those of a row that touch or overlap made one."""
    if len(spans) < 2:
        return spans.reshape(-1, 4)
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    doc = np.cumsum(np.r_[0, (spans[1:, 0] != spans[:-1, 0]) | (spans[1:, 1] != spans[:-1, 1])])
    far = int(spans[:, 3].max()) + 1
    reach = np.maximum.accumulate(spans[:, 3] + doc * far)
    new = np.r_[True, spans[1:, 2] + doc[1:] * far > reach[:-1]]
    cuts = np.flatnonzero(new)
    ends = np.r_[cuts[1:], len(spans)] - 1
    return np.stack([spans[cuts, 0], spans[cuts, 1], spans[cuts, 2], reach[ends] - doc[ends] * far], 1)


#: What names a row: its identifier, and its number where identifiers repeat.
ROW = ["doc_id", "row"]


def _picked(texts: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Texts joined with the rows named; those are broadcast where they are few."""
    return texts.join(F.broadcast(rows) if rows.count() <= FEW_ROWS else rows, ROW, how)


def _numbered(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts with ``row``, ``doc_id, row, n_bytes, sha`` of each): 0 where no other row has the identifier.

    Rows that repeat an identifier are numbered by their text; equal ones share a number, as
    they lose the same bytes.  The numbers are stored, so every later reading finds the same.
    """
    ids = stored(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
    again = stored(ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"))
    n = again.count()
    if not n:
        return texts.withColumn("row", F.lit(0).cast("long")), ids.withColumn("row", F.lit(0).cast("long"))
    twins = ids.join(F.broadcast(again) if n <= FEW_ROWS else again, "doc_id", "left_semi").select("doc_id", "sha").distinct()
    twins = stored(twins.withColumn("row", F.monotonically_increasing_id() + 1))
    few = F.broadcast(twins) if twins.count() <= FEW_ROWS else twins
    known = lambda df: df.join(few, ["doc_id", "sha"], "left").withColumn("row", F.coalesce("row", F.lit(0).cast("long")))
    return known(texts.withColumn("sha", F.sha2("text", 256))).select("doc_id", "text", "row"), stored(known(ids))


def kept_texts(docs: DataFrame, length: int = LENGTH, k: int = GRAM) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept_text``; ``spans`` are the byte ranges removed.

    Bytes covered by a string of ``length`` bytes that also starts in a document with a
    smaller identifier are removed; strings are judged on the input and never cross
    documents.  ``kept_text`` is binary, as a cut may fall inside a character.  Null text counts as
    empty; shorter texts lose nothing.  A null identifier counts as larger than all
    others; rows that repeat an identifier are no documents with a smaller one to each
    other, and each loses what smaller ones hold, at its own places.
    """
    n = partitions(docs.sparkSession)
    texts, ids = _numbered(docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ))
    # Only texts that several documents have are looked up; one with very many of them is no hot key, as these are few rows.
    firsts = ids.filter(F.col("n_bytes") >= length).groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    firsts = stored(firsts.filter("first_id < last_id").select(F.col("sha").alias("f_sha"), "first_id"))
    few = F.broadcast(firsts) if firsts.count() <= FEW_ROWS else firsts
    judged = stored(ids.join(few, F.col("sha") == F.col("f_sha"), "left").select(*ROW, "n_bytes", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).alias("copy")))
    # What a whole copy holds, the smaller document holds too: it is neither searched nor searched against.
    singles = _picked(texts, judged.filter("copy").select(*ROW).distinct(), "left_anti").select("doc_id", "text", "row")
    found = stored(repeated_hashes(singles, length, k, n * PLACES // 4))
    crowded = stored(found.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("h", F.lit(True).alias("hot")))
    known = found.join(F.broadcast(crowded) if crowded.count() <= FEW_ROWS else crowded, "h", "left")
    per_doc = known.groupBy(*ROW).agg(F.collect_set("h").alias("hs"), F.collect_set(F.when(F.col("hot"), F.col("h"))).alias("hot_hs"))
    flagged = stored(found.select(*ROW).distinct())
    some = _picked(singles, flagged)
    gone = stored(marks(some.join(per_doc, ROW).select("doc_id", "text", "row", "hs", "hot_hs"), length, k, n * PLACES))
    spans = gone.groupBy(*ROW).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    touched = stored(gone.select(*ROW).distinct())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                spans, bodies, sizes = [], [], []
                for text, parts in zip(batch.column(1)[part], batch.column(2)[part]):
                    text = text.as_py()
                    got = _merged(np.array([(0, 0, p["s"], p["e"]) for p in parts.as_py()], np.int64))
                    kept, at = [], 0
                    for _, _, s, e in got.tolist():
                        kept.append(text[at:s])
                        at = e
                    spans.append([{"s": s, "e": e} for _, _, s, e in got.tolist()])
                    bodies.append(b"".join([*kept, text[at:]]))
                    sizes.append(len(text))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(bodies, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept_text"],
                )

    span = "array<struct<s: bigint, e: bigint>>"
    changed = _picked(singles, touched).join(spans, ROW).select("doc_id", "text", "spans").mapInArrow(cut, f"doc_id long, n_bytes long, spans {span}, kept_text binary")
    same = _picked(singles, touched, "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast(span).alias("spans"), F.col("text").alias("kept_text")
    )
    whole = judged.filter("copy").select(
        "doc_id", "n_bytes", F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("n_bytes").alias("e"))).cast(span).alias("spans"), F.lit("").cast("binary").alias("kept_text")
    )
    return same.unionByName(changed).unionByName(whole).withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def digests(kept: DataFrame) -> DataFrame:
    """``n_removed, n_spans, kept_sha256`` of the texts kept, beside them."""
    return kept.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept_text")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept_text", 256).alias("kept_sha256"), "kept_text",
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = GRAM) -> DataFrame:
    """:func:`kept_texts` with their digests: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text``."""
    return digests(kept_texts(docs, length, k))
