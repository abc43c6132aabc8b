"""Packing tokenised documents into sequences by the sum-of-squares rule.

A piece goes where the sum of squares of the counts of open bins, taken for every
residual gap, becomes smallest.  Tokenising happens where the texts are read; only piece
lengths and places move.  Pieces are dealt into groups of bounded size by a hash and each
group is packed by itself.  Full bins are final; the few hundredths of the pieces that lie
in bins left open are dealt again into fewer groups.  The last level takes them by
falling length, by the same rule or by best fit, whichever needs fewer sequences.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import stored
from garimpo.llm.words import trim

CAPACITY = 1024
END_ID = 2
#: Pieces that one task packs together, about.
GROUP_ROWS = 60_000
#: Most rounds of dealing; at the last one every bin is final.
LEVELS = 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_bpe(name: str = "byte_bpe_50k"):
    """An encoder of texts to ids, equal to the ``tokenizers`` file of that name.

    The rank form of the same vocabulary is about four times as fast.  It gives the same
    ids for texts of the characters in ``usual``; other texts, and those that spell the
    special token, go to the ``tokenizers`` file itself.
    """
    import base64
    import os
    import re

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = lru_cache(1)(lambda: Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))  # large, and few tables need it
    unusual = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ]")

    def encode(text: str) -> list[int]:
        if unusual.search(text) or "<|endoftext|>" in text:
            return exact().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones but for the first, which takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def tokenised_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(end_id)
                if ids.itemsize != 4 or np.little_endian is False:
                    ids = np.asarray(ids, "<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length] if with_ids else None
                    out.append((doc, k, start, length, zlib.crc32(memoryview(ids)[start : start + length].tobytes()), own))
            cols = list(zip(*out)) if out else [[]] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                arrays.append(pa.array([list(x) for x in cols[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])
            batch = text = None  # before the next one comes, not after
            trim()
        # Workers live on after the task; the vocabulary would stay with them.
        del encode
        trim()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"{PIECES}, ids array<int>" if with_ids else PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every length, in order.

    ``count[g]`` open bins have gap ``g``.  Moving one from ``g`` to ``g - s`` changes the sum
    of squares by ``2 (count[g-s] - count[g]) + 2``, or ``1 - 2 count[g]`` where it fills up;
    a new bin adds ``2 count[capacity-s] + 1``.  Ties: the smallest gap left.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    none = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        if s >= capacity:
            bins[i], offsets[i], n = n, 0, n + 1
            continue
        have = count[s:]
        change = np.where(have > 0, 2 * (count[: capacity + 1 - s] - have) + 2, none)
        if have[0] > 0:
            change[0] = 1 - 2 * have[0]
        at = int(change.argmin())
        if change[at] <= 2 * count[capacity - s] + 1:
            gap = at + s
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(b)
    return bins, offsets


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every length, in order: each goes into the open bin with the smallest gap that takes it."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = np.zeros(capacity + 1, bool)
    bins, offsets, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        gap = s + int(there[s:].argmax()) if s <= capacity else capacity
        if s <= capacity and there[gap]:
            b = open_bins[gap].pop()
            there[gap] = bool(open_bins[gap])
        else:
            gap, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            open_bins[gap - s].append(b)
            there[gap - s] = True
    return bins, offsets


def fewest(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Lengths in falling order by the sum of squares or by best fit, whichever takes fewer bins; ties: sum of squares."""
    ways = [way(lengths, capacity) for way in (sum_of_squares, best_fit)]
    return min(ways, key=lambda w: len(w[0]) and w[0].max())


def _pack_groups(items: DataFrame, capacity: int, last: bool) -> DataFrame:
    """``grp, item, length, h`` to ``item, length, h, bin, place, filled``; shuffled order, by falling length at the last level."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "h", "item"] if last else ["h", "item"], ascending=[False, True, True] if last else True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets = (fewest if last else sum_of_squares)(lengths, capacity)
        filled = np.bincount(bins, lengths, minlength=1).astype(np.int64)
        return pd.DataFrame(
            {"item": pdf["item"], "length": lengths, "h": pdf["h"], "bin": key[0] * (1 << 32) + bins, "place": offsets, "filled": filled[bins]}
        )

    return items.groupBy("grp").applyInPandas(one, "item string, length long, h long, bin long, place long, filled long")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and then ``end_id``; only documents of over ``capacity`` ids are
    cut, and only their first piece may be shorter than that.  Null text counts as empty, a
    piece with the end id alone; a row with a null identifier and rows that repeat one are
    packed like others.  An empty table gives no pieces.
    """
    return _placed(tokenised_pieces(docs, capacity, end_id), capacity, group_rows).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _placed(pieces: DataFrame, capacity: int, group_rows: int) -> DataFrame:
    """The pieces, each a row of its own whatever its identifier, with ``sequence_id, offset``."""
    pieces = stored(pieces.withColumn("item", F.uuid()))
    items = pieces.filter(F.col("length") < capacity).select(
        "item", "length", F.xxhash64("doc_id", "piece", "ids_crc32").alias("h")
    )
    groups, level, parts = max(1, -(-items.count() // group_rows)), 0, []
    while True:
        last = level and groups == 1 or level == LEVELS - 1
        dealt = items.withColumn("grp", F.pmod(F.xxhash64("h", F.lit(level)), F.lit(groups)))
        packed = stored(_pack_groups(dealt, capacity, last).withColumn("bin", F.col("bin") + F.lit(level << 56)))
        if last:
            parts.append(packed)
            break
        parts.append(packed.filter(F.col("filled") == capacity))
        items = packed.filter(F.col("filled") < capacity).select("item", "length", "h")
        level, groups = level + 1, max(1, -(-items.count() // group_rows))
    where = reduce(DataFrame.unionByName, parts).select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    whole = pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    return pieces.join(where, "item").unionByName(whole)


def sequences(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, n_tokens, ids`` (padding is left to the reader).

    Every row's ids are in them once, also of rows with null or repeated identifiers.
    """
    parts = _placed(tokenised_pieces(docs, capacity, end_id, with_ids=True), capacity, group_rows)
    by_offset = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return by_offset.select(
        "sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids")
    ).withColumn("n_tokens", F.size("ids"))
