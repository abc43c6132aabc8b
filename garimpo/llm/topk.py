"""Exact top-k by inner product with block-at-a-time pruning.

Rows are cut into document-range blocks that keep their vectors as one matrix (a forward
index) and, for every component, its largest and smallest value.  A block's bound for a
query is the sum over components of the larger product with those two.  A query visits
blocks by falling bound and stops when the next bound lies below its kth score.

Blocks lie in bands, ranges of rows of a bounded number, and queries in groups; a cell of this
grid is one task.  Bounds act across cells as well: a query first visits the band with the
largest bound, and then, with the kth score from there, only bands that can still beat it.
The lists of its bands are merged.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import Scratch, partitions, stored

BLOCK_ROWS = 256
#: Rows and queries of one cell of the grid.
CELL_ROWS = 16_384
CELL_QUERIES = 1_024
#: Bytes of all bands' bounds up to which they are broadcast; beyond, every query visits every band.
BOUND_BYTES = 64 << 20
#: Below every score of the 64-bit path; its negative is a 64-bit integer too.
NONE = -(1 << 62)
#: Scores travel as two longs, ``hi * 2**PART + lo``, as they may need more than 64 bits.
PART = 62
LAST = np.iinfo(np.int64).max
FOUND = "query bigint, query_id bigint, vec_id bigint, hi bigint, lo bigint"


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of every component, as doubles; no component is held within limits.

    Rows with null, NaN or infinite parts are left out, and so are doubles that only the
    product with ``scale`` makes infinite.
    """
    scaled = F.transform(F.col(embedding), lambda c: c.cast("double") * scale)
    bad = F.exists(scaled, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # From 2**53 on doubles are whole, and floor() would leave 64 bits.
    whole = F.transform(scaled, lambda c: F.when(F.abs(c) < float(1 << 53), F.floor(c).cast("double")).otherwise(c))
    return vectors.filter(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v")
    )


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _listed(query: np.ndarray, qid: np.ndarray, vec_id: np.ndarray, scores: list[int]) -> pd.DataFrame:
    hi = [max(-(1 << 63), min((1 << 63) - 1, s >> PART)) for s in scores]
    lo = [s & ((1 << PART) - 1) for s in scores]
    return pd.DataFrame({c: np.array(x, np.int64) for c, x in zip(("query", "query_id", "vec_id", "hi", "lo"), (query, qid, vec_id, hi, lo))})


def best_of_cell(queries: pd.DataFrame, rows: pd.DataFrame, k: int, block_rows: int) -> tuple[pd.DataFrame, int]:
    """The k best rows of a cell for each query, and how many (query, block) pairs were scored.

    Both frames have ``row, vec_id, v``; a query is no candidate of its own row.
    """
    if not len(queries) or not len(rows):
        return _listed(*[np.empty(0, np.int64)] * 3, []), 0
    width = max(1, queries["v"].map(len).max(), rows["v"].map(len).max())
    rows = rows.sort_values(["vec_id", "row"], kind="stable")
    ids, own, m = rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64), _matrix(rows["v"], width)
    q, qid, qrow = _matrix(queries["v"], width), queries["vec_id"].to_numpy(np.int64), queries["row"].to_numpy(np.int64)
    most = float(np.abs(q).max()) * float(np.abs(m).max()) * width
    if most >= 1 << 61:
        return _best_of_wide(q, qid, qrow, m, ids, own, k), len(q)
    starts = np.arange(0, len(ids), block_rows)
    if most >= 1 << 52:  # products of doubles are exact below
        q, m = q.astype(np.int64), m.astype(np.int64)
    hi, lo = np.maximum.reduceat(m, starts), np.minimum.reduceat(m, starts)
    bounds = (np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T).astype(np.int64)
    order = np.argsort(-bounds, axis=1, kind="stable")
    n = len(q)
    best_score = np.full((n, k), NONE)
    best_id = np.full((n, k), LAST)
    live, scored = np.arange(n), 0
    for step in range(len(starts)):
        block = order[live, step]
        # A bound equal to the kth score may still bring a smaller identifier.
        live, block = (x[go] for go in [bounds[live, block] >= best_score[live, k - 1]] for x in (live, block))
        if not len(live):
            break
        scored += len(live)
        for b in np.unique(block):
            who = live[block == b]
            part = slice(starts[b], starts[b] + block_rows)
            score = (q[who] @ m[part].T).astype(np.int64)
            score[qrow[who][:, None] == own[part][None, :]] = NONE
            every = np.concatenate([best_score[who], score], 1)
            names = np.concatenate([best_id[who], np.broadcast_to(ids[part], score.shape)], 1)
            names = np.where(every == NONE, LAST, names)
            first = np.lexsort((names, -every), axis=1)[:, :k]
            best_score[who] = np.take_along_axis(every, first, 1)
            best_id[who] = np.take_along_axis(names, first, 1)
    found = best_score > NONE
    of = np.repeat(np.arange(n), k)[found.ravel()]
    return _listed(qrow[of], qid[of], best_id[found], best_score[found].tolist()), scored


def _best_of_wide(q, qid, qrow, m, ids, own, k: int) -> pd.DataFrame:
    """The same for components whose products leave 64 bits, in whole numbers of any length."""
    rows, out = [[int(x) for x in r] for r in m], []
    for i in range(len(q)):
        one = [int(x) for x in q[i]]
        scores = ((-sum(a * b for a, b in zip(one, r)), int(ids[j])) for j, r in enumerate(rows) if own[j] != qrow[i])
        out += [(qrow[i], qid[i], d, -s) for s, d in heapq.nsmallest(k, scores)]
    cols = list(zip(*out)) if out else [()] * 4
    return _listed(*[np.array(c, np.int64) for c in cols[:3]], list(cols[3]))


def band_bounds(rows: DataFrame) -> DataFrame:
    """``band, i, hi, lo``: the largest and smallest value of every component in a band."""
    return rows.select("band", F.posexplode("v").alias("i", "c")).groupBy("band", "i").agg(F.max("c").alias("hi"), F.min("c").alias("lo"))


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    block_rows: int = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
    cell_queries: int = CELL_QUERIES,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each row with ``vec_id % every = 0``.

    Scores are inner products of the quantised vectors; ties go to the smaller ``vec_id``;
    a query is no candidate of its own.  Vectors of different lengths are compared as if
    the shorter one ended in zeros, so an empty one scores 0 with all.  Rows that repeat a ``vec_id``
    are rows of their own, candidates of each other and, where they are queries, with a list each.
    Ranks follow whole scores; one beyond 64 bits is returned as the largest or smallest long.  An
    empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.stored(quantised(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    bands = max(partitions(vectors.sparkSession), -(-n // cell_rows)) if n > min(4096, cell_rows) else 1
    groups = max(1, -(-n // (every * cell_queries)))
    # Ranges of rows, of sampled splitters: gaps between identifiers and repeated ones don't matter.
    rows = scratch.stored(rows.repartitionByRange(bands, "vec_id", "row").withColumn("band", F.spark_partition_id()))
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("grp"), "row", "vec_id", "v")
    near = scratch.stored(band_bounds(rows)).toPandas() if bands * _longest(rows) * 16 <= BOUND_BYTES else None

    def visited(queries: DataFrame) -> DataFrame:
        cells = scratch.stored(queries.select("grp", "band").distinct())
        data = for_cells(rows, cells, groups * bands)
        named = queries.select(F.col("grp").alias("q_grp"), F.col("band").alias("q_band"), F.col("row").alias("q_row"), F.col("vec_id").alias("q_id"), F.col("v").alias("q_v"))

        def cell(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
            return best_of_cell(q.rename(columns={"q_row": "row", "q_id": "vec_id", "q_v": "v"}), d, k, block_rows)[0]

        return named.groupBy("q_grp", "q_band").cogroup(data.groupBy("grp", "band")).applyInPandas(cell, FOUND)

    if near is None or not len(near):
        found = visited(asked.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(_bands(rows) - 1)))))
    else:
        bound = _bounds_of(near)
        first = scratch.stored(visited(_banded(asked, bound, None)))
        kth = first.groupBy("query").agg(F.array_sort(F.collect_list((F.col("hi") * float(1 << PART) + F.col("lo").cast("double")))).alias("s"))
        kth = scratch.stored(kth.select("query", F.when(F.size("s") >= k, F.col("s")[0]).otherwise(F.lit(float("-inf"))).alias("kth")))
        rest = asked.join(kth, F.col("row") == F.col("query"), "left").select("grp", "row", "vec_id", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
        found = first.unionByName(visited(_banded(rest, bound, "kth")))
    best = Window.partitionBy("query").orderBy(F.col("hi").desc(), F.col("lo").desc(), "vec_id")
    score = F.when(F.col("hi") > 1, F.lit(LAST)).when(F.col("hi") < -2, F.lit(-LAST - 1)).otherwise(F.shiftleft("hi", PART) + F.col("lo"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
    ranked = stored(ranked)
    scratch.clear()
    return ranked


#: Pairs of a query group and a band up to which their lists are broadcast: 16 MB.
FEW_CELLS = 4_000_000


def for_cells(rows: DataFrame, cells: DataFrame, most: int) -> DataFrame:
    """``band, row, vec_id, v, grp``: the rows of each band, once for every query group that visits it (``cells``: ``grp, band``, ``most`` of them)."""
    visits = cells.groupBy(F.col("band").alias("c_band")).agg(F.collect_set("grp").alias("grps"))
    visits = F.broadcast(visits) if most <= FEW_CELLS else visits
    return rows.join(visits, F.col("band") == F.col("c_band")).select("band", "row", "vec_id", "v", F.explode("grps").alias("grp"))


def _longest(rows: DataFrame) -> int:
    return rows.agg(F.max(F.size("v"))).first()[0] or 0


def _bands(rows: DataFrame) -> int:
    return 1 + (rows.agg(F.max("band")).first()[0] or 0)


def _bounds_of(near: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bands, hi, lo) as matrices; where a band has shorter vectors, the zeros they end in count too."""
    bands, at = np.unique(near["band"].to_numpy(), return_inverse=True)
    hi, lo = np.zeros((2, len(bands), int(near["i"].max()) + 1))
    hi[at, near["i"]], lo[at, near["i"]] = near["hi"], near["lo"]
    return bands, np.maximum(hi, 0), np.minimum(lo, 0)


def _banded(asked: DataFrame, bound: tuple, kth: str | None) -> DataFrame:
    """Queries with the band of the largest bound or, given a kth score, with every other band that may reach it."""
    sent = asked.sparkSession.sparkContext.broadcast(bound)  # BOUND_BYTES at most

    def run(batches):
        bands, hi, lo = sent.value
        for pdf in batches:
            for s in range(0, len(pdf), 256):
                part = pdf.iloc[s : s + 256]
                q = _matrix(part["v"], max(hi.shape[1], part["v"].map(len).max()))[:, : hi.shape[1]]
                top = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
                home = top.argmax(1)
                go = np.zeros(top.shape, bool)
                if kth is None:
                    go[np.arange(len(part)), home] = True
                else:
                    slack = 1e-9 * (np.abs(q) @ np.maximum(hi, -lo).T)  # doubles round sums
                    least = part[kth].to_numpy()[:, None]
                    go = top + slack >= least - 1e-9 * np.abs(least)
                    go[np.arange(len(part)), home] = False
                who, band = np.nonzero(go)
                yield pd.DataFrame({"grp": part["grp"].to_numpy()[who], "row": part["row"].to_numpy()[who], "vec_id": part["vec_id"].to_numpy()[who], "v": part["v"].to_numpy()[who], "band": bands[band]})

    return asked.mapInPandas(run, "grp int, row long, vec_id long, v array<double>, band int")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""
