"""Tender numbers that are similar to or contained in others of their scope, found within tasks.

Both sides are dealt by scope, a scope of many texts as a grid of cells: each row is sent once for each cell of its row or
column, mostly one, and no index of parts is ever shuffled.  A cell's texts are compared in one task by the trigrams that are
rare in it, so every pair is found in exactly one cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions.trigram import SEPARATORS
from garimpo.sources.shared import small, stored

#: Texts of either side in one cell.  Scopes below a quarter of it share cells.
CELL = 100_000
#: Combinations of first trigrams that a text may have; beyond, texts meet by one.
MARKS = 64
#: First letters of a text by which those that contain it are found; the second where it is that long.
LETTERS = (3, 6)
#: Meetings that a task holds at a time.
AT_ONCE = 1 << 20
#: Patterns that more than one text fits.
WILD = r"[%_\\]"
_WORD = np.array([chr(c).isalnum() for c in range(128)])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letters(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, lengths)"""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.fromiter(map(len, texts), np.int64, len(texts))


def trigram_sets(texts: pd.Series, scope: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, scope, trigram) of distinct trigrams, by row; words of these texts are runs of ASCII letters and digits, and all beyond ASCII."""
    cp, n = letters(texts)
    row = np.repeat(np.arange(len(texts)), n + 1)
    every = np.full(len(row) + 1, 32, np.int64)
    at = np.ones(len(every), bool)
    at[0] = False
    at[1:][np.cumsum(n + 1) - 1] = False
    every[at] = cp
    every[~((every > 127) | _WORD[np.minimum(every, 127)])] = 32
    times = np.where(every == 32, 3, 1)
    every, row = np.repeat(every, times), np.repeat(np.r_[0, row], times) if len(row) else np.empty(0, np.int64)
    first, mid, last = every[:-2], every[1:-1], every[2:]
    fits = (mid != 32) | ((first == 32) & (last != 32))
    tri, row = (first << 42 | mid << 21 | last)[fits], row[2:][fits]
    known = np.unique(tri)
    # Sorted as numbers of row and trigram, which is much faster than by both.
    both = np.sort(row * len(known) + np.searchsorted(known, tri))
    both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
    row, tri = both // max(len(known), 1), known[both % max(len(known), 1)]
    return row, scope[row], tri


def least_shared(na, nb, least: float):
    """Trigrams that sets of na and nb share at least where their similarity is above ``least``."""
    return np.maximum(np.floor((na + nb) * (least / (1 + least)) - 1e-6).astype(np.int64) + 1, 1)


class Side:
    """Texts of one side: for each number of trigrams, the rows and their ranks, rarest first, as a matrix."""

    def __init__(self, row: np.ndarray, rank: np.ndarray, rows: int):
        most, n = int(rank.max(initial=0)) + 1, np.bincount(row, minlength=rows)
        rank = (np.sort(row * most + rank) % most).astype(np.int32)
        start = np.cumsum(n) - n
        self.n, self.place, self.rows, self.ranks, self.bits, self.kept = n, np.zeros(rows, np.int64), {}, {}, {}, {}
        for k in np.unique(n[n > 0]).tolist():
            at = np.flatnonzero(n == k)
            self.place[at] = np.arange(len(at))
            self.rows[k], self.ranks[k] = at, rank[start[at][:, None] + np.arange(k)]
            bit = np.left_shift(np.uint64(1), (self.ranks[k].astype(np.uint64) * _BASE) >> np.uint64(58))
            self.bits[k] = np.bitwise_or.reduce(bit, axis=1)

    def marks(self, k: int, front: int, m: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(mark, place): a number for each m of the first ``front`` ranks of the texts with k trigrams."""
        r = self.ranks[k][:, :front].astype(np.int64)
        if m == 1:
            return r.T.ravel(), np.tile(np.arange(len(r)), front)
        i, j = np.triu_indices(front, 1)
        return (r[:, i] * most + r[:, j]).T.ravel(), np.tile(np.arange(len(r)), len(i))

    def sorted_marks(self, *asked: int) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`marks` by mark, kept for the classes that ask for the same."""
        if asked not in self.kept:
            x, place = self.marks(*asked)
            n = len(self.rows[asked[0]])
            if int(x.max(initial=0)) < (1 << 62) // n:
                x = np.sort(x * n + place)
                self.kept[asked] = x // n, (x % n).astype(np.int32)
            else:
                order = np.argsort(x, kind="stable")
                self.kept[asked] = x[order], place[order].astype(np.int32)
        return self.kept[asked]


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many ranks the rows of two matrices share, row by row."""
    out = np.zeros(len(x), np.int64)
    for j in range(y.shape[1]):
        out += (x == y[:, j : j + 1]).any(1)
    return out


def _meetings(marks_a: np.ndarray, marks_b: np.ndarray):
    """Slices of (i, j) with ``marks_a[i] == marks_b[j]``, ``AT_ONCE`` or so at a time; both are sorted."""
    if not len(marks_a) or not len(marks_b):
        return
    new_a, new_b = (np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) for x in (marks_a, marks_b))
    own = marks_b[new_b]
    at = np.minimum(np.searchsorted(own, marks_a[new_a]), len(own) - 1)
    same = own[at] == marks_a[new_a]
    times = np.diff(np.r_[new_a, len(marks_a)])
    lo = np.repeat(new_b[at], times)
    each = np.repeat(np.where(same, np.diff(np.r_[new_b, len(marks_b)])[at], 0), times)
    met = np.flatnonzero(each)
    lo, each = lo[met], each[met]
    ends = np.cumsum(each)
    s = 0
    while s < len(met):
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + AT_ONCE, "right")))
        n = each[s:e]
        yield np.repeat(met[s:e], n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[s:e], n)
        s = e


def _similarity(shared: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    return (shared / np.maximum(na + nb - shared, 1)).astype(np.float32)


def near(a: Side, b: Side, most: int, least: float) -> list[tuple[np.ndarray, ...]]:
    """(row of a, row of b, similarity) of all pairs above ``least``, by classes of set sizes.

    Sets of na and nb share c trigrams at least, so the first m that both have lie among the first na - c + m and nb - c + m.
    """
    out = []
    for na, rows_a in a.rows.items():
        a.kept.clear()
        for nb, rows_b in b.rows.items():
            c = int(least_shared(na, nb, least))
            if c > min(na, nb):
                continue
            m = 2 if c >= 2 and max(na, nb) - c + 2 <= int((2 * MARKS) ** 0.5) + 1 else 1
            (xa, pa), (xb, pb) = a.sorted_marks(na, na - c + m, m, most), b.sorted_marks(nb, nb - c + m, m, most)
            found = []
            for i, j in _meetings(xa, xb):
                i, j = pa[i], pb[j]
                fits = np.bitwise_count(a.bits[na][i] & ~b.bits[nb][j]) <= na - c
                i, j = i[fits], j[fits]
                fits = np.bitwise_count(b.bits[nb][j] & ~a.bits[na][i]) <= nb - c
                pair = np.unique(i[fits].astype(np.int64) * len(rows_b) + j[fits])
                i, j = pair // len(rows_b), pair % len(rows_b)
                score = _similarity(_shared(a.ranks[na][i], b.ranks[nb][j]), na, nb)
                found.append(pair[score > np.float32(least)])
            pair = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
            if len(pair):
                i, j = pair // len(rows_b), pair % len(rows_b)
                out.append((rows_a[i], rows_b[j], _similarity(_shared(a.ranks[na][i], b.ranks[nb][j]), na, nb)))
    return out


def _windows(cp: np.ndarray, n: np.ndarray, scope: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of k letters of each text."""
    if len(cp) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    fits = row[: len(row) - k + 1] == row[k - 1 :]
    h = np.zeros(len(cp) - k + 1, np.uint64)
    for i in range(k):
        h = h * _BASE + cp[i : len(cp) - k + 1 + i]
    row = row[: len(row) - k + 1][fits]
    return (h[fits] + scope[row].astype(np.uint64)) * _BASE, row


def inside(asked: pd.Series, scope_a: np.ndarray, whole: pd.Series, scope_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of asked, row of whole), equal in scope, of texts of three letters or more and the texts that contain them."""
    few, more = LETTERS
    asked, whole = asked.to_numpy(object), whole.to_numpy(object)
    (ca, na), (cb, nb) = letters(asked), letters(whole)
    start, out_a, out_b = np.cumsum(na) - na, [], []
    for k, rows in ((more, np.flatnonzero(na >= more)), (few, np.flatnonzero((na >= few) & (na < more)))):
        if not len(rows):
            continue
        heads = ca[start[rows][:, None] + np.arange(k)].ravel()
        ha, at = _windows(heads, np.full(len(rows), k), scope_a[rows], k)
        hb, in_b = _windows(cb, nb, scope_b, k)
        order_a, order_b = np.argsort(ha, kind="stable"), np.argsort(hb, kind="stable")
        for i, j in _meetings(ha[order_a], hb[order_b]):
            pair = np.unique(rows[at[order_a[i]]] * len(whole) + in_b[order_b[j]])
            i, j = pair // len(whole), pair % len(whole)
            holds = np.fromiter((x in y for x, y in zip(asked[i], whole[j])), bool, len(i)) & (scope_a[i] == scope_b[j])
            out_a.append(i[holds])
            out_b.append(j[holds])
    empty = [np.empty(0, np.int64)]
    return np.concatenate(out_a or empty), np.concatenate(out_b or empty)


def compare(left: pd.DataFrame, right: pd.DataFrame, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of left, row of right, similarity) of the pairs of one cell; equal texts of a scope are compared once."""
    sides = [df.drop_duplicates(["scope", "low"]).reset_index(drop=True) for df in (left, right)]
    scopes = [df["scope"].to_numpy(np.int64) for df in sides]
    parts = [trigram_sets(df["words"].fillna(df["low"]), s) for df, s in zip(sides, scopes)]
    # Ranks of the trigrams of each scope, those that few texts of the right side have first.
    tri = np.unique(np.concatenate([p[2] for p in parts]))
    place = np.unique(np.concatenate(scopes))
    keys = [np.searchsorted(place, p[1]) * len(tri) + np.searchsorted(tri, p[2]) for p in parts]
    every, often = np.unique(keys[1], return_counts=True)
    both = np.unique(np.concatenate([np.unique(keys[0]), every]))
    df = np.zeros(len(both), np.int64)
    df[np.searchsorted(both, every)] = often
    rank = np.empty(len(both), np.int32)
    rank[np.argsort(df, kind="stable")] = np.arange(len(both), dtype=np.int32)
    a, b = [Side(p[0], rank[np.searchsorted(both, k)], len(side)) for p, k, side in zip(parts, keys, sides)]
    found = near(a, b, len(both), least)
    i, j, score = (np.concatenate([x[k] for x in found]) if found else np.empty(0, t) for k, t in enumerate((np.int64, np.int64, np.float32)))
    plain = np.flatnonzero(sides[0]["plain"].to_numpy(bool))
    hi, hj = inside(sides[0]["low"].iloc[plain], scopes[0][plain], sides[1]["low"], scopes[1])
    more = np.setdiff1d(plain[hi] * len(sides[1]) + hj, i * len(sides[1]) + j)
    hi, hj = more // len(sides[1]), more % len(sides[1])
    shared = np.zeros(len(hi), np.int64)
    for na, nb in {(x, y) for x, y in zip(a.n[hi].tolist(), b.n[hj].tolist()) if x and y}:
        at = np.flatnonzero((a.n[hi] == na) & (b.n[hj] == nb))
        shared[at] = _shared(a.ranks[na][a.place[hi[at]]], b.ranks[nb][b.place[hj[at]]])
    i, j, score = np.r_[i, hi], np.r_[j, hj], np.r_[score, _similarity(shared, a.n[hi], b.n[hj])]
    for k, (df, side) in enumerate(zip((left, right), sides)):  # all rows that have these texts
        if len(df) > len(side):
            own = df[["scope", "low"]].merge(side[["scope", "low"]].assign(_at=np.arange(len(side))), on=["scope", "low"], how="left")["_at"].to_numpy()
            order = np.argsort(own, kind="stable")
            n = np.bincount(own, minlength=len(side))
            at, x = np.cumsum(n) - n, (i, j)[k]
            times = np.repeat(np.arange(len(x)), n[x])
            rows = order[np.arange(len(times)) - np.repeat(np.cumsum(n[x]) - n[x], n[x]) + np.repeat(at[x], n[x])]
            i, j, score = (rows, j[times], score[times]) if k == 0 else (i[times], rows, score[times])
    return i, j, score


def near_or_containing(asked: DataFrame, offered: DataFrame, least: float, scope: list[str]) -> DataFrame:
    """``a, b, text_b, kind, score``: pairs, equal in ``scope``, of trigram similarity above ``least`` or where b's text contains a's.

    ``asked`` has ``a, text, kind`` (passed on), ``offered`` has ``b, text``, both the ``scope`` columns; ``a`` and ``b`` are
    unique in a scope.  Letter case counts for neither.  Texts of a that :func:`plain` tells are compared as they are; others are only compared by similarity.
    """
    counts = asked.groupBy(*scope).agg(F.count("*").alias("na")).join(offered.groupBy(*scope).agg(F.count("*").alias("nb")), scope)
    high, wide = (F.ceil(F.col(n) / CELL).cast("int") for n in ("na", "nb"))
    scopes = stored(counts.select(*scope, (F.col("na") + F.col("nb")).alias("rows"), high.alias("high"), wide.alias("wide"), F.monotonically_increasing_id().alias("scope")))
    own = F.col("rows") > CELL // 4
    shared = scopes.filter(~own).agg(F.sum("rows")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("scope"), F.lit(1 + 4 * shared // CELL))
    scopes = small(scopes.withColumns({"own": own, "cell": F.when(own, F.col("scope")).otherwise(bucket)}))

    def dealt(df: DataFrame, key: str, up: Column, across: Column, *more: str) -> DataFrame:
        low = F.lower(F.coalesce("text", F.lit("")))
        words = F.when(low.rlike(r"[^\x00-\x7F]"), F.regexp_replace(low, SEPARATORS, " "))
        cells = df.join(scopes, scope).select(*[F.col(c).alias(c) for c in ("own", "cell", "scope")], up.alias("up"), across.alias("across"), key, low.alias("low"), words.alias("words"), F.when(F.col("text") != low, F.col("text")).alias("text"), *more)
        return cells.groupBy("own", "cell", "up", "across")

    def share(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        i, j, score = compare(left, right, least) if len(left) and len(right) else [np.empty(0, np.int64)] * 3
        text = right["text"].fillna(right["low"]).to_numpy(object)
        return pd.DataFrame({"a": left["a"].to_numpy()[i], "b": right["b"].to_numpy()[j], "text_b": text[j], "kind": left["kind"].to_numpy()[i], "score": score})

    rows_a = dealt(asked.withColumn("plain", plain(F.col("text"))), "a", share("a", "high"), every("wide"), "kind", "plain")
    rows_b = dealt(offered, "b", every("high"), share("b", "wide"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in (("a", dict(asked.dtypes)["a"]), ("b", dict(offered.dtypes)["b"]), ("text_b", "string"), ("kind", "float"), ("score", "float")))
    return rows_a.cogroup(rows_b).applyInPandas(run, kinds)


def plain(text: Column) -> Column:
    """Whether a pattern stands for itself and has as many letters as an index needs."""
    return (F.length(F.lower(text)) >= LETTERS[0]) & ~text.rlike(WILD)
