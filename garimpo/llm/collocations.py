"""Phrase collocations: suffix pointers sorted by multikey three-way quicksort, to a fixed depth.

*Words.*  A first pass counts words by language.  From then on a word is a 64-bit hash; the table
of all words shows whether two of them share one, and then another seed is taken, so hashes name
words exactly.

*Leading words.*  The leading pair of each suffix is counted by its hash in ``2^k`` buckets.  Pairs
below ``least`` are abandoned: the others set a bit each in a bit map of bounded size, which goes
to all tasks.  Pairs of equal hash or bit only let more suffixes through; counts never rest on it.

*Routing.*  A suffix is its next ``depth`` words inside the piece, cut before the first pair
that was abandoned.  Equal suffixes of a batch become one with a weight; suffixes go to buckets by their
leading pair.  Those of a *hot* pair go by all their words, so that one pair with a third of all
positions is spread as well.

*Sorting.*  A bucket's pointers are parted by the word at depth d into smaller, equal and larger ones; the
weight of the equal part is the count of its phrase and goes one word deeper; any part of less weight than
``least`` is abandoned.  Small parts are finished by one plain sort.  Buckets of hot pairs give
part counts of phrases, which are summed.

*Scores* are joins of phrases with the counts of their parts, in decimals of 38 digits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import Scratch, partitions
from garimpo.llm.words import WordHashes, mixed, shingles, trim

#: Bytes of text that a task handles at a time.
STEP = 8 << 20
#: Word positions for each bucket of pairs or suffixes.
BUCKET = 2_000_000
#: Bits of the map of pairs for each pair that can be frequent, and bits at most: 32 MB.
BITS, MOST_BITS = 16, 28
#: Pointers from which a part is parted further instead of sorted.
PART = 1 << 14
#: Ends a piece; no word holds it.
END = b"."
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", END * 10)


class Hashes(WordHashes):
    """Word to 64-bit hash under a seed, 0 for the end of a piece."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        self[word] = h = 0 if word == END else xxhash.xxh64_intdigest(word, self.seed) or 1
        return h


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of whole texts, A-Z lower-cased, with ``END`` between pieces and texts."""
    return END.join(texts).lower().translate(_ENDS).replace(END, b" " + END + b" ").split()


def _by_language(docs: DataFrame, f, schema: str) -> DataFrame:
    """Rows that ``f(language, texts)`` yields for each language's texts of a task, some megabytes at a time."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, held, size = f(), {}, Counter()
        out = lambda lang: pa.RecordBatch.from_pydict(dict(zip(names, step(lang, held.pop(lang)))))
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] += len(text)
                if size[lang] >= STEP:
                    yield out(lang)
                    size[lang] = 0
            trim()
        for lang in list(held):
            yield out(lang)
        trim()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """``lang, word, h, n`` of all words."""

    def step():
        hashes = Hashes(seed)

        def one(lang, texts):
            found = Counter(tokens(texts))
            found.pop(END, None)
            h = np.fromiter((hashes[w] for w in found), np.uint64, len(found)).view(np.int64)
            return pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(h), pa.array(list(found.values()), pa.int64())

        return one

    return _by_language(docs, step, "lang string, word binary, h long, n long").groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def _pairs(h: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all neighbouring words, by language, and whether both are in one piece."""
    salt = np.uint64(xxhash.xxh64_intdigest(lang))
    return mixed(shingles(h, 2) ^ salt), (h[:-1] != 0) & (h[1:] != 0)


def leading_pairs(docs: DataFrame, seed: int, buckets: int, least: int, hot: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bit map of the hashes of pairs with ``least`` occurrences, sorted hashes of those with over ``hot``)."""
    k, per = buckets.bit_length() - 1, bits - (buckets.bit_length() - 1)

    def step():
        hashes = Hashes(seed)

        def one(lang, texts):
            h = hashes.of(tokens(texts))
            found, n = np.empty(0, np.uint64), np.empty(0, np.int64)
            if len(h) > 1:
                pair, ok = _pairs(h, lang)
                found, n = np.unique(pair[ok], return_counts=True)
            at = (found >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(found), np.int64)
            cuts = np.searchsorted(at, np.arange(buckets + 1))
            full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
            part = lambda x: pa.array([x[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary())
            return pa.array(full, pa.int32()), part(found), part(n.astype(np.uint32))

        return one

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h, n = np.frombuffer(b"".join(pdf.h), np.uint64), np.frombuffer(b"".join(pdf.n), np.uint32)
        order = np.argsort(h)
        h, n = h[order], n[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        h, n = h[starts], np.add.reduceat(n, starts)
        seen = np.zeros(1 << per, bool)
        seen[((h[n >= least] >> np.uint64(64 - bits)) & np.uint64((1 << per) - 1)).astype(np.int64)] = True
        return pd.DataFrame([(key[0], np.packbits(seen, bitorder="little").tobytes(), h[n > hot].tobytes())], columns=["bucket", "seen", "hot"])

    dealt = _by_language(docs, step, "bucket int, h binary, n binary")
    rows = dealt.groupBy("bucket").applyInPandas(settle, "bucket int, seen binary, hot binary").collect()  # the map's bounded size, in segments
    seen = np.zeros((buckets, (1 << per) // 8), np.uint8)
    for r in rows:
        seen[r.bucket] = np.frombuffer(r.seen, np.uint8)
    return seen.reshape(-1), np.sort(np.frombuffer(b"".join(bytes(r.hot) for r in rows), np.uint64))


def merge_equal(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``keys`` with their summed weights."""
    if not len(n):
        return keys, n
    order = np.lexsort(keys[::-1])
    keys, n = keys[:, order], n[order]
    starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    return keys[:, starts], np.add.reduceat(n, starts)


def suffixes(docs: DataFrame, seed: int, buckets: int, depth: int, pairs) -> DataFrame:
    """``lang, bucket, hot, w, n``: suffixes dealt by their leading pair, those of hot pairs by all their words."""

    def step():
        hashes = Hashes(seed)
        seen, hot = pairs.value
        shift = np.uint64(64 - (len(seen) * 8).bit_length() + 1)

        def one(lang, texts):
            h = hashes.of(tokens(texts))
            keys, n, pair = np.zeros((depth, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
            if len(h) > 1:
                pair, ok = _pairs(h, lang)
                bit = pair >> shift
                ok &= (seen[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at = np.flatnonzero(ok)
                keys, go = np.zeros((depth, len(at)), np.uint64), np.ones(len(at), bool)
                keys[0], ok = h[at], np.r_[ok, np.zeros(depth, bool)]
                h = np.r_[h, np.zeros(depth, np.uint64)]
                for d in range(1, depth):
                    go &= ok[at + d - 1]
                    keys[d] = np.where(go, h[at + d], 0)
                keys, n = merge_equal(keys, np.ones(len(at), np.int64))
                pair = mixed(mixed(keys[0] + np.uint64(2 * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(3) + keys[1])  # as shingles() has it
                pair = mixed(pair ^ np.uint64(xxhash.xxh64_intdigest(lang)))
            near = np.searchsorted(hot, pair)
            is_hot = near < len(hot)
            is_hot[is_hot] = hot[near[is_hot]] == pair[is_hot]
            route = pair.copy()
            for key in keys[2:]:
                route[is_hot] = mixed(route[is_hot] * np.uint64(3) + key[is_hot])
            to = (mixed(route) % np.uint64(buckets)).astype(np.int64) * 2 + is_hot
            order = np.argsort(to, kind="stable")
            keys, n, to = keys[:, order], n[order], to[order]
            full, starts = np.unique(to, return_index=True)
            ends = np.r_[starts[1:], len(to)]
            block = lambda x: pa.array([np.ascontiguousarray(x[..., s:e]).tobytes() for s, e in zip(starts, ends)], pa.binary())
            return pa.array([lang] * len(full), pa.string()), pa.array(full // 2, pa.int32()), pa.array(full % 2 == 1), block(keys), block(n.astype(np.uint32))

        return one

    return _by_language(docs, step, "lang string, bucket int, hot boolean, w binary, n binary")


def frequent(keys: np.ndarray, n: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort: (a row of each, length, weight) of the phrases with weight ``least[length - 1]`` or more.

    ``keys``: a row of hashes for each depth, 0 behind the last word of a suffix; phrases have two words or more.
    Deeper thresholds are not below shallower ones.
    """
    rows, lengths, counts = [], [], []

    def put(row, length: int, count) -> None:
        rows.append(np.atleast_1d(row))
        counts.append(np.atleast_1d(count))
        lengths.append(np.full(len(rows[-1]), length))

    todo = [(np.arange(len(n)), 0)]
    while todo:
        at, d = todo.pop()
        if n[at].sum() < least[d]:
            continue  # no phrase inside can be frequent
        if len(at) <= PART:
            at = at[np.lexsort(keys[d:, at][::-1])]
            new = np.zeros(len(at), bool)
            new[:1] = True
            for j in range(d, len(keys)):
                key = keys[j, at]
                new[1:] |= key[1:] != key[:-1]
                starts = np.flatnonzero(new)
                sums = np.add.reduceat(n[at], starts)
                good = (key[starts] != 0) & (sums >= least[j])
                if j:
                    put(at[starts[good]], j + 1, sums[good])
            continue
        key = keys[d, at]
        sample = key[:: len(at) // 999 + 1]
        pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
        todo += [(at[key < pivot], d), (at[key > pivot], d)]
        equal = at[key == pivot]
        if pivot and (count := n[equal].sum()) >= least[d]:
            if d:
                put(equal[0], d + 1, count)
            if d + 1 < len(keys):
                todo.append((equal, d + 1))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *lengths]), np.concatenate([none, *counts])


def phrases(dealt: DataFrame, depth: int, least: int) -> DataFrame:
    """``lang, ws, n``: all phrases of 2 to ``depth`` words that occur ``least`` times, as arrays of hashes."""

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(w, np.uint64).reshape(depth, -1) for w in pdf.w], axis=1)
        n = np.frombuffer(b"".join(pdf.n), np.uint32).astype(np.int64)
        keys, n = merge_equal(keys, n)
        # Of a hot pair's phrases only those of full depth are whole here.
        row, length, count = frequent(keys, n, [1] * (depth - 1) + [least] if key[2] else [least] * depth)
        ws = keys.view(np.int64).T[row]
        return pd.DataFrame({"lang": key[0], "ws": pd.Series([w[:k] for w, k in zip(ws, length)], dtype=object), "n": count})

    parts = dealt.groupBy("lang", "bucket", "hot").applyInPandas(settle, "lang string, ws array<long>, n long")
    return parts.groupBy("lang", "ws").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def collocations(docs: DataFrame, depth: int = 4, least: int = 30, top: int = 2000, share: int = 80) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, these at blanks and tabs into
    words.  A phrase of 2 to ``depth`` words with ``a >= least`` occurrences inside pieces is cut where
    ``score = floor(2000000 * a / (l + r))`` is least, ties at the first such place; ``l`` and ``r`` are the counts of
    its parts, ``n`` that of all the language's words.  Phrases inside a longer one with at least ``share`` percent
    of their occurrences go.  ``rank`` is by score, ``a`` (both falling), then phrase in byte order, up to ``top``.

    Null text: empty; null language: ``und``.  Texts of any length are read whole.  Rows count as often as they are
    there, identifiers and other columns are not read.  Languages without a phrase, and empty tables, give no rows.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    seed = 0
    while True:
        words = scratch.stored(word_counts(docs, seed))
        if not words.select("word", "h").distinct().groupBy("h").count().filter("count > 1").limit(1).count():
            break
        seed += 1
    positions = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = 1 << max(0, (max(positions // BUCKET, min(partitions(spark), positions // 10_000)) - 1).bit_length())
    bits = max(buckets.bit_length() + 2, min(MOST_BITS, (BITS * (positions // least + 1)).bit_length()))
    pairs = spark.sparkContext.broadcast(leading_pairs(docs, seed, buckets, least, max(least, positions // (4 * buckets)), bits))
    found = scratch.stored(phrases(suffixes(docs, seed, buckets, depth, pairs), depth, least))
    pairs.destroy()

    known = found.unionByName(words.filter(F.col("n") >= least).select("lang", F.array("h").alias("ws"), "n"))
    size = F.size("ws")
    cuts = found.select("lang", "ws", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "ws", "a", "k", F.slice("ws", F.lit(1), F.col("k")).alias("lw"), F.slice("ws", F.col("k") + 1, size - F.col("k")).alias("rw"))
    for side in ("l", "r"):
        cuts = cuts.join(known.select("lang", F.col("ws").alias(f"{side}w"), F.col("n").alias(side)), ["lang", f"{side}w"])
    score = F.expr("(2000000BD * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)").alias("score")
    scored = cuts.select("lang", "ws", "a", "k", "l", "r", score).groupBy("lang", "ws", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("ws", i, m))))
    inside = found.filter(size > 2).select("lang", F.explode(spans).alias("ws"), "n").groupBy("lang", "ws").agg(F.max("n").alias("longer"))
    swallowed = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {int(share)}")
    rest = scored.join(inside, ["lang", "ws"], "left").filter(~F.coalesce(swallowed, F.lit(False))).select("lang", "ws", "a", "best.*")
    by_score = [F.desc("score"), F.desc("a")]
    # Ties at the last rank stay until their words are known.  A language's best are among the best of each share of its phrases.
    few = rest.withColumn("_share", F.pmod(F.xxhash64("ws"), F.lit(partitions(spark))))
    for group in (["lang", "_share"], ["lang"]):
        few = few.withColumn("_r", F.rank().over(Window.partitionBy(*group).orderBy(*by_score))).filter(F.col("_r") <= top)
    names = words.filter(F.col("n") >= least).select("h", "word").distinct()
    spelled = few.select("*", F.posexplode("ws").alias("_at", "h")).join(names, "h").groupBy("lang", "ws", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", F.col("word").cast("string").alias("w")))), lambda x: x["w"]), " ").alias("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score, "phrase"))).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    whole = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    out = scratch.keep(ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *whole))
    scratch.clear()
    return out


ORACLE = r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, doc_id,
             unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    sp AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
    f AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, w[i:i + k - 1] AS p FROM sp, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)) GROUP BY ALL),
    c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 30),
    cut AS (SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
            FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM c) c
            JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:]),
    best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    inside AS (SELECT lang, p[i:i + m - 1] AS p, max(a) AS longer FROM (
                 SELECT lang, p, a, m, unnest(range(1, len(p) - m + 2)) AS i FROM (SELECT lang, p, a, unnest(range(2, len(p))) AS m FROM c)) GROUP BY ALL),
    kept AS (SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.p = b.p
             WHERE s.p IS NULL OR 100 * s.longer < 80 * b.a),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
