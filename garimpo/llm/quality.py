"""Quality selection by importance resampling.

Two generative models over hashed unigrams and bigrams, one of the target text (documents
labelled good) and one of all raw text, give every document the logarithm of their
likelihood ratio.  Adding Gumbel noise and keeping the k largest samples documents without
replacement in proportion to that ratio.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import stored
from garimpo.llm.words import WordHashes, mixed

BUCKETS = 1 << 14
#: Labelled rows up to which their identifiers are broadcast; beyond, texts are shuffled to them.
FEW_LABELS = 2_000_000
_TOKENS = re.compile(r"\w+|[^\w\s]+")


def grams(text: str | None, cache: WordHashes) -> np.ndarray:
    """Buckets of a text's unigrams and bigrams of words and punctuation runs."""
    h = cache.of(_TOKENS.findall((text or "").lower()))
    pairs = mixed(h[:-1] * np.uint64(3) + h[1:])
    return (np.concatenate([h, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``bucket, raw, target``: counts over all texts and over those with ``is_target``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, raw, target = WordHashes(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            for text, good in zip(pdf["text"], pdf["is_target"]):
                c = np.bincount(grams(text, cache), minlength=BUCKETS)
                raw += c
                if good:
                    target += c
        yield pd.DataFrame({"bucket": np.arange(BUCKETS), "raw": raw, "target": target})

    parts = docs.select("text", "is_target").mapInPandas(run, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``doc_id, n_grams, log_weight`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS doubles, whatever the input

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, r = WordHashes(), sent.value
        for pdf in batches:
            buckets = [grams(t, cache) for t in pdf["text"]]
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "n_grams": [len(b) for b in buckets], "log_weight": [float(r[b].sum()) for b in buckets]}
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        run, "doc_id long, n_grams long, log_weight double"
    )


def kth_largest(rows: DataFrame, key: str, k: int, enough: int = 10_000, bins: int = 4096) -> tuple[float, float, int]:
    """(low, high, m): rows with key over ``high`` and the m largest with low <= key <= high are the k largest.

    Histograms between narrowing ends; the driver sees ``bins`` counts at a time.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    left = k
    for _ in range(12):
        if not high > low:
            break
        part = rows.filter(F.col(key).between(low, high))
        width = (high - low) / bins
        b = F.least(F.lit(bins - 1), F.floor((F.col(key) - F.lit(low)) / F.lit(width)))
        hist = part.groupBy(b.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        for r in sorted(hist.collect(), key=lambda r: -r["b"]):
            if r["n"] >= left:
                low, high = r["lo"], r["hi"]
                break
            left -= r["n"]
        if r["n"] <= enough:
            break
    return low, high, left


def resample(docs: DataFrame, labels: DataFrame, keep: float | None = None, seed: int = 3) -> DataFrame:
    """One row per document: ``doc_id, n_grams, log_weight, gumbel_key, kept``.

    ``kept`` is true for the k documents of the largest key, k = ``keep`` times the rows;
    by default the share of good rows among the labelled ones.  Noise comes from a hash of
    the identifier, so reruns agree.  Null text has no grams and weight 0; rows that repeat
    an identifier share its noise and are told apart by their weight.  Labels with a
    null quality or for no document have no effect; without labels all are kept.
    """
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("quality")
    )
    n_marks, share = marks.agg(F.count("*"), F.avg(F.col("quality"))).first()
    good = marks.filter("quality = 1").select(F.col("doc_id").alias("_good"))
    good = F.broadcast(good) if n_marks <= FEW_LABELS else good
    marked = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("_good"), "left")
    counts = gram_counts(marked.withColumn("is_target", F.col("_good").isNotNull())).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"]], target[counts["bucket"]] = counts["raw"], counts["target"]
    smooth = lambda c: np.log((c + 1.0) / (c.sum() + BUCKETS))
    scored = log_weights(docs, smooth(target) - smooth(raw))
    u = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    rows = stored(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u))))
    n = rows.count()
    share = keep if keep is not None else (share if share is not None else 1.0)
    k = int(n * share)
    if k <= 0 or k >= n:
        return rows.withColumn("kept", F.lit(k >= n))
    low, high, left = kth_largest(rows, "gumbel_key", k)
    order = Window.orderBy(F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_last(), "log_weight")
    edge = rows.filter(F.col("gumbel_key").between(low, high)).withColumn("_r", F.row_number().over(order))
    over = rows.filter(F.col("gumbel_key") > high).withColumn("kept", F.lit(True))
    under = rows.filter(F.col("gumbel_key") < low).withColumn("kept", F.lit(False))
    return over.unionByName(edge.withColumn("kept", F.col("_r") <= left).drop("_r")).unionByName(under)
