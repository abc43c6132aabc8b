"""Exact duplicates by sorting the content.

The normalised text itself is the sort key.  ``repartitionByRange`` samples the starts of
the texts for splitters and deals every text to one range; inside a range Spark's external
sort puts equal texts next to each other; the ordered window then compares each text in
full with its neighbour and keeps the smallest identifier of every run.

A text with very many copies would fill one range.  A first pass counts copies by a
64-bit hash (combined on the map side); texts with more rows or bytes than a quarter of a
mean range are *hot*.  At most eight times the number of ranges can be, so their list is
bounded and broadcast.  A hot text gets a second sort key, a salt from the identifier,
which lets the splitters fall inside its run; the heads of its salted runs, at most
``salts`` for each hot text, are merged by their full text and sent back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import SPACE, columns, fresh, partitions, stored, without

#: Most runs that one hot text is split into.
MAX_SALTS = 4096
#: Characters of a text that the sampled splitters hold.
SPLITTER_CHARS = 64


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of ASCII white space became one space.
    Null text: empty.  Null identifiers sort last, so a group keeps a known identifier if
    it has one; ``kept`` is true for exactly one row of every group, also where several
    rows repeat the smallest identifier.  Other columns of the input are not read.
    An empty table gives an empty result.
    """
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    sizes = rows.select(F.xxhash64("norm").alias("h"), F.octet_length("norm").cast("long").alias("b"))
    whole = sizes.agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    row_limit, byte_limit = max(64, whole[0] // (4 * n)), max(1 << 16, whole[1] // (4 * n))
    hot = (
        sizes.groupBy("h")
        .agg(F.count("*").alias("rows"), F.sum("b").alias("bytes"))
        .filter(f"rows > 1 and (rows > {row_limit} or bytes > {byte_limit})")
        .select(
            "h",
            F.least(
                F.lit(MAX_SALTS),
                F.col("rows"),
                F.greatest(F.ceil(F.col("rows") / row_limit), F.ceil(F.col("bytes") / byte_limit)),
            ).cast("long").alias("salts"),
        )
    )
    salted = (
        rows.join(F.broadcast(hot), F.xxhash64("norm") == hot["h"], "left")
        .select(
            "doc_id",
            "norm",
            F.coalesce("salts", F.lit(1)).alias("salts"),
            F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("salts")))
            .otherwise(F.lit(0)).alias("salt"),
        )
        # The splitters need the start of the bytes and, where many texts share it, a hash.
        .withColumns({"start": F.substring("norm", 1, SPLITTER_CHARS), "h": F.xxhash64("norm")})
        .repartitionByRange(n, "start", "h", "salt")
    )
    run = Window.partitionBy("start", "h", "norm", "salt").orderBy(F.col("doc_id").asc_nulls_last())
    runs = salted.select(
        "doc_id",
        "salts",
        F.sha2("norm", 256).alias("text_sha256"),
        F.first("doc_id").over(run).alias("head"),
        F.row_number().over(run).alias("place"),
        F.count("*").over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
        F.when(F.col("salts") > 1, F.col("norm")).alias("hot_norm"),
        "salt",
    )
    # Heads of the salted runs: bounded by the hot texts times their salts.
    merged = (
        runs.filter("salts > 1 and place = 1")
        .groupBy("hot_norm", "text_sha256")
        .agg(
            F.min(F.struct(F.col("head").isNull().alias("none"), "head", "salt")).alias("least"),
            F.sum("n").alias("all_n"),
        )
        .select(F.col("text_sha256").alias("hot_sha"), "least", "all_n")
    )
    found = runs.drop("hot_norm").join(
        F.broadcast(merged), (F.col("salts") > 1) & (F.col("text_sha256") == F.col("hot_sha")), "left"
    )
    cold = F.col("least").isNull()
    return found.select(
        "doc_id",
        F.when(cold, F.col("head")).otherwise(F.col("least.head")).alias("keep_id"),
        F.when(cold, F.col("n")).otherwise(F.col("all_n")).cast("long").alias("group_size"),
        ((F.col("place") == 1) & (cold | (F.col("salt") == F.col("least.salt")))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The input's rows and columns without later copies of a text.

    A row stays when its identifier is the smallest of its text's group; of rows that
    repeat both, one stays.  Other columns may have any names and go with their rows.
    """
    groups = stored(exact_groups(docs, text, doc_id))
    gone = groups.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    sha = F.sha2(normalised(F.col(text)), 256)
    once = without(docs, gone, {"doc_id": F.col(doc_id), "text_sha256": sha})
    # Only rows that repeat identifier and text are told apart row by row.
    again = groups.filter(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "text_sha256").distinct()
    if not again.limit(1).count():
        return once
    text_sha, place = fresh(docs, "_sha", "_place")
    same = Window.partitionBy(doc_id, text_sha).orderBy(F.lit(1))
    return once.withColumn(text_sha, sha).withColumn(place, F.row_number().over(same)).filter(F.col(place) == 1).select(*columns(docs))
