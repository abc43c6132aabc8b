"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue that offers its documents in a shuffled order, again and again up
to ``max_repeat`` times.  A copy's virtual finish time is the source's tokens up to and
with it, divided by the source's target.  All copies are range-sorted by that time and cut
where their tokens reach the budget.

Running sums are taken in two levels so that no source is one task: the shuffle order is
a hash, its leading bits name a slot, slot sums are accumulated for each source (one row
for each slot), and only rows of one slot are ordered together.  The cut is found the same
way: finish times fall into ranges, range sums are accumulated, and only the range that
holds the cut is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import FEW_ROWS, columns, fresh, n_words, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Rows of one source that are ordered together, about.
SLOT_ROWS = 2048
#: Ranges of finish time for each unit; one unit is the budget.
RANGES = 4096
#: Most sources whose targets are broadcast.
FEW_SOURCES = 10_000


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Tokens that each source is to give: ``source, source_size, target``.

    Sources by code point, null last, take the weights in turn and share all tokens; a
    target stops at ``max_repeat`` times its source's size and the excess goes to the
    others by weight.  Sorted by size over weight, the stopped sources come first, so one
    running sum finds them all.  One row for each source is handled here, never rows of
    documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("k", (F.row_number().over(by_name) - 1) % len(weights)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("k") + 1).cast("long")
    )
    cap = (F.lit(max_repeat) * F.col("source_size")).alias("cap")
    per = per.select("source", "source_size", "weight", cap)
    ratio = F.col("cap").cast("double") / F.col("weight").cast("double")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    per = (
        per.withColumn("left_tokens", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stopped", ratio < F.col("left_tokens").cast("double") / F.col("left_weight").cast("double"))
    )
    # The first source that is not stopped fixes the level for all after it.
    free = F.min(F.when(~F.col("stopped"), F.struct(ratio.alias("r"), F.col("source").isNull().alias("n"), "source", "left_tokens", "left_weight"))).over(every)
    per = per.withColumn("level", free)
    share = F.col("weight") * F.col("level.left_tokens").cast("double") / F.col("level.left_weight").cast("double")
    return per.select(
        "source",
        "source_size",
        F.when(F.col("stopped") | F.col("level").isNull(), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: str = "mix",
    slot_rows: int = SLOT_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, n_taken``.

    ``n_taken`` counts how often the mix takes the row, 0 to ``max_repeat``; ``taken`` is
    that times the row's words.  The shuffle is a hash of seed and identifier: reruns agree
    and partitioning has no part in it.  Null text has no words; rows without words have
    finish times of their own and take nothing from the budget.  Rows that repeat an
    identifier are further rows; null identifiers are one more value.  A null source is a
    source, the last one.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        n_words(F.col(text)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))).alias("h"),
    )
    rows = stored(rows)  # texts are read once; what follows handles sizes only
    goal = targets(rows, weights, max_repeat)
    n, budget, n_sources = rows.agg(
        F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.approx_count_distinct("source")
    ).first()
    # Sources are sent whole to every task only where they are few.
    few = F.broadcast if n_sources <= FEW_SOURCES else lambda df: df
    digits = 1
    while n / 16**digits > slot_rows:
        digits += 1
    rows = rows.withColumn("slot", F.substring("h", 1, digits))
    slots = (
        rows.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
        .withColumn("before", F.coalesce(F.sum("slot_size").over(Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col("source").alias("s_source"), F.col("slot").alias("s_slot"), "before")
    )
    inside = Window.partitionBy("source", "slot").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("upto", F.sum("size").over(inside))
        .join(slots, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slot") == F.col("s_slot")))
        .join(few(goal.withColumnRenamed("source", "g_source")), F.col("source").eqNullSafe(F.col("g_source")))
        .select("doc_id", "source", "size", "h", "source_size", "target", (F.col("before") + F.col("upto")).alias("upto"))
    )
    finish = (F.col("upto") + F.col("copy") * F.col("source_size")).cast("double") / F.col("target")
    copies = placed.filter("size > 0 and target > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))).alias("copy")
    ).withColumn("finish", finish).withColumn(
        "range", F.least(F.floor(F.col("finish") * RANGES), F.lit(16 * RANGES)).cast("long")
    )
    sums = copies.groupBy("range").agg(F.sum("size").alias("tokens")).withColumn(
        "upto_range", F.sum("tokens").over(Window.orderBy("range"))
    )
    cut = sums.filter(F.col("upto_range") > budget).agg(
        F.min(F.struct("range", (F.col("upto_range") - F.col("tokens")).alias("so_far"))).alias("c")
    ).first()["c"]
    if cut is None:  # all copies fit
        taken = placed.select("*", F.when(F.col("size") > 0, F.lit(max_repeat)).otherwise(0).alias("n_taken"))
    else:
        order = Window.partitionBy("range").orderBy("finish", F.col("source").asc_nulls_last(), "copy", "h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
        last = copies.filter(F.col("range") == cut["range"]).withColumn("sum", F.sum("size").over(order))
        # A source's order is one for every copy: its taken copies end at one place, kept for each source.
        edge = (
            last.filter(F.col("sum") + cut["so_far"] <= budget)
            .groupBy("source").agg(F.max(F.col("upto") + F.col("copy") * F.col("source_size")).alias("edge"))
            .select(F.col("source").alias("e_source"), "edge")
        )
        n_taken = F.lit(0)
        for k in range(max_repeat):
            at = F.col("upto") + F.lit(k) * F.col("source_size")
            inside_range = F.floor(at.cast("double") / F.col("target") * RANGES) < cut["range"]
            n_taken = n_taken + F.when((F.col("size") > 0) & (inside_range | (at <= F.col("edge"))), 1).otherwise(0)
        taken = placed.join(few(edge), F.col("source").eqNullSafe(F.col("e_source")), "left").withColumn("n_taken", F.when(F.col("target") > 0, n_taken).otherwise(0))
    return taken.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("n_taken")).cast("long").alias("taken"),
        F.col("n_taken").cast("int").alias("n_taken"),
        "source",
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as :func:`mix` takes it.

    Rows that repeat identifier, source and size are taken alike, as often as the first of them.
    Other columns may have any names.
    """
    found = mix(docs, **options).select("doc_id", "source", "size", "n_taken")
    of, source, size, times, copy = fresh(docs, "_id", "_source", "_size", "_times", "_copy")
    plan = stored(found.groupBy("doc_id", "source", "size").agg(F.max("n_taken").alias("n_taken")).filter("n_taken > 0"))
    plan = plan.select(F.col("doc_id").alias(of), F.col("source").alias(source), F.col("size").alias(size), F.col("n_taken").alias(times))
    plan = F.broadcast(plan) if plan.count() <= FEW_ROWS else plan
    on = [F.col("doc_id").eqNullSafe(F.col(of)), F.col("source").cast("string").eqNullSafe(F.col(source)), n_words(F.col("text")) == F.col(size)]
    return docs.join(plan, on).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*columns(docs))


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM rows GROUP BY source),
ranked AS (
  SELECT *, sum(source_size) OVER ()::BIGINT - coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS left_tokens,
         sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT AS left_weight,
         row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST) AS k
  FROM named
  WINDOW w AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (3 * source_size)::DOUBLE / weight::DOUBLE < left_tokens::DOUBLE / left_weight::DOUBLE AS stopped FROM ranked),
goal AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.stopped OR f.k IS NULL THEN (3 * l.source_size)::DOUBLE
              ELSE l.weight * f.left_tokens::DOUBLE / f.left_weight::DOUBLE END AS target
  FROM levels l LEFT JOIN (SELECT * FROM levels WHERE NOT stopped ORDER BY k LIMIT 1) f ON true),
placed AS (
  SELECT r.*, g.source_size, g.target,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM rows r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source),
copies AS (
  SELECT p.*, c.copy, (upto + c.copy * source_size)::DOUBLE / target AS finish
  FROM placed p, (SELECT unnest([0, 1, 2]) AS copy) c WHERE size > 0 AND target > 0),
mixed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, copy, h, doc_id ROWS UNBOUNDED PRECEDING) AS running
  FROM copies),
took AS (
  SELECT doc_id, h, source, size, count(*) AS n FROM mixed
  WHERE running <= (SELECT sum(size) FROM rows) GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, p.target, (p.size * coalesce(t.n, 0))::BIGINT AS taken
FROM placed p LEFT JOIN took t ON p.h = t.h AND p.doc_id IS NOT DISTINCT FROM t.doc_id AND p.size = t.size
  AND p.source IS NOT DISTINCT FROM t.source
"""
