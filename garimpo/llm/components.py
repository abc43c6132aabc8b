"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import Scratch, stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (a, b): label is the component's smallest node.

    Every round takes the smallest label among a node and its neighbours (combined before
    the shuffle, so a node with very many links is no hot spot) and then follows labels to
    their own labels, which halves long chains, until no label moves.  Rounds are written to
    the shared folder; those done with are removed.
    """
    scratch = Scratch(links.sparkSession)
    both = scratch.stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    old = Scratch(links.sparkSession)
    labels = old.stored(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    while True:
        new = Scratch(links.sparkSession)
        of = labels.select(F.col("node").alias("n"), F.col("label").alias("l"))
        # A link also joins the labels of its ends, so components that met before move as one.
        hooks = (
            both.join(of, F.col("b") == F.col("n")).select("a", F.col("l").alias("near"))
            .join(labels, F.col("a") == F.col("node")).filter("near < label")
            .select(F.explode(F.array("node", "label")).alias("h_node"), "near")
            .groupBy("h_node").agg(F.min("near").alias("near"))
        )
        moved = new.stored(
            labels.join(hooks, F.col("node") == F.col("h_node"), "left").select(
                "node", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("near").isNotNull().alias("moved")
            )
        )
        if not moved.filter("moved").limit(1).count():
            break
        for _ in range(2):
            up = moved.select(F.col("node").alias("n"), F.col("label").alias("l"))
            moved = moved.join(up, F.col("label") == F.col("n"), "left").select("node", F.coalesce("l", "label").alias("label"))
        labels = new.stored(moved)
        old.clear()
        old = new
    labels = stored(labels.select("node", "label"))
    for used in (scratch, old, new):
        used.clear()
    return labels
