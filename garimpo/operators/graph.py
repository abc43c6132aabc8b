"""A property graph of objects, attributes and edges as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_attributes(rows: DataFrame, key: str) -> DataFrame:
    """``key, attribute_name, attribute_value``: one row for each filled field; fields named ``id_*`` are left out."""
    cols = [c for c in rows.columns if c != key and not c.startswith("id_")]
    text = rows.select(key, *[F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot(key, cols, "attribute_name", "attribute_value").filter(F.coalesce("attribute_value", F.lit("")) != "")


def upsert_objects(old: DataFrame, new: DataFrame) -> DataFrame:
    """One object for each class (lower case, trimmed) and id, with its latest date."""
    name = lambda df: df.withColumn("class", F.lower(F.trim("class")))
    return name(old).unionByName(name(new)).groupBy("class", "id_object").agg(F.max("date_updated").alias("date_updated"))


def upsert_attributes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Attributes by object, source and name: a new value overwrites; the latest of several new ones wins.

    Rows without object, name or value are skipped; a missing source is ``unknown``.
    """
    src = F.lower(F.coalesce(F.when(F.col("id_source") != "", F.col("id_source")), F.lit("unknown")))
    clean = lambda df, is_new: df.withColumns({"id_source": src, "is_new": F.lit(is_new)})
    filled = new.filter(F.col("id_object").isNotNull() & (F.coalesce("attribute_name", F.lit("")) != "") & (F.coalesce("attribute_value", F.lit("")) != ""))
    every = clean(old, 0).unionByName(clean(filled, 1))
    w = Window.partitionBy("id_object", "id_source", "attribute_name").orderBy(F.desc("is_new"), F.desc("date_updated"), F.desc("attribute_value"))
    return every.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "is_new")


def attribute_edges(attributes: DataFrame) -> DataFrame:
    """Edges from objects to their attributes."""
    return attributes.select(F.col("id_object").alias("src"), F.concat_ws("/", "id_object", "id_source", "attribute_name").alias("dst"), F.lit("contains_attribute").alias("class"))


def object_attributes(attributes: DataFrame) -> DataFrame:
    """Each object's attributes as a map; of several sources the alphabetically last counts."""
    one = attributes.groupBy("id_object", "attribute_name").agg(F.max_by("attribute_value", "id_source").alias("v"))
    return one.groupBy("id_object").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attribute_name", "v")))).alias("attributes"))


def relate(rows: DataFrame, left: str, right: str, source: Column, existing: DataFrame, valid: str = "^#[0-9]+:[0-9]+$") -> DataFrame:
    """New ``related_to`` edges of two lists of ids: of equal length pairwise, else every pair; known edges and malformed ids are left out."""
    a, b = F.col(left), F.col(right)
    zipped = F.arrays_zip(a.alias("src"), b.alias("dst"))
    every = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.struct(x.alias("src"), y.alias("dst")))))
    pairs = rows.select(F.explode(F.when(F.size(a) == F.size(b), zipped).otherwise(every)).alias("e"), source.alias("id_source"))
    edges = pairs.select(F.trim("e.src").alias("src"), F.trim("e.dst").alias("dst"), F.lit("related_to").alias("class"), "id_source")
    good = edges.filter(F.col("src").rlike(valid) & F.col("dst").rlike(valid)).dropDuplicates(["src", "dst"])
    return good.join(existing.select("src", "dst"), ["src", "dst"], "left_anti")


def neighbours(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, direction, neighbour`` of the given vertices."""
    out = vertices.join(edges, F.col("id") == F.col("src")).select("id", F.lit("out").alias("direction"), F.col("dst").alias("neighbour"))
    into = vertices.join(edges, F.col("id") == F.col("dst")).select("id", F.lit("in").alias("direction"), F.col("src").alias("neighbour"))
    return out.unionByName(into)


def connected_count(vertices: DataFrame, edges: DataFrame, targets: DataFrame) -> DataFrame:
    """``id, n``: out-neighbours among the targets, zero where there are none."""
    hits = edges.join(targets.select(F.col("id").alias("_t")), F.col("dst") == F.col("_t"), "left_semi").groupBy("src").agg(F.count("*").alias("n"))
    return vertices.join(hits, F.col("id") == F.col("src"), "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


def find_vertices(vertices: DataFrame, **properties) -> DataFrame:
    """Vertices with the given properties."""
    for name, value in properties.items():
        vertices = vertices.filter(F.col(name) == value)
    return vertices


def delete_vertices(vertices: DataFrame, edges: DataFrame, gone: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Vertices and edges without the deleted vertices and what they were tied by."""
    ids = gone.select(F.col(key).alias("_gone")).distinct()
    left = vertices.join(ids, F.col(key) == F.col("_gone"), "left_anti")
    tied = edges.join(ids, F.col("src") == F.col("_gone"), "left_anti").join(ids, F.col("dst") == F.col("_gone"), "left_anti")
    return left, tied


def delete_edges(edges: DataFrame, gone: DataFrame) -> DataFrame:
    return edges.join(gone.select("src", "dst"), ["src", "dst"], "left_anti")
