"""Readers and writers of article files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARTICLE = "portal string, title string, chamada string, text string, url string, date_publication string, date_extraction string, page_number int"


def scan_json(spark: SparkSession, path: str, schema: str = ARTICLE, files: str = "*.json") -> DataFrame:
    """Articles of all ``files`` below a folder or object prefix, each an array of records or one record.

    A broken file gives a row that holds it in ``_bad``.
    """
    return (
        spark.read.schema(f"{schema}, _bad string").option("multiLine", True).option("pathGlobFilter", files)
        .option("recursiveFileLookup", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    )


def load(spark: SparkSession, request: dict, pages: DataFrame | None = None, schema: str = ARTICLE) -> DataFrame:
    """Rows of a request: files of ``folder_path``, else landed articles, all or of one ``date``; ``entity_type`` stamped."""
    rows = scan_json(spark, request["folder_path"], schema).filter("_bad is null").drop("_bad") if request.get("folder_path") else pages
    if not request.get("folder_path") and not request.get("collect_all") and request.get("date"):
        rows = rows.filter(F.col("date_publication") == F.lit(request["date"]).cast("date"))
    return rows.withColumn("entity_type", F.lit(request.get("entity_type")))


def save_by_portal(articles: DataFrame, path: str, portal: str = "portal") -> None:
    """JSON files in a folder for each portal; the root is the consolidated view."""
    articles.write.mode("overwrite").partitionBy(portal).json(path)


def export_report(report: DataFrame, path: str) -> None:
    """A report as lines of JSON."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.mode("overwrite").text(path)
