"""Relational reads and writes: parameterised SQL, checked appends, reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_sql(spark: SparkSession, tables: dict[str, DataFrame], sql: str, **params) -> DataFrame:
    """SQL over DataFrames (``{name}``) with named parameters (``:name``), which are never spliced as text."""
    return spark.sql(sql, args=params, **tables)


def append_checked(rows: DataFrame, path: str, columns: dict[str, str], first: list[str] | None = None) -> None:
    """Append rows to a table of known columns; other columns go, an unknown table or a missing column is an error."""
    if not columns:
        raise ValueError("the table's columns are not known")
    keep = first or [c for c in rows.columns if c in columns]
    if absent := [c for c in keep if c not in rows.columns]:
        raise ValueError(f"columns missing from the rows: {absent}")
    rows.select(*[F.col(c).cast(columns[c]).alias(c) for c in keep]).write.mode("append").parquet(path)


def reference(spark: SparkSession, path: str, schema: str, year: int | None = None) -> DataFrame:
    """A reference table in CSV files; with a year, that partition of a yearly one."""
    rows = spark.read.option("header", True).schema(schema).csv(path)
    return rows.filter(F.col("year") == year) if year is not None else rows
