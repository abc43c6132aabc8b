"""Checks and conversions of loose values to relational types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Relational type names and the Spark type that holds them.
TYPES = {
    "smallint": "smallint", "integer": "int", "bigint": "bigint", "numeric": "decimal(38,10)", "real": "float",
    "double precision": "double", "boolean": "boolean", "text": "string", "character varying": "string", "character": "string",
    "date": "date", "timestamp without time zone": "timestamp_ntz", "timestamp with time zone": "timestamp", "time": "string",
    "bytea": "binary", "json": "string", "jsonb": "string", "uuid": "string", "ARRAY": "array<string>",
}
TRUE_WORDS = ("true", "t", "1", "yes", "y", "sim")
_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def coerce(value: Column, kind: str) -> Column:
    """A text as the given type, NULL where it can't be; a single value becomes a one-element array."""
    t = TYPES[kind]
    if t == "boolean":
        return F.when(value.isNotNull(), F.lower(value).isin(*TRUE_WORDS))
    if kind == "uuid":
        return F.when(value.rlike(_UUID), value)
    if kind in ("json", "jsonb"):
        return F.when(F.try_parse_json(value).isNotNull(), value)
    if kind == "ARRAY":
        return F.when(value.isNotNull(), F.array(value))
    if t in ("smallint", "int", "bigint"):
        return F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(value).try_cast(t))
    return value.try_cast(t)


def fits(value: Column, kind: str) -> Column:
    """Whether a non-null value can be the given type."""
    return value.isNotNull() & coerce(value, kind).isNotNull()


def is_exactly(rows: DataFrame, column: str, kind: str) -> Column:
    """Whether a value is there and its column already has the given type, without any conversion."""
    same = rows.schema[column].dataType.simpleString() == TYPES[kind]
    return F.col(column).isNotNull() & F.lit(same)
