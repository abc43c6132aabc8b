"""A schemaless document store's reads and writes as pure functions on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions.coerce import coerce

_OPS = {
    "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v, "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v,
    "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)), "$in": lambda c, v: c.isin(v), "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
}


def condition(query: dict) -> Column:
    """All equalities and operators of a query; None matches NULL."""
    parts = [F.lit(True)]
    for field, value in query.items():
        if isinstance(value, dict):
            parts += [_OPS[op](F.col(field), v) for op, v in value.items()]
        else:
            parts.append(F.col(field).eqNullSafe(F.lit(value)))
    return F.coalesce(reduce(Column.__and__, parts), F.lit(False))


def find(docs: DataFrame, query: dict, key: str, limit: int | None = None) -> DataFrame:
    """Matching documents, those of the smallest key where a limit is given."""
    out = docs.filter(condition(query))
    return out.orderBy(key).limit(limit) if limit else out


def update(docs: DataFrame, query: dict, change: dict, key: str | None = None) -> DataFrame:
    """The documents after ``$set`` / ``$inc`` of the matching ones; with ``key`` only the one of the smallest key."""
    ops = change if any(k.startswith("$") for k in change) else {"$set": change}
    hit = condition(query)
    if key:
        first = docs.filter(hit).agg(F.min(key).alias("_first"))
        docs = docs.join(F.broadcast(first), F.col(key) == F.col("_first"), "left")
        hit = F.col("_first").isNotNull()
    types = dict(docs.dtypes)
    new = {c: F.when(hit, F.lit(v).cast(types.get(c, "string"))).otherwise(F.col(c) if c in types else F.lit(None)) for c, v in ops.get("$set", {}).items()}
    new |= {c: F.when(hit, (F.coalesce(F.col(c), F.lit(0)) + v).cast(types[c])).otherwise(F.col(c)) for c, v in ops.get("$inc", {}).items()}
    return docs.withColumns(new).drop("_first")


def delete(docs: DataFrame, query: dict, key: str | None = None) -> DataFrame:
    """The documents without the matching ones; with ``key`` without the one of the smallest key."""
    if not key:
        return docs.filter(~condition(query))
    first = docs.filter(condition(query)).agg(F.min(key).alias("_first"))
    return docs.join(F.broadcast(first), F.col(key) == F.col("_first"), "left_anti")


def retained(pendencies: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Pendencies without those resolved more than ``days`` before ``as_of``."""
    old = F.col("resolved") & (F.col("resolved_at") < as_of - F.make_dt_interval(F.lit(days)))
    return pendencies.filter(~F.coalesce(old, F.lit(False)))


def typed_split(rows: DataFrame, key: str, values: str, schema: dict[str, str]) -> DataFrame:
    """``key, typed, dynamic, errors`` of rows that hold a map of texts.

    Known columns are converted (``typed``, as text of the converted value); what can't be
    is named in ``errors``; unknown columns stay in ``dynamic``.
    """
    m = F.col(values)
    known = list(schema)
    typed = F.map_filter(F.create_map(*[x for c in known for x in (F.lit(c), coerce(m[c], schema[c]).cast("string"))]), lambda k, v: v.isNotNull())
    bad = F.filter(F.array(*[F.when(m[c].isNotNull() & coerce(m[c], schema[c]).isNull(), F.lit(c)) for c in known]), lambda x: x.isNotNull())
    return rows.select(key, typed.alias("typed"), F.map_filter(m, lambda k, v: ~k.isin(known)).alias("dynamic"), bad.alias("errors"))


def newest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
