"""Answers of language models: JSON in code fences to typed lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.text import normalize_edital

KEYS = ("municipio", "modalidade", "edital", "objeto")


def unfenced(answer: Column) -> Column:
    """The answer without code fences around it."""
    return F.trim(F.regexp_replace(answer, r"```(?:json)?", ""))


def _listed(json: Column, key: str) -> Column:
    """The value of a key as a list of texts: a text or number is a list of one, anything else none."""
    value = F.get_json_object(json, f"$.{key}")
    form = F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), f"$.{key}", "variant"))
    many = F.from_json(value, "array<string>")
    return (
        F.when(form.startswith("ARRAY"), F.filter(many, lambda x: x.isNotNull()))
        .when(form.rlike("^(STRING|BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"), F.array(value))
        .otherwise(F.array().cast("array<string>"))
    )


def parse_answer(answer: Column) -> dict[str, Column]:
    """The four lists of an answer: trimmed, without outer quotes, empties and repeats, first ones first."""
    json = unfenced(answer)
    out = {}
    for key in KEYS:
        items = F.transform(_listed(json, key), lambda x: F.trim(F.regexp_replace(F.trim(x), "^[\"']+|[\"']+$", "")))
        if key == "edital":
            items = F.transform(items, normalize_edital)
        out[key] = F.coalesce(F.array_distinct(F.filter(items, lambda x: x != "")), F.array().cast("array<string>"))
    return out


def chosen_id(answer: Column, candidates: Column) -> Column:
    """The identifier that an answer names, where it is one of the candidates."""
    named = F.coalesce(F.get_json_object(unfenced(answer), "$.id_processo_licitatorio"), F.regexp_extract(unfenced(answer), "^[0-9]+$", 0))
    number = named.try_cast("bigint")
    return F.when(F.array_contains(candidates, number), number)
