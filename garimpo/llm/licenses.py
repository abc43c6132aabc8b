"""License notices in texts: MinHash bands over overlapping windows, exact containment after.

Texts and templates are sets of two-word shingles.  Templates are cut into segments of at
most five shingles; texts into windows of eight shingles, four apart, so a segment that
stands in a text lies whole in one window and makes up a quarter of it at least.  Each
window gets ``BANDS`` MinHash values, every one a band of its own: the chance that a window
with Jaccard similarity 1/4 shares no band with the segment is (3/4)**24, about 0.001, and
(5/9)**24, under 10**-6, for four shingles of five.  Texts without any word that a match needs
are not cut up; of the others every window is hashed and the bands alone retrieve.  What is
retrieved is verified by the exact share of the template's shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BANDS = 24
WINDOW, STRIDE = 8, 4
SEGMENT = 5
CONTAINED = 0.8

# Fixed notices, lower-cased words.
TEMPLATES = {
    "Apache-2.0": "licensed under the apache license version 2 0",
    "MIT": "released under the mit license",
    "MIT-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "this work is licensed under the gnu general public license version 3",
    "GPL-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "CC-BY-NC-4.0": "licensed under cc by nc 4 0",
    "CC-BY-SA-4.0": "licensed under cc by sa 4 0",
    "ISC-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "Apache-text": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "Unlicense": "this is free and unencumbered software released into the public domain",
    "MIT-grant": "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "LGPL-text": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    "AGPL-text": "under the terms of the gnu affero general public license as published by the free software foundation",
    "BSD-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "All-rights-reserved": "all rights reserved",
}


def template_shingles(text: str) -> list[str]:
    w = text.split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def anchors(templates: dict[str, str], contained: float) -> list[str]:
    """Words of which every text that holds enough of a template has one at least.

    Longest words first, until the shingles without any of them are fewer than a match needs.
    """
    out: set[str] = set()
    for t in templates.values():
        shingles = template_shingles(t)
        for word in sorted(set(t.split()), key=lambda w: (-len(w), w)):
            if len([s for s in shingles if not out & set(s.split())]) < contained * len(shingles):
                break
            out.add(word)
    return sorted(out)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^a-z0-9]+"), lambda x: x != "")


def _hashes(shingles: Column) -> Column:
    return F.transform(shingles, lambda s: F.xxhash64(s))


def _signature(hashes: Column) -> Column:
    """The smallest of the scrambled hashes for each band, with the band's number."""
    return F.array(*[_band(hashes, b) for b in range(BANDS)])


def _band(hashes: Column, b: int) -> Column:
    return F.struct(F.lit(b).alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(b)))).alias("low"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """One row per (document, template) found: ``doc_id, license, n_shingles, n_found``.

    Found means that at least ``contained`` of the template's distinct two-word shingles
    stand in the text, words being runs of a-z and 0-9 after lower-casing.  Null, empty
    and one-word texts hold nothing.  Rows that repeat an identifier are reported once for
    each template, with the largest count; an empty table gives no rows.
    """
    spark = docs.sparkSession
    table = [(name, s) for name, t in templates.items() for s in template_shingles(t)]
    whole = spark.createDataFrame([(n, template_shingles(t)) for n, t in templates.items()], "license string, shingles array<string>")
    parts = spark.createDataFrame(
        [(n, template_shingles(t)[i : i + SEGMENT]) for n, t in templates.items() for i in range(0, len(template_shingles(t)), SEGMENT)],
        "license string, segment array<string>",
    )
    bands = parts.select("license", F.explode(_signature(_hashes(F.col("segment")))).alias("s")).select(
        "license", F.col("s.band").alias("t_band"), F.col("s.low").alias("t_low")
    ).distinct()
    known = sorted({s for _, s in table})
    w = F.col("w")
    # The one-element explode keeps the arrays from being computed again inside each lambda.
    holds = F.lower(F.col("text").cast("string")).rlike("|".join(anchors(templates, contained)))
    texts = docs.filter(holds).select("doc_id", F.explode(F.array(words(F.col("text")))).alias("w")).filter(F.size("w") > 1)
    pairs = texts.select("doc_id", F.explode(F.array(F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))).alias("sh"))
    held = F.array_distinct(F.array_intersect("sh", F.array(*map(F.lit, known)))).alias("held")
    last = F.greatest(F.lit(0), F.ceil((F.size("sh") - WINDOW) / STRIDE)).cast("int")
    each = pairs.select("doc_id", held, F.explode(F.array(_hashes(F.col("sh")))).alias("h"), F.sequence(F.lit(0), last).alias("at"))
    windows = each.select("doc_id", "held", "h", F.explode("at").alias("n")).select(
        "doc_id", "held", F.explode(_signature(F.array_distinct(F.slice("h", F.col("n") * STRIDE + 1, F.lit(WINDOW))))).alias("s")
    )
    retrieved = windows.join(
        F.broadcast(bands), (F.col("s.band") == F.col("t_band")) & (F.col("s.low") == F.col("t_low"))
    ).select("doc_id", "license", "held").distinct()
    return (
        retrieved.join(F.broadcast(whole), "license")
        .select("doc_id", "license", F.size("shingles").cast("long").alias("n_shingles"), F.size(F.array_intersect("held", "shingles")).cast("long").alias("n_found"))
        .filter(F.col("n_found") >= F.ceil(F.col("n_shingles") * contained - 1e-9))
        .groupBy("doc_id", "license", "n_shingles").agg(F.max("n_found").alias("n_found"))
    )


def oracle() -> str:
    rows = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES.items())
    pair = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
        WITH t AS (
          SELECT license, {pair} AS s FROM (SELECT license, string_split(words, ' ') AS w FROM (VALUES {rows}) v(license, words))),
        d AS (
          SELECT doc_id, {pair} AS s FROM (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents))
        SELECT * FROM (
          SELECT doc_id, license, len(t.s)::BIGINT AS n_shingles, len(list_intersect(d.s, t.s))::BIGINT AS n_found FROM d CROSS JOIN t)
        WHERE n_found >= ceil(n_shingles * {CONTAINED} - 1e-9)
    """
