"""Trigram similarity of texts, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between words.
SEPARATORS = r"[^\p{L}\p{N}]+"


def trigrams(s: Column) -> Column:
    """Distinct three-letter parts of a text's words, each padded by two blanks and one."""
    words = F.filter(F.split(F.lower(F.coalesce(s, F.lit(""))), SEPARATORS), lambda w: w != "")
    return F.array_distinct(
        F.flatten(
            F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
        )
    )


def similarity_of(a: Column, b: Column) -> Column:
    """Shared over all parts of two trigram arrays, single precision; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every > 0, both / every).otherwise(0.0).cast("float")


def similarity(a: Column, b: Column) -> Column:
    return similarity_of(trigrams(a), trigrams(b))
