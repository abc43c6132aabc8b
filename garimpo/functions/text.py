"""Text cleaning, names and identifiers as column expressions."""

from __future__ import annotations

import unicodedata
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ASCII punctuation without the backslash.
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\]^_`{|}~]"""

_ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"

NULL_TOKENS = ("nan", "null", "none", "")


def missing(s: Column) -> Column:
    """True for NULL and the texts that stand for it."""
    return s.isNull() | F.lower(s).isin(*NULL_TOKENS)


def first_filled(*cols: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.when(c != "", c) for c in cols])


def clean_html(s: Column) -> Column:
    """Text without tags: entities decoded, three or more line ends made two, trimmed."""
    out = unescape(F.regexp_replace(s, "<[^>]+>", ""))
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"^[\s\x{00a0}]+|[\s\x{00a0}]+$", "")


#: A character reference with its semicolon.
REFERENCE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def unescape(s: Column) -> Column:
    """Character references decoded once: decimal, hexadecimal and the named ones of HTML 4, each with its semicolon."""
    name = lambda part: F.regexp_extract(part, f"^{REFERENCE}", 1)
    char = lambda code: F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def decoded(part: Column) -> Column:
        n = name(part)
        digits = F.when(n.rlike("^#[xX]"), F.conv(F.substring(n, 3, 10), 16, 10)).when(n.startswith("#"), F.substring(n, 2, 10)).cast("long")
        usable = digits.between(1, 0xD7FF) | digits.between(0xE000, 0x10FFFF)
        out = F.when(usable, char(digits)).otherwise(F.when(n == "apos", "'").otherwise(F.element_at(named, n)))
        return F.when(out.isNotNull(), F.concat(out, F.substr(part, F.length(n) + 3))).otherwise(part)

    named = F.create_map(*[F.lit(x) for k, v in sorted(name2codepoint.items()) for x in (k, chr(v))])
    return F.when(F.contains(s, F.lit("&")) & s.rlike(REFERENCE), F.array_join(F.transform(F.split(s, "(?=&)"), decoded), "")).otherwise(s)


def clean_text(s: Column) -> Column:
    """Lower case without tags, punctuation and repeated spaces; a backslash stays.

    Texts between tags are joined by a space, as are those around comments, scripts and
    styles, which go whole; character references are decoded.
    """
    seen = F.regexp_replace(s, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    flat = unescape(F.regexp_replace(seen, r"</?[A-Za-z][^>]*>|<[!?][^>]*>", " "))
    bare = F.regexp_replace(F.lower(flat), PUNCTUATION, "")
    return F.trim(F.regexp_replace(bare, r"(?U)[\s\x1c-\x1f]+", " "))


def fold(s: Column) -> Column:
    """Lower case with Latin accents taken off; other characters stay."""
    return F.translate(F.lower(s), _ACCENTED, _PLAIN)


def fold_exact(s: Column) -> Column:
    """NFKD without anything outside ASCII, lower case; over Arrow batches."""

    def folded(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower())

    return F.pandas_udf(folded, "string")(s)


def portal_of_url(url: Column) -> Column:
    """First label of a URL's host, a leading ``www.`` set aside; empty without a scheme."""
    host = F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))
    return F.substring_index(F.regexp_replace(host, r"^www\.", ""), ".", 1)


def article_id(url: Column, index: Column) -> Column:
    """Last part of a URL's path, else ``article_{index}``."""
    last = F.element_at(F.split(url, "/"), -1)
    return F.coalesce(F.when(last != "", last), F.concat(F.lit("article_"), index.cast("string")))


def normalize_edital(s: Column) -> Column:
    """``005/2023`` to ``5/2023``: leading zeros of the number before a single slash go."""
    t = F.trim(s)
    parts = F.split(t, "/")
    number = F.regexp_replace(F.get(parts, F.lit(0)), "^0+", "")
    return F.when(F.size(parts) == 2, F.concat(F.when(number == "", "0").otherwise(number), F.lit("/"), F.get(parts, F.lit(1)))).otherwise(t)


def summary(chamada: Column, text: Column, n: int = 200) -> Column:
    """The subtitle, or the first characters of the text."""
    return first_filled(chamada, F.substring(text, 1, n))


def truncate_words(s: Column, n: int = 2000) -> Column:
    """The first n words joined by single spaces where there are more; else the text as it is."""
    words = F.filter(F.split(s, r"\s+"), lambda w: w != "")
    return F.when(F.size(words) > n, F.array_join(F.slice(words, 1, n), " ")).otherwise(s)


def nested(json: Column, path: str) -> Column:
    """Value at a dotted path of a JSON document; NULL where a level is missing or no object."""
    return F.get_json_object(json, "$." + path)
