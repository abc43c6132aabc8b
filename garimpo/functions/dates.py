"""Dates of news portals: parsers as column expressions; what can't be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese month abbreviations.
MONTHS = {"jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6, "jul": 7, "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12}

_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date from whole numbers, NULL where there is no such day."""
    digits = year.rlike("^[0-9]{4}$") & day.rlike("^[0-9]{1,2}$")
    text = F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(digits & month.isNotNull(), text.try_cast("date"))


def iso_or_portuguese(s: Column) -> Column:
    """``2025-07-24T23:38:34-03:00`` (the day of its own offset) or ``24 jul 2025 às 14h38``.

    A text with a capital T is taken for the first form alone, whatever else it says.
    """
    iso = F.when(s.rlike(_ISO), F.substring(s, 1, 10).try_cast("date"))
    part = F.trim(F.substring_index(s, " às ", 1))
    tokens = F.split(part, r"\s+")
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    portuguese = F.when(
        F.size(tokens) == 3, _date(F.get(tokens, F.lit(2)), F.element_at(months, F.lower(F.get(tokens, F.lit(1)))), F.get(tokens, F.lit(0)))
    )
    return F.when(F.contains(s, F.lit("T")), iso).otherwise(portuguese)


def _slashed(s: Column) -> Column:
    parts = F.split(s, "/")
    return F.when(s.rlike("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), _date(F.get(parts, F.lit(2)), F.get(parts, F.lit(1)).try_cast("int"), F.get(parts, F.lit(0))))


def day_month_year(s: Column) -> Column:
    """``24/07/2025 - 14:38``: what stands before the dash."""
    return _slashed(F.trim(F.substring_index(s, " - ", 1)))


def day_month_year_hour(s: Column) -> Column:
    """``24/07/2025 às 14h38 Atualizada em ...``; the time has to be there."""
    t = F.trim(F.substring_index(s, "Atualizada", 1))
    form = r"^([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\s+às\s+([01]?[0-9]|2[0-3])h[0-5]?[0-9]$"
    return F.when(t.rlike(form), _slashed(F.regexp_extract(t, form, 1)))


PARSERS = {"iso_or_portuguese": iso_or_portuguese, "dmy": day_month_year, "other_format": day_month_year_hour, "dmy_hour": day_month_year_hour}


def parse_by_name(s: Column, parser: Column) -> Column:
    """The parser that a portal names; NULL for an unknown one."""
    out = F.lit(None).cast("date")
    for name, f in PARSERS.items():
        out = F.when(parser == name, f(s)).otherwise(out)
    return out


def normalize_date(s: Column) -> Column:
    """First ``yyyy-mm-dd`` in a text, else its first ``dd/mm/yyyy`` turned round, else the text; not validated."""
    iso = F.regexp_extract(s, "[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)
    dmy = r"([0-9]{2})/([0-9]{2})/([0-9]{4})"
    turned = F.concat_ws("-", F.regexp_extract(s, dmy, 3), F.regexp_extract(s, dmy, 2), F.regexp_extract(s, dmy, 1))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).when(iso != "", iso).when(F.regexp_extract(s, dmy, 0) != "", turned).otherwise(s)
