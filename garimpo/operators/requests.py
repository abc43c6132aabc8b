"""Collection requests: which portal-days are still to be loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def target_day(text: Column, as_of: Column) -> Column:
    """The given day (dd/mm/yyyy) where it is one, else the day before ``as_of``."""
    iso = F.regexp_replace(text, "^([0-9]{2})/([0-9]{2})/([0-9]{4})$", "$3-$2-$1")
    return F.coalesce(F.when(iso != text, iso.try_cast("date")), F.date_sub(as_of, 1))


def gaps(portals: DataFrame, collected: DataFrame, first: str, last: str) -> DataFrame:
    """``portal, day`` of every portal and day of the range without a collected row."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    wanted = portals.select("portal", F.explode(days).alias("day"))
    return wanted.join(collected.select("portal", "day").distinct(), ["portal", "day"], "left_anti")
