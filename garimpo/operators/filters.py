"""Filters, page runs and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def on_date(articles: DataFrame, date: str, day: str) -> DataFrame:
    """Articles of one day; a range on the column itself, so that files can be skipped."""
    d = F.lit(day).cast("date")
    return articles.filter((F.col(date) >= d) & (F.col(date) < F.date_add(d, 1)))


def page_profile(articles: DataFrame, page: str, date: Column, day: str) -> DataFrame:
    """For each page: whether it holds the day, its newest and oldest date."""
    return articles.groupBy(page).agg(
        F.coalesce(F.bool_or(date == F.lit(day).cast("date")), F.lit(False)).alias("has_target"), F.max(date).alias("newest"), F.min(date).alias("oldest")
    )


#: Page numbers of one block, in which runs are found before they are joined over the blocks' borders.
BLOCK = 100_000


def page_runs(profile: DataFrame, page: str, by: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """``*by, first_page, last_page`` of every run of pages without a gap that all hold the day, for each ``by``.

    Runs are found inside blocks of page numbers, each a group of its own; only runs that touch a block's
    border, two a block at most, are then put together in order.
    """
    by, number = by or [], F.col(page)
    hits = profile.filter("has_target").select(*by, page, F.floor(number / block).alias("_block"))
    rank = F.row_number().over(Window.partitionBy(*by, "_block").orderBy(page))
    inside = hits.withColumn("_run", number - rank).groupBy(*by, "_block", "_run").agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"))
    low = F.col("_block") * block
    border = (F.col("first_page") == low) | (F.col("last_page") == low + block - 1)
    at_border = inside.filter(border).select(*by, "first_page", "last_page")
    order = Window.partitionBy(*by).orderBy("first_page")
    new = F.coalesce(F.lag("last_page").over(order) + 1 != F.col("first_page"), F.lit(True)).cast("long")
    joined = at_border.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    joined = joined.groupBy(*by, "_run").agg(F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page")).drop("_run")
    return inside.filter(~border).select(*by, "first_page", "last_page").unionByName(joined)


def target_run(profile: DataFrame, page: str, by: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Pages of the first run, for each ``by``, of pages without a gap that all hold the day."""
    by = by or []
    first = page_runs(profile, page, by, block).groupBy(*by).agg(F.min(F.struct("first_page", "last_page")).alias("_r"))
    first = first.select(*[F.col(c).alias(f"_{c}") for c in by], "_r.first_page", "_r.last_page").filter("first_page is not null")
    within = (F.col(page) >= F.col("first_page")) & (F.col(page) <= F.col("last_page"))
    for c in by:
        within = within & F.col(c).eqNullSafe(F.col(f"_{c}"))
    few = first if by else F.broadcast(first)  # without ``by`` one row
    return profile.filter("has_target").join(few, within, "left_semi")


def verify(records: DataFrame) -> DataFrame:
    """``error`` and ``warning`` beside each record: no ``noticia`` or no ``titulo`` is an error, no ``link`` a warning."""
    noticia = F.col("noticia")
    return records.withColumns({
        "error": F.when(noticia.isNull(), "noticia missing").when(F.coalesce(noticia["titulo"], F.lit("")) == "", "titulo missing"),
        "warning": F.when(noticia.isNotNull() & (F.coalesce(noticia["link"], F.lit("")) == ""), "link missing"),
    })


def with_text(records: DataFrame, text: str) -> DataFrame:
    """``error`` where a record has no text to classify."""
    return records.withColumn("error", F.when(F.coalesce(F.col(text), F.lit("")) == "", "text missing"))


def topic_pattern(binding: Column) -> Column:
    """A topic binding as a regular expression: ``*`` is one word, ``#`` any number of words."""
    out = F.regexp_replace(binding, r"\.", r"\\.")
    out = F.regexp_replace(out, r"\*", "[^.]+")
    out = F.regexp_replace(out, r"\\\.#", r"(?:\\.[^.]+)*")
    out = F.regexp_replace(out, r"^#\\\.", r"(?:[^.]+\\.)*")
    return F.concat(F.lit("^"), F.regexp_replace(out, "#", ".*"), F.lit("$"))


def route(messages: DataFrame, bindings: DataFrame, key: str = "routing_key") -> DataFrame:
    """A row for each queue that a message's key matches; ``bindings`` (queue, binding) is configuration.

    Distinct keys are matched, then joined back, so patterns run once for each key.
    """
    keys = messages.select(key).distinct()
    matched = keys.join(F.broadcast(bindings.withColumn("_rx", topic_pattern(F.col("binding")))), F.expr(f"{key} rlike _rx")).select(key, "queue").distinct()
    return messages.join(matched, key)


def collection_of(source: Column, entity: Column, routes: dict[str, list[str]]) -> Column:
    """``source.entity`` where a source's route lists the entity, the source alone otherwise."""
    out = F.lit(None).cast("string")
    for name, known in routes.items():
        out = F.when((source == name) & entity.isin(known), F.concat_ws(".", source, entity)).otherwise(out)
    return F.coalesce(out, source)
