"""From raw articles to verified envelopes, and the whole flow to linked news."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.functions.text import first_filled, portal_of_url, summary
from garimpo.operators import filters, keys, linking, models, stats
from garimpo.sources import landing
from garimpo.sources.shared import large, small, stored


def envelope(rows: DataFrame, source: str, uf: str = "SC") -> DataFrame:
    """Processed records: the first of each extracted list, absent parts NULL."""
    first = lambda c: F.get(c, F.lit(0))
    noticia = F.struct(
        F.col("url").alias("link"), F.col("title").alias("titulo"), F.col("date_publication").cast("string").alias("data_publicacao"),
        first_filled(F.col("portal"), portal_of_url(F.col("url"))).alias("nome_portal"), first("edital").alias("numero_edital"), first("objeto").alias("objeto"),
        F.col("text").alias("texto"), summary(F.col("chamada"), F.col("text")).alias("chamada"),
    )
    place = F.struct(first("municipio").alias("nome_municipio"), F.lit(uf).alias("sigla_uf"), F.lit("Santa Catarina").alias("nome_uf"))
    return rows.select(
        "raw_data_id", F.lit(source).alias("data_source"), noticia.alias("noticia"),
        F.when(F.size("municipio") > 0, place).alias("municipio"), F.when(F.size("modalidade") > 0, F.struct(first("modalidade").alias("descricao"))).alias("modalidade_licitacao"),
    )


def process(articles: DataFrame, model: PipelineModel, places: DataFrame, source: str, keep=lambda df: df) -> DataFrame:
    """Classify, keep what is relevant, extract, wrap.  ``keep`` writes between the cheap and the dear step."""
    with_text = filters.with_text(articles, "text").filter("error is null").drop("error")
    relevant = keep(models.classify(model, with_text).filter("prediction = 1"))
    return envelope(models.extract(relevant, "raw_data_id", "text", places), source)


def verified(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, failed) records of the verifier."""
    checked = filters.verify(records)
    return checked.filter("error is null").drop("error"), checked.filter("error is not null")


def places_of(records: DataFrame, places: DataFrame) -> DataFrame:
    """``name, id_municipio``: the municipality of each name in verified envelopes, by the resolver's three tiers."""
    names = records.select(F.trim("municipio.nome_municipio").alias("name"))
    return stored(linking.resolve_names(names, places).select("name", F.col("id").alias("id_municipio")))


def news_of(records: DataFrame, key: str, resolved: DataFrame, modalities: DataFrame) -> DataFrame:
    """Verified envelopes as rows for the linker: ``id_noticia, id_municipio, numero_edital, id_modalidade_licitacao, objeto``.

    ``resolved`` are ``name, id_municipio``, ``modalities`` ``id_modalidade_licitacao, descricao``; what they
    don't know is NULL.
    """
    flat = records.select(
        F.col(key).alias("id_noticia"), F.trim("municipio.nome_municipio").alias("name"), F.col("noticia.numero_edital").alias("numero_edital"),
        F.col("modalidade_licitacao.descricao").alias("descricao"), F.col("noticia.objeto").alias("objeto"), F.col("noticia.nome_portal").alias("nome_portal"),
    )
    kinds = modalities.groupBy("descricao").agg(F.min("id_modalidade_licitacao").alias("id_modalidade_licitacao"))
    return flat.join(large(resolved), "name", "left").join(small(kinds), "descricao", "left").drop("name", "descricao")


def statistics(landed: DataFrame) -> dict[str, DataFrame]:
    """What a run reports of its landed articles: totals, portals, recent dates, collections, first and last article, and each portal's own days."""
    day = F.col("date_publication")
    return {
        "totals": stats.totals(landed, "portal", F.col("raw_data_collection")), "by_portal": stats.by_portal(landed, "portal", day), "recent_dates": stats.recent_dates(landed, day),
        "by_collect": stats.by_collect(landed, "collect_id", "portal", "date_publication", "raw_data_id"),
        "first_last": stats.first_last(landed, "portal", "date_publication", "raw_data_id", ["date_publication", "title", "url"]),
        "portal_days": landed.groupBy("portal", day.alias("date")).agg(F.count("*").alias("n")),
    }


def end_to_end(
    articles: DataFrame, model: PipelineModel, dictionary: DataFrame, source: str, land_at: str, collect_id: str,
    catalogue: tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame], texts: DataFrame,
) -> dict[str, DataFrame]:
    """The whole flow: landing, processing, verifying, key gate, linking, write-back.

    ``articles`` have ``url, title, text, portal, chamada, date_publication``; ``catalogue`` is (processes,
    modalities, units, bodies, places); ``texts`` give the ``texto`` of units.  Names are resolved first, and the gate lets through
    news whose municipality, if they name one, is known by any tier; the others wait.  Returns ``landed``,
    ``failed`` (verifier), ``waiting`` (gate), ``links`` (decisions), ``news`` (written back) and, under ``statistics/...``, what
    :func:`statistics` reports.
    """
    processes, modalities, units, bodies, places = catalogue
    landing.land(landing.stamp(articles, source, collect_id, ["url"]), land_at)
    landed = landing.collections_of(articles.sparkSession, land_at, source).filter(F.col("collect_id") == collect_id)
    good, failed = verified(stored(process(landed, model, dictionary, source.lower(), keep=stored)))
    known = places.select(F.col("id_municipio").alias("id"), F.col("nome_municipio").alias("place"))
    resolved = places_of(good, known)
    # A name that no tier knows is a reference to a municipality that is not there.
    name = F.trim("municipio.nome_municipio")
    rows = good.withColumn("_name", name).join(large(resolved.withColumnRenamed("name", "_name")), "_name", "left").withColumn("fk_municipio", F.coalesce(F.col("id_municipio").cast("string"), "_name")).drop("_name", "id_municipio")
    records = {"noticia": rows, "municipio": places.withColumn("raw_data_id", F.col("id_municipio").cast("string"))}
    deps = [keys.Dependency("noticia", "municipio", "fk_municipio", "id_municipio")]
    ready_ids, _ = keys.gate(records, "raw_data_id", deps)
    own = ready_ids.filter("entity = 'noticia'").select(F.substring("id", len("noticia:") + 1, 1 << 30).alias("raw_data_id"))
    ready = stored(good.join(large(own), "raw_data_id", "left_semi"))
    late = rows.join(large(own), "raw_data_id", "left_anti")
    waiting = stored(keys.pendencies(late, "raw_data_id", records, deps, F.current_timestamp()))
    news = stored(news_of(ready, "raw_data_id", resolved, modalities))
    found = stored(linking.candidates(news, processes, modalities, units, bodies).select("id_noticia", "id_processo_licitatorio"))
    info = found.join(large(linking.details(found, processes, modalities, units, bodies, places).join(large(texts), "id_unidade_gestora")), "id_processo_licitatorio")
    links = stored(linking.decide(news, found, linking.disambiguate(info, news.select("id_noticia", "objeto"))))
    written = linking.apply_links(news.withColumn("id_processo_licitatorio", F.lit(None).cast("long")), links)
    out = {"landed": landed, "failed": failed, "waiting": waiting, "links": links, "news": written}
    return out | {f"statistics/{name}": df for name, df in statistics(landed).items()}
