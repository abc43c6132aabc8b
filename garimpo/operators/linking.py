"""Linking news to tenders: names to municipalities, candidate cascade, ranking and decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions.text import missing
from garimpo.functions.trigram import similarity, trigrams
from garimpo.operators import numbers
from garimpo.sources.shared import free, large, small, stored

#: Similarity that a name has to pass, and that tender numbers and modalities have to pass.
NAME_LEAST, LINK_LEAST = 0.4, 0.5
#: Meetings by two trigrams that a text may have on the average; beyond, texts meet by one.
MEETINGS = 40


def similar_pairs(left: DataFrame, right: DataFrame, least: float, scope: list[str] | None = None) -> DataFrame:
    """``a, b, score`` of pairs of texts with trigram similarity above ``least``, without a cartesian product.

    ``left`` has ``a, text`` and ``right`` has ``b, text``, both the ``scope`` columns that must be
    equal.  Sets of na and nb trigrams that are similar enough share c = least / (1 + least) * (na + nb) at least.  With
    trigrams in one order, the first m that both have lie among the first na - c + m of one and nb - c + m of the other.
    Those that are rare in ``right`` come first, which keeps what all rows have (years, padding) out of the join;
    texts meet by two trigrams at once, by one where texts are long or may share only one.  A bit map of either
    set drops most of what can't share c within the join itself; whole sets decide.
    """
    scope = scope or []
    la = stored(left.select("a", *scope, "text").distinct().withColumn("_g", trigrams(F.col("text"))).withColumn("_n", F.size("_g")).filter("_n > 0"))
    lb = stored(right.select("b", *scope, "text").distinct().withColumn("_g", trigrams(F.col("text"))).withColumn("_n", F.size("_g")).filter("_n > 0"))
    often = small(stored(lb.select(F.explode("_g").alias("_g")).groupBy("_g").agg(F.count("*").alias("df"))))
    share = lambda na, nb: F.floor((na + nb) * F.lit(least / (1 + least)) - 1e-6).cast("int") + 1

    def fewest(partners: int) -> Column:
        """What a text shares with its smallest possible partner at least."""
        return F.greatest(share(F.col("_n"), F.greatest(F.lit(partners), F.ceil(F.col("_n") * F.lit(least) - 1e-6).cast("int"))), F.lit(1))

    # Whole numbers: the smallest set of either side, and how many meetings by two there would be.
    smallest = [df.select(F.coalesce(F.min("_n"), F.lit(1))).first()[0] for df in (la, lb)]
    first = F.least(F.col("_n"), F.greatest(F.col("_n") - F.col("_c") + 2, F.lit(0)))
    meetings = [df.withColumn("_c", fewest(s)).select(F.count("*"), F.coalesce(F.sum((first * (first - 1) / 2).cast("double")), F.lit(0.0))).first() for df, s in zip((la, lb), smallest[::-1])]
    two = sum(x[1] for x in meetings) <= MEETINGS * sum(x[0] for x in meetings)

    def signed(df: DataFrame, key: str, partners: int) -> DataFrame:
        """A row for each one or two of a text's first trigrams: their hash, how many they are and the place of the last."""
        each = df.select(key, *scope, "text", "_n", F.explode("_g").alias("_g")).join(often, "_g", "left")
        token = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "_g", F.xxhash64("_g").alias("h"))
        rows = each.groupBy(key, *scope, "text", "_n").agg(F.sort_array(F.collect_list(token)).alias("_t")).withColumn("_c", fewest(partners))
        bits = F.aggregate("_t", F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(y["h"], F.lit(64)).cast("int"))))
        front = F.slice("_t", 1, F.least(F.col("_n"), F.greatest(F.col("_n") - F.col("_c") + (2 if two else 1), F.lit(0))))
        mark = lambda h, i, m: F.struct(h.alias("h"), (i + 1).cast("int").alias("i"), F.lit(m).alias("m"))
        ones = F.transform(front, lambda y, j: mark(y["h"], j, 1))
        if two:
            pairs = F.flatten(F.transform(front, lambda y, j: F.transform(F.slice(front, F.lit(1), j), lambda x: mark(F.xxhash64(x["h"], y["h"]), j, 2))))
            ones = F.when(F.col("_c") < 2, F.concat(pairs, ones)).otherwise(pairs)
        out = rows.select(key, *scope, "_n", bits.alias("bits"), F.explode(ones).alias("_s"))
        return out.select(F.xxhash64(*scope, "_s.h", "_s.m").alias("_h"), key, F.col("_n").alias(f"n{key}"), F.col("bits").alias(f"bits{key}"), F.col("_s.i").alias(f"i{key}"), F.col("_s.m").alias(f"m{key}"))

    c, both = share(F.col("na"), F.col("nb")), F.col("ma")
    lacks = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y))))
    fits = (both == F.col("mb")) & (F.col("ia") <= F.col("na") - c + both) & (F.col("ib") <= F.col("nb") - c + both)
    if two:
        fits = fits & ((both == 2) == (c >= 2))
    fits = fits & (F.col("na") - lacks("bitsa", "bitsb") >= c) & (F.col("nb") - lacks("bitsb", "bitsa") >= c)
    pairs = large(signed(la, "a", smallest[1])).join(signed(lb, "b", smallest[0]), "_h").filter(fits).select("a", "b").distinct()
    texts = lambda df, key: large(df.select(key, *scope, F.col("text").alias(f"text_{key}")))
    return (
        large(pairs).join(texts(la, "a"), "a").join(texts(lb, "b"), ["b", *scope]).withColumn("score", similarity(F.col("text_a"), F.col("text_b")))
        .filter(F.col("score") > F.lit(least).cast("float")).select("a", "b", "score").distinct()
    )


def literal(text: Column) -> Column:
    """The longest part of a pattern that stands for itself: between ``%``, ``_`` and escaped letters."""
    parts = F.split(text, r"[%_]|\\.|\\$", -1)
    return F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]


def matching(asked: DataFrame, offered: DataFrame, text: str, whole: str, scope: list[str], inside: Column) -> DataFrame:
    """Rows of ``asked`` and ``offered``, equal in ``scope``, of which ``inside`` holds: a match of pattern ``text`` in ``whole``.

    Whatever a pattern matches holds its longest literal part, so patterns are found by an equi-join on the first six letters
    of that part, three where it has less.  Only where there are patterns without three letters in a row are these compared with all of their scope.
    """
    asked = asked.withColumn("_lit", literal(F.col(text)))
    few, more = numbers.LETTERS
    known = F.length("_lit") >= few
    starts = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(whole) - (n - 1), F.lit(1))), lambda i: F.substr(F.lower(whole), i, F.lit(n)))
    parts = offered.select("*", F.explode(F.array_distinct(F.concat(starts(few), starts(more)))).alias("_g"))
    start = F.substring(F.lower("_lit"), 1, F.when(F.length("_lit") >= more, more).otherwise(few))
    found = large(asked.filter(known).withColumn("_g", start)).join(parts, [*scope, "_g"]).filter(inside).drop("_g", "_lit")
    odd = asked.filter(~known).drop("_lit")
    if not odd.limit(1).count():
        return found
    return found.unionByName(odd.join(offered, scope).filter(inside) if scope else odd.join(small(offered), inside))


def containing(asked: DataFrame, offered: DataFrame, text: str, whole: str, scope: list[str]) -> DataFrame:
    """Rows of ``asked`` and ``offered``, equal in ``scope``, whose ``whole`` contains ``text``, letter case aside; ``%`` and ``_`` are wildcards."""
    return matching(asked, offered, text, whole, scope, F.expr(f"{whole} ilike concat('%', {text}, '%')"))


def resolve_names(names: DataFrame, places: DataFrame, least: float = NAME_LEAST) -> DataFrame:
    """``name, id, tier``: the place of each distinct name; equal, then contained, then similar.

    ``names`` has ``name``, ``places`` has ``id, place``.  Every tier sees only what the one before
    left over; within a tier the best score wins, then the smallest id.  ``%`` and ``_`` in a name
    are wildcards, as in the pattern match that this stands for.
    """
    asked = names.select(F.trim("name").alias("name")).filter("name is not null and name <> ''").distinct()
    plain = asked.filter(~F.col("name").rlike("[%_\\\\]"))
    exact = plain.join(places, F.lower("name") == F.lower("place")).groupBy("name").agg(F.min("id").alias("id"))
    wild = stored(asked.filter(F.col("name").rlike("[%_\\\\]")))
    wild = matching(wild, places, "name", "place", [], F.expr("place ilike name")).groupBy("name").agg(F.min("id").alias("id"))
    exact = exact.unionByName(wild)
    exact = stored(exact)
    rest = stored(asked.join(exact, "name", "left_anti"))
    part = containing(rest, places, "name", "place", []).groupBy("name").agg(F.min("id").alias("id"))
    part = stored(part)
    rest = rest.join(part, "name", "left_anti")
    close = similar_pairs(rest.select(F.col("name").alias("a"), F.col("name").alias("text")), places.select(F.col("id").alias("b"), F.col("place").alias("text")), least)
    close = close.groupBy(F.col("a").alias("name")).agg(F.min_by("b", F.struct(-F.col("score"), F.col("b"))).alias("id"))
    tiers = (exact, part, close)
    found = [t.select("name", "id", F.lit(i + 1).alias("tier")) for i, t in enumerate(tiers)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def news_place(news: DataFrame, bridge: DataFrame) -> DataFrame:
    """News with one municipality each, the smallest of the bridge table's; NULL where it has none."""
    one = bridge.groupBy("id_noticia").agg(F.min("id_municipio").alias("id_municipio"))
    return news.join(large(one), "id_noticia", "left")


def candidates(news: DataFrame, processes: DataFrame, modalities: DataFrame, units: DataFrame, bodies: DataFrame, least: float = LINK_LEAST) -> DataFrame:
    """``id_noticia, id_processo_licitatorio, numero_edital, score_edital, score_modalidade, score_total``.

    Process, modality, unit and body are joined by their keys and to the news by municipality;
    the tender number must be similar or contain the news' one, and so must the modality where
    the news has one.  News without municipality or number have no candidates.

    Modalities are compared as distinct pairs, numbers within tasks (:mod:`garimpo.operators.numbers`); only numbers that
    are too short or hold wildcards are matched by a join.  Ids of news and of processes are unique.
    """
    asked = (
        news.filter(F.col("id_municipio").isNotNull() & ~missing(F.col("numero_edital")))
        .join(small(modalities.select(F.col("id_modalidade_licitacao"), F.col("descricao").alias("asked_modality"))), "id_modalidade_licitacao", "left")
        .select("id_noticia", "id_municipio", F.col("numero_edital").alias("asked"), F.coalesce("asked_modality", F.lit("")).alias("asked_modality"))
    )
    asked = stored(asked)
    places = small(asked.select("id_municipio").distinct())
    offered = stored(
        processes.join(modalities, "id_modalidade_licitacao")
        .join(large(units), "id_unidade_gestora").join(bodies, "id_ente").join(places, "id_municipio", "left_semi")
        .select("id_processo_licitatorio", "numero_edital", "descricao", "id_municipio")
    )
    kinds = similar_pairs(
        asked.filter("asked_modality <> ''").select(F.col("asked_modality").alias("a"), F.col("asked_modality").alias("text")).distinct(),
        offered.select(F.col("descricao").alias("b"), F.col("descricao").alias("text")).distinct(), least,
    ).select(F.col("a").alias("asked_modality"), F.col("b").alias("descricao"), F.col("score").alias("score_modalidade"))
    kinds = kinds.unionByName(offered.select(F.lit("").alias("asked_modality"), "descricao", F.lit(0.0).cast("float").alias("score_modalidade")).distinct())
    scoped = free(asked).join(small(stored(kinds)), "asked_modality")
    scope = ["id_municipio", "descricao"]
    found = numbers.near_or_containing(
        scoped.select(F.col("id_noticia").alias("a"), *scope, F.col("asked").alias("text"), F.col("score_modalidade").alias("kind")),
        offered.select(F.col("id_processo_licitatorio").alias("b"), *scope, F.col("numero_edital").alias("text")), least, scope,
    ).select(F.col("a").alias("id_noticia"), F.col("b").alias("id_processo_licitatorio"), F.col("text_b").alias("numero_edital"), F.col("kind").alias("score_modalidade"), F.col("score").alias("score_edital"))
    odd = scoped.filter(~numbers.plain(F.col("asked")))
    if asked.filter(~numbers.plain(F.col("asked"))).limit(1).count():
        held = containing(odd, offered, "asked", "numero_edital", scope).withColumn("score_edital", similarity(F.col("numero_edital"), F.col("asked")))
        found = found.unionByName(held.select(*found.columns)).dropDuplicates(["id_noticia", "id_processo_licitatorio"])
    return found.select(
        "id_noticia", "id_processo_licitatorio", "numero_edital",
        F.col("score_edital").cast("double").alias("score_edital"), F.col("score_modalidade").cast("double").alias("score_modalidade"),
        ((F.col("score_edital").cast("double") + F.col("score_modalidade").cast("double")) / 2).alias("score_total"),
    )


def ranked(found: DataFrame, top: int | None = None) -> DataFrame:
    """Candidates with their ``rank``: best total, then best number, then smallest id."""
    order = Window.partitionBy("id_noticia").orderBy(F.col("score_total").desc(), F.col("score_edital").desc(), "id_processo_licitatorio")
    out = found.withColumn("rank", F.row_number().over(order))
    return out.filter(F.col("rank") <= top) if top else out


def details(found: DataFrame, processes: DataFrame, modalities: DataFrame, units: DataFrame, bodies: DataFrame, places: DataFrame) -> DataFrame:
    """What is known of the candidate processes: number, object, unit, body's municipality, modality."""
    wanted = processes.join(large(found.select("id_processo_licitatorio").distinct()), "id_processo_licitatorio", "left_semi")
    return (
        wanted.join(large(units), "id_unidade_gestora", "left").join(bodies, "id_ente", "left")
        .join(places, "id_municipio", "left").join(modalities, "id_modalidade_licitacao", "left")
    )


def _duplicates() -> Column:
    """Whether all of several rows share number, municipality and modality, as an aggregate that keeps two of them."""
    same = F.struct(*[F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in ("numero_edital", "nome_municipio", "descricao")])
    return (F.count("*") > 1) & (F.min(same) == F.max(same))


def duplicated(info: DataFrame) -> DataFrame:
    """``id_noticia, n, duplicates``: whether all of several candidates share number, municipality and modality."""
    return info.groupBy("id_noticia").agg(F.count("*").alias("n"), _duplicates().alias("duplicates"))


def disambiguate(info: DataFrame, objects: DataFrame, least: float = 0.2, margin: float = 0.05) -> DataFrame:
    """``id_noticia, chosen``: one of several candidates, or NULL.

    Duplicates: the smallest id.  Else the candidate whose ``texto`` is most similar to the
    news' ``objeto``, if it reaches ``least`` and leads by ``margin``; none without an object.
    A model's answer can be given in ``answer`` of ``objects``; it counts where it names a candidate.
    """
    scored = info.join(large(objects), "id_noticia", "left").withColumn("score", similarity(F.col("objeto"), F.col("texto")).cast("double"))
    pair = F.struct((-F.col("score")).alias("s"), F.col("id_processo_licitatorio").alias("id"))
    # The best of a news item's candidates stands beside each, so that one pass, dealt once, also finds the best of the others.
    order = Window.partitionBy("id_noticia").orderBy(pair).rowsBetween(Window.unboundedPreceding, 0)
    scored = scored.withColumn("_best", F.first(pair).over(order))
    best = scored.groupBy("id_noticia").agg(
        F.min("_best").alias("first"), F.min("id_processo_licitatorio").alias("least_id"), F.max(missing(F.col("objeto"))).alias("no_object"),
        F.max(F.when(F.col("id_processo_licitatorio") != F.col("_best.id"), F.col("score"))).alias("next"), _duplicates().alias("duplicates"),
        *([F.max("answer").alias("answer"), F.bool_or(F.col("id_processo_licitatorio") == F.col("answer")).alias("answered")] if "answer" in objects.columns else [F.lit(None).cast("bigint").alias("answer"), F.lit(False).alias("answered")]),
    )
    lead = -F.coalesce("next", F.lit(0.0)) - F.col("first.s")
    return best.select(
        "id_noticia",
        F.when(F.col("duplicates"), F.col("least_id"))
        .when(F.col("answered"), F.col("answer"))
        .when(~F.col("no_object") & (-F.col("first.s") >= least - 1e-12) & (lead >= margin - 1e-12), F.col("first.id")).alias("chosen"),
    )


def decide(news: DataFrame, found: DataFrame, chosen: DataFrame) -> DataFrame:
    """``id_noticia, status, id_processo_licitatorio, n_candidates`` for every news item.

    One candidate: ``linked``; several: ``linked_via_llm`` where one was chosen, else ``ambiguous``;
    none: ``no_match``.
    """
    counts = found.groupBy("id_noticia").agg(F.count("*").alias("n"), F.min("id_processo_licitatorio").alias("only"))
    return (
        news.select("id_noticia").join(large(counts), "id_noticia", "left").join(large(chosen), "id_noticia", "left")
        .select(
            "id_noticia",
            F.when(F.col("n") == 1, "linked").when(F.col("chosen").isNotNull(), "linked_via_llm").when(F.col("n") > 1, "ambiguous").otherwise("no_match").alias("status"),
            F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("chosen")).alias("id_processo_licitatorio"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n_candidates"),
        )
    )


def apply_links(news: DataFrame, links: DataFrame) -> DataFrame:
    """News with the process of a new link, the old one where there is none."""
    new = links.filter("id_processo_licitatorio is not null").select("id_noticia", F.col("id_processo_licitatorio").alias("_new"))
    return news.join(large(new), "id_noticia", "left").withColumn("id_processo_licitatorio", F.coalesce("_new", "id_processo_licitatorio")).drop("_new")
