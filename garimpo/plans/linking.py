"""Queries of the linker, over stand-ins made from the driver's tables."""

from pyspark.sql import functions as F

from garimpo.operators import linking as L
from garimpo.plans.scalars import TRGM_SQL, sim_sql
from garimpo.plans.tables import table
from garimpo.registry import query
from garimpo.sources.shared import free, large, stored

# Tenders are orders; modality is the priority, unit the customer, body (nation, segment), place the nation.
# News items are orders too, their tender number written in another way.
STANDIN = """
    WITH places AS (SELECT n_nationkey AS id_municipio, n_name AS nome_municipio FROM nation),
    units AS (SELECT c_custkey AS id_unidade_gestora, c_nationkey * 10 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'MACHINERY' THEN 3 ELSE 4 END AS id_ente,
                c_name || ' ' || c_mktsegment AS texto FROM customer),
    bodies AS (SELECT DISTINCT c_nationkey * 10 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'MACHINERY' THEN 3 ELSE 4 END AS id_ente, c_nationkey AS id_municipio FROM customer),
    mods AS (SELECT id_modalidade_licitacao, descricao FROM (VALUES (1, '1-URGENT'), (2, '2-HIGH'), (3, '3-MEDIUM'), (4, '4-NOT SPECIFIED'), (5, '5-LOW')) v(id_modalidade_licitacao, descricao)),
    procs AS (SELECT o_orderkey AS id_processo_licitatorio, o_orderkey || '/' || year(o_orderdate) AS numero_edital, ascii(o_orderpriority) - 48 AS id_modalidade_licitacao, o_custkey AS id_unidade_gestora FROM orders),
    base AS (SELECT o_orderkey AS id_noticia, o_orderkey || '/' || year(o_orderdate) AS e, (o_orderkey - 1) // 20 AS k, ascii(o_orderpriority) - 48 AS m, c_nationkey, c_name || ' ' || c_mktsegment AS t
             FROM orders JOIN customer ON o_custkey = c_custkey),
    news AS (SELECT id_noticia,
               CASE WHEN k % 37 = 0 THEN 'nan' WHEN k % 4 = 0 THEN '00' || e WHEN k % 4 = 1 THEN 'PL ' || e WHEN k % 4 = 2 THEN substr(e, 2) ELSE e END AS numero_edital,
               CASE WHEN k % 5 <> 0 THEN m END AS id_modalidade_licitacao, CASE WHEN k % 41 <> 0 THEN c_nationkey END AS id_municipio,
               CASE WHEN k % 3 <> 0 THEN t END AS objeto FROM base)"""


def standin(spark, sf_dir):
    """(news, processes, modalities, units, bodies, places, texts) as DataFrames."""
    customer, orders, nation = (table(spark, sf_dir, t) for t in ("customer", "orders", "nation"))
    segment = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in (("AUTOMOBILE", 0), ("BUILDING", 1), ("FURNITURE", 2), ("MACHINERY", 3)) for x in kv]), F.col("c_mktsegment")), F.lit(4))
    ente = (F.col("c_nationkey") * 10 + segment).alias("id_ente")
    texto = F.concat_ws(" ", "c_name", "c_mktsegment")
    units = customer.select(F.col("c_custkey").alias("id_unidade_gestora"), ente, texto.alias("texto"))
    bodies = customer.select(ente, F.col("c_nationkey").alias("id_municipio")).distinct()
    places = nation.select(F.col("n_nationkey").alias("id_municipio"), F.col("n_name").alias("nome_municipio"))
    mods = spark.createDataFrame(list(enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), 1)), "id_modalidade_licitacao int, descricao string")
    edital = F.concat_ws("/", "o_orderkey", F.year("o_orderdate"))
    mod = F.substring("o_orderpriority", 1, 1).cast("int")
    procs = orders.select(F.col("o_orderkey").alias("id_processo_licitatorio"), edital.alias("numero_edital"), mod.alias("id_modalidade_licitacao"), F.col("o_custkey").alias("id_unidade_gestora"))
    k = F.expr("(o_orderkey - 1) div 20")
    news = orders.join(large(customer), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id_noticia"),
        F.when(k % 37 == 0, "nan").when(k % 4 == 0, F.concat(F.lit("00"), edital)).when(k % 4 == 1, F.concat(F.lit("PL "), edital))
        .when(k % 4 == 2, F.expr("substring(concat_ws('/', o_orderkey, year(o_orderdate)), 2)")).otherwise(edital).alias("numero_edital"),
        F.when(k % 5 != 0, mod).alias("id_modalidade_licitacao"), F.when(k % 41 != 0, F.col("c_nationkey")).alias("id_municipio"),
        F.when(k % 3 != 0, texto).alias("objeto"),
    )
    return news, procs, mods, units.drop("texto"), bodies, places, units.select("id_unidade_gestora", "texto")


#: The pairs that may be candidates: those that share about half of their parts or contain one another.
PAIRS = "pairs JOIN asked USING (id_noticia) JOIN offered USING (id_processo_licitatorio)"
CANDIDATES = f"""{STANDIN},
    asked AS (SELECT id_noticia, id_municipio, numero_edital AS asked, objeto, coalesce(descricao, '') AS am, {TRGM_SQL.format('numero_edital')} AS ga, {TRGM_SQL.format('descricao')} AS gm
              FROM news LEFT JOIN mods USING (id_modalidade_licitacao) WHERE id_municipio IS NOT NULL AND lower(numero_edital) NOT IN ('nan', 'null', 'none', '')),
    offered AS (SELECT id_processo_licitatorio, numero_edital, descricao, id_municipio, id_unidade_gestora, {TRGM_SQL.format('numero_edital')} AS gp, {TRGM_SQL.format('descricao')} AS gd
                FROM procs JOIN mods USING (id_modalidade_licitacao) JOIN units USING (id_unidade_gestora) JOIN bodies USING (id_ente)),
    shared AS (SELECT id_noticia, id_processo_licitatorio, count(*) AS c FROM (SELECT id_noticia, id_municipio, unnest(ga) AS g FROM asked)
               JOIN (SELECT id_processo_licitatorio, id_municipio, unnest(gp) AS g FROM offered) USING (id_municipio, g) GROUP BY ALL),
    pairs AS (SELECT id_noticia, id_processo_licitatorio FROM shared JOIN asked USING (id_noticia) JOIN offered USING (id_processo_licitatorio) WHERE c > 0.49 * (len(ga) + len(gp) - c)
              UNION SELECT id_noticia, id_processo_licitatorio FROM asked JOIN offered USING (id_municipio) WHERE numero_edital ILIKE '%' || asked || '%'),
    scored AS (SELECT id_noticia, id_processo_licitatorio, numero_edital, descricao, offered.id_municipio, id_unidade_gestora, objeto, asked, am, {sim_sql('gp', 'ga')} AS se, {sim_sql('gd', 'gm')} AS sm
               FROM {PAIRS}),
    found AS (SELECT *, (se::DOUBLE + sm::DOUBLE) / 2 AS st FROM scored
              WHERE (se > 0.5::FLOAT OR numero_edital ILIKE '%' || asked || '%') AND (am = '' OR sm > 0.5::FLOAT)),
    rk AS (SELECT *, row_number() OVER (PARTITION BY id_noticia ORDER BY st DESC, se DESC, id_processo_licitatorio) AS rank FROM found)"""


def found(spark, sf_dir):
    news, procs, mods, units, bodies, *_ = standin(spark, sf_dir)
    return L.candidates(news, procs, mods, units, bodies)


@query("link_candidates", f"{CANDIDATES} SELECT id_noticia, id_processo_licitatorio, numero_edital, round(se::DOUBLE, 6) AS score_edital, round(sm::DOUBLE, 6) AS score_modalidade, round(st, 6) AS score_total FROM found")
def link_candidates(spark, sf_dir):
    scores = [F.round(c, 6).alias(c) for c in ("score_edital", "score_modalidade", "score_total")]
    return found(spark, sf_dir).select("id_noticia", "id_processo_licitatorio", "numero_edital", *scores)


@query("link_top3", f"{CANDIDATES} SELECT id_noticia, id_processo_licitatorio, rank::INTEGER AS rank FROM rk WHERE rank <= 3")
def link_top3(spark, sf_dir):
    return L.ranked(found(spark, sf_dir), 3).select("id_noticia", "id_processo_licitatorio", "rank")


@query("news_city", """SELECT o_orderkey AS id_noticia, min(n_nationkey) AS id_municipio FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderkey % 7 <> 0
       LEFT JOIN nation ON n_nationkey IN (c_nationkey, (c_nationkey + 3) % 25) GROUP BY 1""")
def news_city(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    seat = customer.select("c_custkey", F.explode(F.array(F.col("c_nationkey"), (F.col("c_nationkey") + 3) % 25)).alias("id_municipio"))
    bridge = orders.filter("o_orderkey % 7 <> 0").join(seat, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("id_noticia"), "id_municipio")
    return L.news_place(orders.select(F.col("o_orderkey").alias("id_noticia")), bridge)


_NAMES = """CASE p_partkey % 6 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN substr(n_name, 1, 4) WHEN 3 THEN n_name || 'X' WHEN 4 THEN p_name ELSE ' ' || n_name || ' ' END"""


@query(
    "resolve_name",
    f"""
    WITH asked AS (SELECT DISTINCT trim({_NAMES}) AS name FROM part JOIN nation ON n_nationkey = p_partkey % 25),
    p AS (SELECT name, n_nationkey AS id, n_name AS place, {sim_sql('a', 'b')} AS s FROM (SELECT name, n_nationkey, n_name, {TRGM_SQL.format('name')} AS a, {TRGM_SQL.format('n_name')} AS b FROM asked CROSS JOIN nation)),
    t AS (SELECT name, id, CASE WHEN place ILIKE name THEN 1 WHEN place ILIKE '%' || name || '%' THEN 2 WHEN s > 0.4::FLOAT THEN 3 END AS tier, s FROM p)
    SELECT name, arg_min(id, (tier, CASE WHEN tier = 3 THEN -s ELSE 0 END, id)) AS id, min(tier)::INTEGER AS tier FROM t WHERE tier IS NOT NULL GROUP BY name
    """,
)
def resolve_name(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    names = table(spark, sf_dir, "part").join(F.broadcast(nation), F.col("n_nationkey") == F.col("p_partkey") % 25).select(
        F.expr("CASE p_partkey % 6 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN substr(n_name, 1, 4) WHEN 3 THEN concat(n_name, 'X') WHEN 4 THEN p_name ELSE concat(' ', n_name, ' ') END").alias("name")
    )
    return L.resolve_names(names, nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("place")))


def info(spark, sf_dir):
    """(candidates with details, objects)"""
    news, procs, mods, units, bodies, places, texts = standin(spark, sf_dir)
    cands = free(stored(L.candidates(news, procs, mods, units, bodies).select("id_noticia", "id_processo_licitatorio")))
    known = L.details(cands, procs, mods, units, bodies, places).join(large(texts), "id_unidade_gestora")
    known = free(stored(known.select("id_processo_licitatorio", "numero_edital", "nome_municipio", "descricao", "texto")))
    return large(cands).join(known, "id_processo_licitatorio"), news.select("id_noticia", "objeto")


@query("candidate_info", f"{CANDIDATES} SELECT DISTINCT id_processo_licitatorio, numero_edital, nome_municipio, descricao, id_unidade_gestora FROM found JOIN places USING (id_municipio)")
def candidate_info(spark, sf_dir):
    news, procs, mods, units, bodies, places, _ = standin(spark, sf_dir)
    return L.details(found(spark, sf_dir), procs, mods, units, bodies, places).select("id_processo_licitatorio", "numero_edital", "nome_municipio", "descricao", "id_unidade_gestora")


@query("dup_candidates", f"""{CANDIDATES} SELECT id_noticia, count(*) AS n, count(*) > 1 AND count(DISTINCT (lower(trim(numero_edital)), lower(trim(nome_municipio)), lower(trim(descricao)))) = 1 AS duplicates
       FROM (SELECT id_noticia, split_part(numero_edital, '/', 2) AS numero_edital, nome_municipio, descricao FROM found JOIN places USING (id_municipio)) GROUP BY 1""")
def dup_candidates(spark, sf_dir):
    known, _ = info(spark, sf_dir)
    return L.duplicated(known.withColumn("numero_edital", F.substring_index("numero_edital", "/", -1)))


DECIDED = f"""{CANDIDATES},
    texts AS (SELECT id_noticia, id_processo_licitatorio, numero_edital, nome_municipio, descricao, objeto, {sim_sql('go', 'gt')}::DOUBLE AS s FROM (
      SELECT *, {TRGM_SQL.format('objeto')} AS go, {TRGM_SQL.format('texto')} AS gt FROM found JOIN units USING (id_unidade_gestora) JOIN places USING (id_municipio))),
    best AS (SELECT id_noticia, count(*) AS n, min(id_processo_licitatorio) AS least_id, bool_or(objeto IS NULL) AS no_object,
               count(DISTINCT (lower(trim(numero_edital)), lower(trim(nome_municipio)), lower(trim(descricao)))) AS d,
               list((s, id_processo_licitatorio) ORDER BY s DESC, id_processo_licitatorio) AS every FROM texts GROUP BY 1),
    chosen AS (SELECT id_noticia, n, CASE WHEN n > 1 AND d = 1 THEN least_id
                 WHEN NOT no_object AND every[1][1] >= 0.2 - 1e-12 AND every[1][1] - coalesce(every[2][1], 0) >= 0.05 - 1e-12 THEN every[1][2] END AS chosen, least_id FROM best)"""


@query("disambiguate", f"{DECIDED} SELECT id_noticia, chosen FROM chosen")
def disambiguate(spark, sf_dir):
    return L.disambiguate(*info(spark, sf_dir))


LINKED = f"""{DECIDED},
    linked AS (SELECT id_noticia, CASE WHEN n = 1 THEN 'linked' WHEN chosen IS NOT NULL THEN 'linked_via_llm' WHEN n > 1 THEN 'ambiguous' ELSE 'no_match' END AS status,
                 CASE WHEN n = 1 THEN least_id ELSE chosen END AS id_processo_licitatorio, coalesce(n, 0)::BIGINT AS n_candidates FROM news LEFT JOIN chosen USING (id_noticia))"""


def linked(spark, sf_dir):
    cands, objects = info(spark, sf_dir)
    news = standin(spark, sf_dir)[0]
    return L.decide(news, cands, L.disambiguate(cands, objects))


@query("link_news", f"{LINKED} SELECT * FROM linked")
def link_news(spark, sf_dir):
    return linked(spark, sf_dir)


@query("apply_links", f"""{LINKED} SELECT id_noticia, numero_edital, coalesce(linked.id_processo_licitatorio, CASE WHEN id_noticia % 3 = 0 THEN -id_noticia END) AS id_processo_licitatorio FROM news JOIN linked USING (id_noticia)""")
def apply_links(spark, sf_dir):
    news = standin(spark, sf_dir)[0].select("id_noticia", "numero_edital", F.when(F.col("id_noticia") % 3 == 0, -F.col("id_noticia")).alias("id_processo_licitatorio"))
    return L.apply_links(news, linked(spark, sf_dir))
