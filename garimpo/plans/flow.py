"""Queries of keys, cache, sources, pages, graph, models and streams."""


from pyspark.sql import functions as F

from garimpo.functions import text
from garimpo.operators import cache as C
from garimpo.operators import graph as G
from garimpo.operators import keys as K
from garimpo.operators import linking as L
from garimpo.operators import models as M
from garimpo.operators import pipeline as P
from garimpo.operators import stats as S
from garimpo.plans.linking import LINKED, info, standin
from garimpo.plans.tables import table
from garimpo.registry import query
from garimpo.sources import articles as A
from garimpo.sources import html as H
from garimpo.sources import landing as LA
from garimpo.sources import tables as T
from garimpo.sources.shared import shared_dir, stored
from garimpo.streaming import cache as SC
from garimpo.streaming import keys as SK
from garimpo.streaming import linking as SL
from garimpo.streaming import records as SR
from garimpo.streaming import stages as SS


# Keys ------------------------------------------------------------------------------------

LINE_DEPS = [K.Dependency("lineitem", "orders", "l_orderkey", "o_orderkey", True), K.Dependency("lineitem", "part", "l_partkey", "p_partkey")]


def line_parts(spark, sf_dir):
    """(lineitem, its references with holes)"""
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 11 <> 0")
    part = table(spark, sf_dir, "part").filter("p_partkey % 13 <> 0")
    return table(spark, sf_dir, "lineitem"), {"orders": orders, "part": part}


@query("fk_enrich", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderstatus, p_name, false AS rejected FROM lineitem
       LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 11 <> 0) ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_partkey % 13 <> 0) ON l_partkey = p_partkey""")
def fk_enrich(spark, sf_dir):
    rows, refs = line_parts(spark, sf_dir)
    r = K.enrich(rows, refs, LINE_DEPS)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "orders.o_custkey", "orders.o_orderstatus", "part.p_name", "rejected")


_PENDING = """SELECT 'orders' AS missing_entity, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS raw_data_id, 'l_orderkey' AS missing_fk_field, l_orderkey::VARCHAR AS fk_value FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 11 <> 0) UNION ALL
       SELECT 'part', l_orderkey || '-' || l_linenumber || '-' || l_partkey, 'l_partkey', l_partkey::VARCHAR FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 13 <> 0)"""


def line_pendencies(spark, sf_dir):
    rows, refs = line_parts(spark, sf_dir)
    rows = rows.withColumn("raw_data_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    return K.pendencies(rows, "raw_data_id", refs, LINE_DEPS, F.lit("2024-01-01").cast("timestamp"))


@query("fk_pending", _PENDING)
def fk_pending(spark, sf_dir):
    return line_pendencies(spark, sf_dir).select("missing_entity", "raw_data_id", "missing_fk_field", "fk_value")


@query("pending_by_entity", f"SELECT missing_entity, count(*) AS n FROM ({_PENDING}) GROUP BY 1")
def pending_by_entity(spark, sf_dir):
    return S.open_pendencies(line_pendencies(spark, sf_dir))


@query("fk_resolve_arrivals", f"""WITH p AS ({_PENDING}), d AS (SELECT raw_data_id, missing_entity = 'orders' AND fk_value::BIGINT % 22 = 0 AS resolved FROM p)
       SELECT raw_data_id, bool_and(resolved) AS ready FROM d GROUP BY 1""")
def fk_resolve_arrivals(spark, sf_dir):
    arrived = table(spark, sf_dir, "orders").filter("o_orderkey % 22 = 0").select("o_orderkey", F.concat(F.lit("o"), "o_orderkey").alias("raw_data_id"))
    return K.all_resolved(K.resolve_pendencies(line_pendencies(spark, sf_dir), arrived, "orders", "o_orderkey", F.lit("2024-01-02").cast("timestamp")))


@query("fk_merge", """SELECT o_orderkey, coalesce(n, 0) AS n, coalesce(items, '') AS items FROM orders LEFT JOIN (
       SELECT l_orderkey, count(*) AS n, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS items FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) ON o_orderkey = l_orderkey""")
def fk_merge(spark, sf_dir):
    waiting = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_partkey", "l_orderkey", "l_returnflag")
    r = K.merge_waiting(table(spark, sf_dir, "orders"), "o_orderkey", waiting, "l_orderkey", "lineitem", F.col("l_returnflag") != "N")
    line = F.transform("lineitem", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"]))
    return r.select("o_orderkey", F.size("lineitem").cast("long").alias("n"), F.array_join(line, ",").alias("items"))


_NEEDS = "CASE WHEN p_partkey % 50 = 1 THEN p_partkey WHEN p_partkey % 5 <> 0 THEN p_partkey - 7 END"


@query("fk_closure", f"""WITH RECURSIVE n AS (SELECT p_partkey AS id, {_NEEDS} AS ref FROM part),
       r(id, depth) AS (SELECT id, 0 FROM n WHERE ref IS NULL UNION ALL SELECT n.id, depth + 1 FROM n JOIN r ON n.ref = r.id WHERE depth < 20) SELECT id, depth FROM r""")
def fk_closure(spark, sf_dir):
    n = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr(_NEEDS).alias("ref"))
    return K.closure(n.select("id"), n, most=20)


@query("fk_enrich_open", """WITH o AS (SELECT * FROM orders WHERE o_orderkey % 11 <> 0 AND o_custkey % 5 <> 0)
       SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderkey IS NULL AS waits FROM lineitem LEFT JOIN o ON l_orderkey = o_orderkey""")
def fk_enrich_open(spark, sf_dir):
    rows, refs = line_parts(spark, sf_dir)
    deps = LINE_DEPS[:1]
    refs = {"orders": refs["orders"].withColumn("raw_data_id", F.concat(F.lit("o"), "o_orderkey"))}
    # Orders of every fifth customer wait themselves.
    waiting = K.pendencies(refs["orders"], "raw_data_id", {"customer": table(spark, sf_dir, "customer").filter("c_custkey % 5 <> 0")}, [K.Dependency("orders", "customer", "o_custkey", "c_custkey")], F.current_timestamp())
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    late = K.pendencies(rows.withColumn("row_id", row_id), "row_id", refs, deps, F.current_timestamp(), waiting).select(F.col("raw_data_id").alias("row_id")).distinct()
    found = K.enrich(rows, refs, deps, "o_orderkey", waiting).withColumn("row_id", row_id).join(late.withColumn("late", F.lit(True)), "row_id", "left")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "orders.o_custkey", F.coalesce("late", F.lit(False)).alias("waits"))


@query("fk_gate", """WITH rg AS (SELECT * FROM region WHERE r_regionkey <> 2), na AS (SELECT n.*, r_regionkey IS NOT NULL AS ok FROM nation n LEFT JOIN rg ON n_regionkey = r_regionkey),
       cu AS (SELECT c.*, coalesce(na.ok, false) AS ok FROM (SELECT * FROM customer WHERE c_custkey % 17 <> 0) c LEFT JOIN na ON c_nationkey = n_nationkey),
       od AS (SELECT o.*, coalesce(cu.ok, false) AS ok FROM orders o LEFT JOIN cu ON o_custkey = c_custkey)
       SELECT 'region' AS entity, 'region:' || r_regionkey AS id, true AS ready FROM rg UNION ALL SELECT 'nation', 'nation:' || n_nationkey, ok FROM na
       UNION ALL SELECT 'customer', 'customer:' || c_custkey, ok FROM cu UNION ALL SELECT 'orders', 'orders:' || o_orderkey, ok FROM od""")
def fk_gate(spark, sf_dir):
    get = lambda t, key: table(spark, sf_dir, t).withColumn("raw_id", F.col(key))
    records = {"region": get("region", "r_regionkey").filter("r_regionkey <> 2"), "nation": get("nation", "n_nationkey"),
               "customer": get("customer", "c_custkey").filter("c_custkey % 17 <> 0"), "orders": get("orders", "o_orderkey")}
    deps = [K.Dependency("nation", "region", "n_regionkey", "r_regionkey", True), K.Dependency("customer", "nation", "c_nationkey", "n_nationkey"), K.Dependency("orders", "customer", "o_custkey", "c_custkey", True)]
    ready, pending = K.gate(records, "raw_id", deps)
    return ready.withColumn("ready", F.lit(True)).unionByName(pending.withColumn("ready", F.lit(False)))


# Cache -----------------------------------------------------------------------------------


def requests(spark, sf_dir):
    """Events as requests; the order of the settings differs from row to row."""
    a, b = [F.lit("portal"), F.col("event_type")], [F.lit("user"), (F.col("user_id") % 40).cast("string")]
    flags = F.when(F.col("event_id") % 10 == 0, F.create_map(F.lit("no_cache"), F.lit("true"))).when(F.col("event_id") % 10 == 1, F.create_map(F.lit("use_cache"), F.lit("false"))).otherwise(F.create_map().cast("map<string,string>"))
    config = F.when(F.col("event_id") % 2 == 0, F.create_map(*a, *b)).otherwise(F.create_map(*b, *a))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.map_concat(config, flags).alias("config"))


@query("collect_cache", """WITH r AS (SELECT event_id, event_type || '/' || user_id % 40 AS c FROM events), k AS (SELECT event_type || '/' || user_id % 40 AS c, min(lpad(event_id::VARCHAR, 8, '0')) AS collect_id FROM events WHERE value > 30 GROUP BY 1)
       SELECT event_id AS request_id, CASE WHEN event_id % 10 = 1 THEN 'bypass' WHEN event_id % 10 = 0 THEN 'miss' WHEN collect_id IS NULL THEN 'miss' ELSE 'hit' END AS action,
       CASE WHEN event_id % 10 > 1 THEN collect_id END AS collect_id FROM r LEFT JOIN k USING (c)""")
def collect_cache(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("value > 30")
    configs = e.select(F.lpad(F.col("event_id").cast("string"), 8, "0").alias("collect_id"), F.create_map(F.lit("user"), (F.col("user_id") % 40).cast("string"), F.lit("portal"), F.col("event_type"), F.lit("depth"), F.lit("3")).alias("config"))
    return C.lookup(requests(spark, sf_dir), configs).select("request_id", "action", "collect_id")


@query("cache_republish", """WITH k AS (SELECT event_type AS c, min(event_id) AS f FROM events GROUP BY 1) SELECT k.f AS request_id, e.event_type AS collect_id, 'e' || e.event_id AS raw_data_id, CASE WHEN e.event_id % 2 = 0 THEN 'pncp' ELSE 'dom' END AS data_source
       FROM events e JOIN k ON e.event_type = k.c""")
def cache_republish(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    records = e.select(F.col("event_type").alias("collect_id"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("e"), "event_id")).alias("raw_data_id"), F.concat(F.lit("e"), "event_id").alias("_id"), F.when(F.col("event_id") % 2 == 1, "dom").alias("data_source"))
    hits = e.groupBy(F.col("event_type").alias("collect_id")).agg(F.min("event_id").alias("request_id"))
    return C.republish(hits, records, "PNCP").select("request_id", "collect_id", "raw_data_id", "data_source")


# Sources and sinks ----------------------------------------------------------------------------


@query("scan_json_dir", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_json_dir(spark, sf_dir):
    path, docs = shared_dir(spark), table(spark, sf_dir, "documents")
    # Files of one array each, a few hundred records long, in folders below the one that is scanned.
    arrays = docs.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(docs.count() // 200 + 1)).alias("part")).agg(F.to_json(F.collect_list(F.struct(*docs.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return A.scan_json(spark, path, "doc_id long, text string, lang string, source string, n_chars long", "*.txt").filter("_bad is null").drop("_bad")


@query("sink_partitioned_json", "SELECT source AS portal, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1")
def sink_partitioned_json(spark, sf_dir):
    path = shared_dir(spark)
    A.save_by_portal(table(spark, sf_dir, "documents").withColumnRenamed("source", "portal"), path)
    back = spark.read.schema("doc_id long, text string, lang string, n_chars long, portal string").json(path)
    return back.groupBy("portal").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("raw_landing", """SELECT doc_id, 'run-1' AS collect_id, 'noticias' AS data_source, 'noticias.' || lang AS raw_data_collection, sha256(doc_id || chr(31) || source) AS raw_data_id, lang AS entity_type FROM documents""")
def raw_landing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("entity_type"))
    path = shared_dir(spark)
    for _ in range(2):  # a job done again lands nothing twice
        LA.land(LA.stamp(docs, "Noticias", "run-1", ["doc_id", "source"]), path)
    return LA.collections_of(spark, path, "noticias").select("doc_id", "collect_id", "data_source", "raw_data_collection", "raw_data_id", "entity_type")


@query("append_checked", "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def append_checked(spark, sf_dir):
    path, schema = shared_dir(spark), {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double", "c_note": "string"}
    c = table(spark, sf_dir, "customer")
    T.append_checked(c, path, schema)
    T.append_checked(c.filter("c_custkey % 2 = 0").withColumn("other", F.lit(1)), path, schema, ["c_custkey", "c_name", "c_acctbal"])
    return spark.read.parquet(path)


@query("ref_csv", "SELECT n_nationkey, n_name, n_regionkey, 2020 + n_regionkey % 2 AS year FROM nation WHERE n_regionkey % 2 = 1")
def ref_csv(spark, sf_dir):
    path = shared_dir(spark)
    n = table(spark, sf_dir, "nation").withColumn("year", 2020 + F.col("n_regionkey") % 2)
    n.write.option("header", True).partitionBy("year").csv(path)
    return T.reference(spark, path, "n_nationkey int, n_name string, n_regionkey int, year int", 2021)


# Pages -----------------------------------------------------------------------------------------

_BODY = r"regexp_replace(html, '(?is)<script[^>]*>.*?</script\s*>|<style[^>]*>.*?</style\s*>|<!--.*?-->', '', 'g')"
CONFIG = {"*": {"article_selectors": {"title": {"tag": "h1"}, "content": {"tag": "article", "find_all": ["p", "h2", "h3"]}, "date": [{"tag": "time", "attribute": "datetime"}, {"attrs": {"class": "date"}}]}}}


def pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", "html", text.portal_of_url(F.col("url")).alias("portal"), (F.col("page_id") % 100).cast("int").alias("page_number"))


@query("page_links", rf"""WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') AS base, unnest(regexp_extract_all({_BODY}, '<a[^>]*href="([^"]*)"', 1)) AS href FROM pages),
       f AS (SELECT page_id, href, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href WHEN starts_with(href, '/') THEN base || href ELSE base || '/' || href END AS url FROM h)
       SELECT DISTINCT page_id, split_part(url, '?', 1) AS url FROM f WHERE starts_with(href, '/t') OR starts_with(href, '/e')""")
def page_links(spark, sf_dir):
    found = H.links(table(spark, sf_dir, "pages"), F.col("url"))
    return found.filter(F.regexp_extract("url", "^[a-z]+://[^/?#]+/([te])", 1) != "")


@query("page_titles", rf"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_extract({_BODY}, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')), ''), 'sem-titulo') AS title FROM pages""")
def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.title(F.col("html")).alias("title"))


_AHEAD = """'<a href="/categoria/obras">Licitações e obras da cidade</a><a href="#top">Voltar ao começo desta página</a><a href="x.html">Um endereço sem barra no começo</a><a href="/n/' || page_id || '">Prefeitura abre licitação &amp; obra ' || page_id || '</a>'"""


@query("page_main_link", rf"""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') AS base, CASE WHEN page_id % 2 = 0 THEN {_AHEAD} ELSE '' END || html AS html FROM pages),
       h AS (SELECT page_id, base, regexp_extract_all({_BODY}, '(?s)<a[^>]*href="[^"]*"[^>]*>.*?</a>') AS l FROM p), e AS (SELECT page_id, base, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM h),
       t AS (SELECT page_id, base, pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(a, '<[^>]+>', '', 'g')) AS t FROM e),
       u AS (SELECT page_id, pos, CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN base || href END AS url FROM t
             WHERE len(replace(t, '&amp;', '&')) > 20 AND NOT regexp_matches(lower(href), 'javascript:|#|mailto:|categoria|category|tag|author|page|pagina') AND NOT regexp_matches(lower(t), 'menu|contato|sobre|anuncie|assine|login|buscar'))
       SELECT page_id, arg_min(url, pos) AS url FROM u WHERE url IS NOT NULL GROUP BY 1""")
def page_main_link(spark, sf_dir):
    ahead = F.when(F.col("page_id") % 2 == 0, F.expr(_AHEAD)).otherwise("")
    return H.main_link(table(spark, sf_dir, "pages").withColumn("html", F.concat(ahead, "html")))


@query("html_clean", r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'),
       '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13) || chr(160)) AS cleaned FROM pages""")
def html_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_html(F.col("html")).alias("cleaned"))


@query("page_content")
def page_content(spark, sf_dir):
    return H.articles(pages(spark, sf_dir), CONFIG).select("page_id", "text")


@query("article_extract")
def article_extract(spark, sf_dir):
    return H.articles(pages(spark, sf_dir), CONFIG).drop("date_extraction")


@query("html_first_words")
def html_first_words(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.first_words(F.col("html")).alias("head"))


@query("page_profile")
def page_profile(spark, sf_dir):
    return H.proposals(H.profiles(table(spark, sf_dir, "pages")))


# Graph -----------------------------------------------------------------------------------------


@query("eav_unpivot", """SELECT c_custkey, unnest(['c_name', 'c_nationkey', 'c_mktsegment']) AS attribute_name, unnest([c_name, c_nationkey::VARCHAR, c_mktsegment]) AS attribute_value FROM customer""")
def eav_unpivot(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.lit(1).alias("id_other"))
    return G.unpivot_attributes(c, "c_custkey")


@query("object_upsert", "SELECT 'customer' AS class, c_custkey AS id_object, CASE WHEN c_custkey % 2 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS date_updated FROM customer")
def object_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.select(F.lit("customer").alias("class"), F.col("c_custkey").alias("id_object"), F.lit("2024-01-01").alias("date_updated"))
    new = c.filter("c_custkey % 2 = 0").select(F.lit(" Customer ").alias("class"), F.col("c_custkey").alias("id_object"), F.lit("2024-02-01").alias("date_updated"))
    return G.upsert_objects(old, new)


_ATTR = """(WITH o AS (SELECT user_id AS id_object, event_type AS attribute_name, 'a' AS id_source, max(value)::VARCHAR AS v FROM events GROUP BY 1, 2),
       n AS (SELECT user_id AS id_object, event_type AS attribute_name, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'unknown' END AS id_source, 'e' || event_id AS attribute_value, epoch_us(ts) AS d FROM events WHERE event_id % 7 <> 0),
       l AS (SELECT id_object, attribute_name, id_source, arg_max(attribute_value, (d, attribute_value)) AS attribute_value FROM n GROUP BY 1, 2, 3)
       SELECT id_object, attribute_name, id_source, coalesce(l.attribute_value, 'old') AS attribute_value FROM o FULL JOIN l USING (id_object, attribute_name, id_source))"""


def attributes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    old = e.select(F.col("user_id").alias("id_object"), F.col("event_type").alias("attribute_name"), F.lit("A").alias("id_source"), F.lit("old").alias("attribute_value"), F.lit("2023-01-01").cast("timestamp_ntz").alias("date_updated")).distinct()
    new = e.select(F.col("user_id").alias("id_object"), F.col("event_type").alias("attribute_name"), F.when(F.col("event_id") % 2 == 0, "a").otherwise("").alias("id_source"),
                   F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("e"), "event_id")).otherwise("").alias("attribute_value"), F.col("ts").alias("date_updated"))
    return G.upsert_attributes(old, new).select("id_object", "attribute_name", "id_source", "attribute_value")


@query("attribute_upsert", f"SELECT * FROM {_ATTR}")
def attribute_upsert(spark, sf_dir):
    return attributes(spark, sf_dir)


@query("object_attributes", f"""SELECT id_object, string_agg(attribute_name || '=' || v, ',' ORDER BY attribute_name) AS attributes FROM (SELECT id_object, attribute_name, arg_max(attribute_value, id_source) AS v FROM {_ATTR} GROUP BY 1, 2) GROUP BY 1""")
def object_attributes(spark, sf_dir):
    r = G.object_attributes(attributes(spark, sf_dir))
    line = F.transform(F.map_entries("attributes"), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return r.select("id_object", F.array_join(line, ",").alias("attributes"))


@query("relate_edges", """WITH g AS (SELECT l_orderkey, list('#1:' || l_partkey ORDER BY l_linenumber, l_partkey) AS p, list(DISTINCT '#2:' || l_suppkey) AS s FROM lineitem GROUP BY 1),
       pairs AS (SELECT unnest(p) AS src, l_orderkey, s FROM g), e AS (SELECT DISTINCT src, unnest(s) AS dst FROM pairs)
       SELECT src, dst FROM e WHERE (src, dst) NOT IN (SELECT DISTINCT '#1:' || l_partkey, '#2:' || l_suppkey FROM lineitem WHERE l_linenumber = 1)""")
def relate_edges(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    # The second list has one entry more, a malformed one, so that lists are never of equal length by chance.
    # Numbers are gathered and made ids behind the shuffle, where they are more bytes.
    ids = lambda c, before: F.transform(c, lambda x: F.concat(F.lit(before), x.cast("string")))
    rows = l.groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("p"), F.collect_set("l_suppkey").alias("s")).withColumns({"p": ids("p", "#1:"), "s": ids("s", "#2:")})
    rows = rows.withColumn("s", F.concat("s", F.transform(F.sequence(F.lit(1), F.size("p") + 1), lambda i: F.lit("bad"))))
    old = l.filter("l_linenumber = 1").select(F.concat(F.lit("#1:"), "l_partkey").alias("src"), F.concat(F.lit("#2:"), "l_suppkey").alias("dst")).distinct()
    return G.relate(rows, "p", "s", F.lit("x"), old).select("src", "dst")


def order_graph(spark, sf_dir):
    v = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), "c_mktsegment")
    e = table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("o"), "o_orderkey").alias("dst"), F.lit("placed").alias("class"))
    return v, e


@query("neighbours", "SELECT 'c' || o_custkey AS id, 'out' AS direction, 'o' || o_orderkey AS neighbour FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'o' || o_orderkey, 'in', 'c' || o_custkey FROM orders")
def neighbours(spark, sf_dir):
    v, e = order_graph(spark, sf_dir)
    return G.neighbours(v.select("id").unionByName(e.select(F.col("dst").alias("id"))), e)


@query("vertex_find", "SELECT 'c' || c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'")
def vertex_find(spark, sf_dir):
    return G.find_vertices(order_graph(spark, sf_dir)[0], c_mktsegment="BUILDING").select("id")


@query("vertex_delete", "SELECT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IS DISTINCT FROM 'BUILDING'")
def vertex_delete(spark, sf_dir):
    v, e = order_graph(spark, sf_dir)
    return G.delete_vertices(v, e, G.find_vertices(v, c_mktsegment="BUILDING"))[1].select("src", "dst")


# Models and pipelines -------------------------------------------------------------------------------


def labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return table(spark, sf_dir, "documents").join(labels, "doc_id")


@query("classify_docs")
def classify_docs(spark, sf_dir):
    return M.classify(M.fit_classifier(labelled(spark, sf_dir)), table(spark, sf_dir, "documents")).select("doc_id", F.col("prediction").cast("int").alias("prediction"))


@query("classify_vectors")
def classify_vectors(spark, sf_dir):
    """Embeddings by an SVM that has not seen them: every fourth row, by the hash of its id, is held out of the fit."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("label"))
    held = F.crc32(F.col("vec_id").cast("string").cast("binary")) % 4 == 2
    size = e.select(F.max(F.size("embedding"))).first()[0]
    model = M.fit_vector_classifier(e.filter(~held), size)
    return M.classify_vectors(model, e, size).select("vec_id", held.alias("held_out"), "label", F.col("prediction").cast("int").alias("prediction"))


@query("landing_statistics", """WITH d AS (SELECT source AS portal, count(*) AS n FROM documents GROUP BY 1) SELECT 'portal' AS kind, portal AS name, n FROM d UNION ALL SELECT 'documents', NULL, sum(n)::BIGINT FROM d
       UNION ALL SELECT 'portals', NULL, count(*) FROM d UNION ALL SELECT 'collection', 'run-1', sum(n)::BIGINT FROM d UNION ALL SELECT 'date', '2024-01-01', sum(n)::BIGINT FROM d""")
def landing_statistics(spark, sf_dir):
    """What the flow reports of the articles that it has landed."""
    articles, path = flow_parts(spark, sf_dir)[0], shared_dir(spark)
    LA.land(LA.stamp(articles, "Noticias", "run-1", ["url"]), path)
    s = P.statistics(LA.collections_of(spark, path, "noticias"))
    row = lambda df, kind, name, n: df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), F.col(n).alias("n"))
    return row(s["by_portal"], "portal", F.col("portal"), "n").unionByName(row(s["totals"], "documents", F.lit(None), "documents")).unionByName(row(s["totals"], "portals", F.lit(None), "portals")).unionByName(
        row(s["by_collect"], "collection", F.col("collect_id"), "n")).unionByName(row(s["recent_dates"], "date", F.col("date"), "n"))


@query("fraud_gate")
def fraud_gate(spark, sf_dir):
    return classify_docs(spark, sf_dir).filter("prediction = 1")


def names(spark, sf_dir):
    """Benchmark sentences' beginnings and nations as the dictionary of places."""
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()


def tender_texts(spark, sf_dir):
    """Documents with a sentence on a tender behind them."""
    part, k = table(spark, sf_dir, "part"), F.col("doc_id")
    n = part.select((F.col("p_partkey") - 1).alias("_k"), "p_name")
    forms = F.element_at(F.array(*map(F.lit, M.MODALITIES)), (k % len(M.MODALITIES) + 1).cast("int"))
    tail = F.concat(F.lit("\nO "), forms, F.lit(" em "), F.coalesce("p_name", F.lit("lugar nenhum")), F.lit(", edital nº 0"), k.cast("string"), F.lit(" de 2023, tem como objeto: compra de item "), k.cast("string"), F.lit(" novo."))
    return table(spark, sf_dir, "documents").join(n, k == F.col("_k"), "left").select("doc_id", "source", F.concat(F.coalesce("text", F.lit("")), tail).alias("text"))


_FORMS = ", ".join(f"('{a}', '{b}')" for a, b in M.MODALITIES.items())


@query("extract_entities", f"""WITH f AS (SELECT form, name, row_number() OVER () - 1 AS k FROM (VALUES {_FORMS}) v(form, name)),
       d AS (SELECT doc_id, f.form, f.name AS modalidade, p_name FROM documents JOIN f ON f.k = doc_id % {len(M.MODALITIES)} LEFT JOIN part ON p_partkey - 1 = doc_id)
       SELECT doc_id, coalesce(p_name, '') AS municipio, modalidade, doc_id || '/2023' AS edital FROM d""")
def extract_entities(spark, sf_dir):
    r = M.extract(tender_texts(spark, sf_dir), "doc_id", "text", names(spark, sf_dir))
    line = lambda c: F.array_join(c, "|").alias(c)
    return r.select("doc_id", line("municipio"), line("modalidade"), line("edital"))


def processed(spark, sf_dir):
    docs = tender_texts(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("raw_data_id"), "text", F.substring("text", 1, 60).alias("title"), F.concat(F.lit("https://www.p.example/"), "doc_id").alias("url"),
        F.col("source").alias("portal"), F.lit(None).cast("string").alias("chamada"), F.lit("2024-01-01").cast("date").alias("date_publication"),
    )
    return P.process(docs, M.fit_classifier(labelled(spark, sf_dir)), names(spark, sf_dir), "noticias", keep=stored)


@query("process_articles")
def process_articles(spark, sf_dir):
    r = processed(spark, sf_dir)
    return r.select("raw_data_id", "data_source", "noticia.numero_edital", "noticia.objeto", "noticia.nome_portal", F.col("municipio.nome_municipio").alias("municipio"), F.col("modalidade_licitacao.descricao").alias("modalidade"))


@query("pipeline_summary")
def pipeline_summary(spark, sf_dir):
    good, failed = P.verified(stored(processed(spark, sf_dir)))
    return good.groupBy(F.col("noticia.nome_portal").alias("portal")).agg(F.count("*").alias("verified"), F.count("noticia.numero_edital").alias("with_edital"), F.count("municipio").alias("with_place")).join(
        failed.groupBy(F.col("noticia.nome_portal").alias("portal")).agg(F.count("*").alias("failed")), "portal", "full"
    )


def flow_parts(spark, sf_dir):
    """Articles on tenders, and the tables that they are linked to: orders as tenders, their part as the place.

    Article k names the place of part k + 1, a modality, and its number ``k/2023``; tender k has the same number
    but for every fifth; every seventh article has no title, every eleventh place is not in the catalogue.
    """
    k, part = F.col("doc_id"), table(spark, sf_dir, "part")
    articles = tender_texts(spark, sf_dir).select(
        F.concat(F.lit("https://www.p.example/"), "doc_id").alias("url"), F.when(k % 7 != 0, F.concat(F.lit("Licitação "), k.cast("string"))).alias("title"), "text",
        F.col("source").alias("portal"), F.lit(None).cast("string").alias("chamada"), F.lit("2024-01-01").cast("date").alias("date_publication"),
    )
    names = part.groupBy(F.col("p_name").alias("nome_municipio")).agg(F.min("p_partkey").alias("id_municipio"))
    places = names.filter("id_municipio % 11 <> 0")
    mods = spark.createDataFrame(list(enumerate(sorted(set(M.MODALITIES.values())), 1)), "id_modalidade_licitacao int, descricao string")
    forms = F.create_map(*[F.lit(x) for i, f in enumerate(M.MODALITIES.values()) for x in (i, f)])
    tenders = table(spark, sf_dir, "documents").select("doc_id").join(part.select((F.col("p_partkey") - 1).alias("doc_id"), F.col("p_name").alias("nome_municipio")), "doc_id").join(names, "nome_municipio")
    processes = tenders.withColumn("descricao", F.element_at(forms, (k % len(M.MODALITIES)).cast("int"))).join(F.broadcast(mods), "descricao").select(
        k.alias("id_processo_licitatorio"), F.when(k % 5 == 0, F.concat(F.lit("X"), k * 7 + 900001, F.lit("/1999"))).otherwise(F.concat(k, F.lit("/2023"))).alias("numero_edital"),
        "id_modalidade_licitacao", F.col("id_municipio").alias("id_unidade_gestora"))
    units = names.select(F.col("id_municipio").alias("id_unidade_gestora"), F.col("id_municipio").alias("id_ente"))
    bodies = names.select(F.col("id_municipio").alias("id_ente"), "id_municipio")
    texts = names.select(F.col("id_municipio").alias("id_unidade_gestora"), F.concat(F.lit("prefeitura "), "nome_municipio").alias("texto"))
    return articles, (processes, mods, units, bodies, places), texts


def flow(spark, sf_dir):
    articles, catalogue, texts = flow_parts(spark, sf_dir)
    return P.end_to_end(articles, M.fit_classifier(labelled(spark, sf_dir)), names(spark, sf_dir), "Noticias", shared_dir(spark), "run-1", catalogue, texts)


@query("flow_end_to_end")
def flow_end_to_end(spark, sf_dir):
    """Statistics of the whole flow for each portal: what was written back, and how it was linked."""
    out = flow(spark, sf_dir)
    news = out["news"].join(out["links"].select("id_noticia", "status", "n_candidates"), "id_noticia")
    return news.groupBy(F.col("nome_portal").alias("portal")).agg(
        F.count("*").alias("n"), *[F.count_if(F.col("status") == x).alias(x) for x in ("linked", "linked_via_llm", "ambiguous", "no_match")],
        F.count("id_processo_licitatorio").alias("written"), F.count("id_municipio").alias("with_place"),
    )


# Streams -----------------------------------------------------------------------------------------


def as_messages(spark, rows, files=3):
    """Rows as JSON lines in files, as a queue would deliver them."""
    path = shared_dir(spark)
    rows.repartition(files).select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(path)
    return path


def one_file(rows):
    """Rows that one task writes, so that they make one batch; all that goes before runs in as many tasks as ever, which ``coalesce`` would not leave."""
    return rows.repartition(1)


EVENT = "event_id long, event_type string, value double, user_id long"


@query("stream_stage", "SELECT event_id, upper(event_type) AS kind, round(value * 2, 6) AS doubled FROM events")
def stream_stage(spark, sf_dir):
    path, out = as_messages(spark, table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")), shared_dir(spark)
    stage = SS.Stage(lambda df: df.select("event_id", F.upper("event_type").alias("kind"), F.round(F.col("value") * 2, 6).alias("doubled")))
    SS.run(SS.messages(spark, path), EVENT, stage, out, shared_dir(spark))
    return SS.read_out(spark, out, "published")


@query("stream_dead_letters", """SELECT CASE WHEN event_id % 10 = 0 THEN 'unparsable' WHEN value > 50 THEN 'value too large' ELSE 'published' END AS kind, count(*) AS n FROM events GROUP BY 1""")
def stream_dead_letters(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")
    path, out = shared_dir(spark), shared_dir(spark)
    e.repartition(3).select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken "), "event_id")).otherwise(F.to_json(F.struct(*e.columns))).alias("value")).write.text(path)
    stage = SS.Stage(lambda df: df.withColumn("error", F.when(F.col("value") > 50, "value too large")))
    SS.run(SS.messages(spark, path), EVENT, stage, out, shared_dir(spark))
    kinds = [SS.read_out(spark, out, "published").select(F.lit("published").alias("kind")), SS.read_out(spark, out, "failed").select(F.col("error").alias("kind")), SS.read_out(spark, out, "unparsable").select(F.lit("unparsable").alias("kind"))]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).groupBy("kind").agg(F.count("*").alias("n"))


@query("stream_once", "SELECT min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def stream_once(spark, sf_dir):
    """Messages named by user and type that come again in later batches: the first is published, once."""
    e = table(spark, sf_dir, "events").withColumn("raw_data_id", F.concat_ws("/", "user_id", "event_type"))
    path, out = shared_dir(spark), shared_dir(spark)
    first = e.groupBy("raw_data_id").agg(F.min("event_id").alias("event_id"))
    rest = e.select("raw_data_id", "event_id").join(first, ["raw_data_id", "event_id"], "left_anti")
    for rows in (first, rest, first):  # files in this order
        one_file(rows).select(F.to_json(F.struct("raw_data_id", "event_id")).alias("value")).write.mode("append").text(path)
    SS.run(SS.messages(spark, path), "raw_data_id string, event_id long", SS.Stage(lambda df: df.select("event_id", "original_message")), out, shared_dir(spark))
    return SS.read_out(spark, out, "published")


@query("stream_cache", """WITH r AS (SELECT event_type || '/' || user_id % 40 AS asked, event_id % 3 AS batch, bool_or(event_id % 10 = 0) AS anew FROM events WHERE event_id % 10 <> 1 GROUP BY 1, 2)
       SELECT asked, count(*) FILTER (anew OR batch = first)::INT AS configs FROM (SELECT *, min(batch) OVER (PARTITION BY asked) AS first FROM r) GROUP BY 1""")
def stream_cache(spark, sf_dir):
    """All events as requests in three batches: a config is stored when first asked for, and again in each batch that asks for it anew."""
    reqs = requests(spark, sf_dir).select("request_id", F.map_entries("config").alias("config"))
    path, out = shared_dir(spark), shared_dir(spark)
    for k in range(3):  # one file each, in this order
        one_file(reqs.filter(F.col("request_id") % 3 == k)).write.mode("append").parquet(path)
    stream = spark.readStream.schema("request_id long, config array<struct<key:string,value:string>>").option("maxFilesPerTrigger", 1).parquet(path).withColumn("config", F.map_from_entries("config"))
    SC.serve(stream, out, shared_dir(spark), lambda c: c.select("collect_id", F.lit("r").alias("raw_data_id")), buckets=8)
    stored_configs = spark.read.parquet(f"{out}/configs")
    return stored_configs.select(F.concat_ws("/", F.col("config")["portal"], F.col("config")["user"]).alias("asked")).groupBy("asked").agg(F.count("*").cast("int").alias("configs"))


@query("stream_fk", "SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS child_id, o_custkey AS custkey FROM lineitem JOIN (SELECT * FROM orders WHERE o_orderkey % 11 <> 0) ON l_orderkey = o_orderkey")
def stream_fk(spark, sf_dir):
    rows, refs = line_parts(spark, sf_dir)
    kids = rows.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("row_id"), F.col("l_orderkey").cast("string").alias("fk"), F.lit(False).alias("is_parent"), F.lit("{}").alias("body"))
    parents = refs["orders"].select(F.concat(F.lit("o"), "o_orderkey").alias("row_id"), F.col("o_orderkey").cast("string").alias("fk"), F.lit(True).alias("is_parent"), F.to_json(F.struct("o_custkey")).alias("body"))
    path, out = shared_dir(spark), shared_dir(spark)
    kids.unionByName(parents).repartition(2, F.xxhash64("row_id")).write.parquet(path)
    SK.run(spark.readStream.schema("row_id string, fk string, is_parent boolean, body string").option("maxFilesPerTrigger", 1).parquet(path), out, shared_dir(spark))
    return spark.read.schema(SK.OUT).parquet(out).select("child_id", F.get_json_object("parent", "$.o_custkey").cast("long").alias("custkey"))


def record_messages(spark, rows, batches):
    """``entity, id, body`` rows as a stream of so many files, in an order that has nothing to do with their keys."""
    path = shared_dir(spark)
    rows.repartition(batches, F.xxhash64("id")).write.parquet(path)
    return spark.readStream.schema(SR.MESSAGE).option("maxFilesPerTrigger", 1).parquet(path)


def record(entity, id_, *fields):
    return [F.lit(entity).alias("entity"), id_.alias("id"), F.to_json(F.struct(*fields)).alias("body")]


@query("stream_records", """SELECT DISTINCT 'lineitem' AS entity, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, o_custkey AS custkey, p_name AS part FROM lineitem
       JOIN (SELECT * FROM orders WHERE o_orderkey % 11 <> 0) ON l_orderkey = o_orderkey JOIN (SELECT * FROM part WHERE p_partkey % 13 <> 0) ON l_partkey = p_partkey
       UNION ALL SELECT 'orders', o_orderkey::VARCHAR, NULL, NULL FROM orders WHERE o_orderkey % 11 <> 0 UNION ALL SELECT 'part', p_partkey::VARCHAR, NULL, NULL FROM part WHERE p_partkey % 13 <> 0""")
def stream_records(spark, sf_dir):
    """Lines that come in any order with the order and the part that they refer to."""
    rows, refs = line_parts(spark, sf_dir)
    sent = rows.distinct().select(*record("lineitem", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", "l_partkey"))
    sent = sent.unionByName(refs["orders"].select(*record("orders", F.col("o_orderkey").cast("string"), "o_orderkey", "o_custkey")))
    sent = sent.unionByName(refs["part"].select(*record("part", F.col("p_partkey").cast("string"), "p_partkey", "p_name")))
    out = shared_dir(spark)
    SR.run(record_messages(spark, sent, 2), LINE_DEPS, out, shared_dir(spark), parts=1)
    return SR.read_out(spark, out).select("entity", "id", F.get_json_object(F.col("found")["l_orderkey"], "$.o_custkey").cast("long").alias("custkey"), F.get_json_object(F.col("found")["l_partkey"], "$.p_name").alias("part"))


@query("stream_cascade", f"""WITH RECURSIVE n AS (SELECT p_partkey AS id, {_NEEDS} AS ref FROM part), r(id) AS (SELECT id FROM n WHERE ref IS NULL UNION ALL SELECT n.id FROM n JOIN r ON n.ref = r.id) SELECT id FROM r""")
def stream_cascade(spark, sf_dir):
    """Parts that wait for other parts, chains of them; a part just resolved releases its own."""
    parts = table(spark, sf_dir, "part").select(*record("part", F.col("p_partkey").cast("string"), F.col("p_partkey").alias("key"), F.expr(_NEEDS).alias("needs")))
    out = shared_dir(spark)
    SR.run(record_messages(spark, parts, 5), [K.Dependency("part", "part", "needs", "key")], out, shared_dir(spark))
    return SR.read_out(spark, out).select(F.col("id").cast("long").alias("id"))


@query("stream_link", f"{LINKED} SELECT * FROM linked WHERE id_noticia % 3 <> 0")
def stream_link(spark, sf_dir):
    news = standin(spark, sf_dir)[0]
    ids = F.when(F.col("id_noticia") % 2 == 0, F.format_string('{"inserted_ids":{"noticia":%d}}', "id_noticia")).otherwise(F.format_string('{"data":{"insert":{"noticia":%d}}}', "id_noticia"))
    events = news.select(F.when(F.col("id_noticia") % 3 == 0, "update.noticias").otherwise("insert.noticias").alias("routing_key"), ids.alias("ids_gerados_db"))
    path, out = shared_dir(spark), shared_dir(spark)
    events.repartition(2).write.parquet(path)
    cands, objects = (stored(df) for df in info(spark, sf_dir))

    def link(wanted):
        own = cands.join(wanted, "id_noticia", "left_semi")
        return L.decide(wanted, own, L.disambiguate(own, objects))

    bindings = spark.createDataFrame([("linker", "insert.noticias")], "queue string, binding string")
    SL.run(spark.readStream.schema(SL.EVENT).option("maxFilesPerTrigger", 1).parquet(path), "linker", bindings, link, out, shared_dir(spark))
    return spark.read.parquet(out).drop("batch")
