"""Queries of statistics, filters, routing, documents and typed rows."""

from pyspark.sql import functions as F

from garimpo.functions import text
from garimpo.operators import documents as D
from garimpo.operators import filters as P
from garimpo.operators import stats as S
from garimpo.plans.tables import table
from garimpo.registry import query

def day():
    return F.to_date("ts")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def dated(docs):
    """A publication day for documents, from their id."""
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 90).cast("int"))


@query("stats_totals", "SELECT count(*) AS documents, count(DISTINCT coalesce(portal, '')) AS portals, count(DISTINCT source || '.' || lang) AS collections FROM (SELECT *, CASE WHEN doc_id % 9 <> 0 THEN source END AS portal FROM documents)")
def stats_totals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("portal", F.when(F.col("doc_id") % 9 != 0, F.col("source")))
    return S.totals(docs, "portal", F.concat_ws(".", "source", "lang"))


@query("stats_by_portal", "SELECT source AS portal, count(*) AS n, min(d)::VARCHAR AS first_date, max(d)::VARCHAR AS last_date FROM (SELECT source, DATE '2024-01-01' + (doc_id % 90)::INTEGER AS d FROM documents) GROUP BY 1")
def stats_by_portal(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = S.by_portal(docs.withColumn("portal", F.col("source")), "portal", dated(docs))
    return out.select("portal", "n", F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date"))


@query("stats_recent_dates", "SELECT ts::DATE::VARCHAR AS date, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 10")
def stats_recent_dates(spark, sf_dir):
    return S.recent_dates(events(spark, sf_dir), day()).select(F.col("date").cast("string").alias("date"), "n")


@query("stats_by_collect", "SELECT user_id, arg_min(event_type, event_id) AS portal, count(*) AS n, epoch_us(min(ts)) AS began FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def stats_by_collect(spark, sf_dir):
    return S.by_collect(events(spark, sf_dir), "user_id", "event_type", "ts", "event_id").withColumn("began", F.unix_micros(F.col("began").cast("timestamp")))


@query("portal_report", """WITH o AS (SELECT * FROM events WHERE event_type = 'click'), d AS (SELECT ts::DATE AS k, count(*) AS n FROM o GROUP BY 1), c AS (SELECT user_id AS k, count(*) AS n FROM o GROUP BY 1)
       SELECT 'click' AS portal, (SELECT count(*) FROM o) AS total, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM d) AS dates, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM c) AS collections
       WHERE EXISTS (SELECT 1 FROM o)""")
def portal_report(spark, sf_dir):
    r = S.portal_report(events(spark, sf_dir), "event_type", "click", day(), "user_id")
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["k"].cast("string"), F.lit("="), x["n"].cast("string"))), ",").alias(c)
    return r.select("portal", "total", line("dates"), line("collections"))


@query("first_last", "SELECT event_type, arg_min(event_id, (ts, event_id)) AS first_id, arg_max(event_id, (ts, event_id)) AS last_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1")
def first_last(spark, sf_dir):
    r = S.first_last(events(spark, sf_dir), "event_type", "ts", "event_id", ["event_id", "value"])
    return r.select("event_type", F.col("first.event_id").alias("first_id"), F.col("last.event_id").alias("last_id"), F.col("first.value").alias("first_value"), F.col("last.value").alias("last_value"))


@query("portal_list", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def portal_list(spark, sf_dir):
    return S.portals(events(spark, sf_dir), "event_type")


@query("collection_counts", "SELECT event_type, 'u' || user_id % 5 AS entity, count(*) AS n, array_to_string(list_sort(json_keys(arg_min(props, event_id))), ',') AS sample_keys FROM events GROUP BY 1, 2")
def collection_counts(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("entity", F.concat(F.lit("u"), (F.col("user_id") % 5).cast("string")))
    return S.collection_counts(e, "event_type", "entity", "event_id", "props")


@query("connected_count", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') ON c_custkey = o_custkey GROUP BY 1")
def connected_count(spark, sf_dir):
    from garimpo.operators import graph as G

    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    edges = o.select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.lit("placed").alias("class"))
    targets = o.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    return G.connected_count(c.select(F.col("c_custkey").alias("id")), edges, targets).withColumnRenamed("id", "c_custkey")


_FKS = (("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
        ("customer.c_nationkey", "customer", "c_nationkey", "nation", "n_nationkey"), ("supplier.s_nationkey", "supplier", "s_nationkey", "nation", "n_nationkey"),
        ("nation.n_regionkey", "nation", "n_regionkey", "region", "r_regionkey"), ("labels.doc_id", "labels", "doc_id", "documents", "doc_id"))


@query("fk_profile", " UNION ALL ".join(f"SELECT '{n}' AS fk, count(*) AS rows, count({pk}) AS matched, count(*) FILTER (WHERE {fk} IS NOT NULL AND {pk} IS NULL) AS orphans, count(*) FILTER (WHERE {fk} IS NULL) AS nulls FROM (SELECT t.{fk} AS {fk}, r.k AS {pk} FROM {t} t LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {r}) r ON t.{fk} = r.k)" if fk != pk else f"SELECT '{n}' AS fk, count(*) AS rows, count(k) AS matched, count(*) FILTER (WHERE {fk} IS NOT NULL AND k IS NULL) AS orphans, count(*) FILTER (WHERE {fk} IS NULL) AS nulls FROM (SELECT t.{fk}, r.k FROM {t} t LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {r}) r ON t.{fk} = r.k)" for n, t, fk, r, pk in _FKS))
def fk_profile(spark, sf_dir):
    return S.fk_profile([(n, table(spark, sf_dir, t), fk, table(spark, sf_dir, r), pk) for n, t, fk, r, pk in _FKS])


@query("run_summary", "SELECT event_type, count(*) FILTER (WHERE value <= 100) AS articles, bool_and(value <= 100) AS success, count(*) FILTER (WHERE value > 100) AS errors FROM events GROUP BY 1")
def run_summary(spark, sf_dir):
    return S.run_summary(events(spark, sf_dir), "event_type", F.when(F.col("value") > 100, "too large"))


@query("by_date", "SELECT event_id, event_type FROM events WHERE ts::DATE = DATE '2024-01-05'")
def by_date(spark, sf_dir):
    return P.on_date(events(spark, sf_dir), "ts", "2024-01-05").select("event_id", "event_type")


_PAGED = "(SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) - 1) // 50 AS page FROM events WHERE event_type = 'view')"


def paged(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("event_type").orderBy(F.desc("ts"), "event_id")
    return events(spark, sf_dir).filter("event_type = 'view'").withColumn("page", F.floor((F.row_number().over(w) - 1) / 50).cast("long"))


@query("page_date_profile", f"SELECT page, bool_or(ts::DATE = DATE '2024-01-05') AS has_target, max(ts::DATE)::VARCHAR AS newest, min(ts::DATE)::VARCHAR AS oldest FROM {_PAGED} GROUP BY 1")
def page_date_profile(spark, sf_dir):
    r = P.page_profile(paged(spark, sf_dir), "page", day(), "2024-01-05")
    return r.select("page", "has_target", F.col("newest").cast("string").alias("newest"), F.col("oldest").cast("string").alias("oldest"))


@query("target_page_run", f"""WITH p AS (SELECT page, bool_or(ts::DATE = DATE '2024-01-05') AS hit FROM {_PAGED} GROUP BY 1), h AS (SELECT page, page - row_number() OVER (ORDER BY page) AS run FROM p WHERE hit)
       SELECT page FROM h WHERE run = (SELECT arg_min(run, page) FROM h)""")
def target_page_run(spark, sf_dir):
    return P.target_run(P.page_profile(paged(spark, sf_dir), "page", day(), "2024-01-05"), "page").select("page")


@query("verify_split", """SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'noticia missing' WHEN page_id % 7 = 1 THEN 'titulo missing' END AS error,
       CASE WHEN page_id % 7 > 1 AND page_id % 5 = 0 OR page_id % 7 = 1 AND page_id % 5 = 0 THEN 'link missing' END AS warning FROM pages""")
def verify_split(spark, sf_dir):
    n = F.struct(F.when(F.col("page_id") % 5 != 0, F.col("url")).alias("link"), F.when(F.col("page_id") % 7 == 1, "").otherwise("t").alias("titulo"))
    records = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 7 != 0, n).alias("noticia"))
    return P.verify(records).select("page_id", "error", "warning")


BINDINGS = [("linker", "insert.*"), ("audit", "#"), ("errors", "error.#"), ("users", "*.u1.#"), ("clicks", "click.u2")]


@query("topic_route", """WITH m AS (SELECT event_id, event_type || '.u' || user_id % 4 AS k FROM events) SELECT event_id, unnest(['audit']) AS queue FROM m
       UNION ALL SELECT event_id, 'errors' FROM m WHERE starts_with(k, 'error') UNION ALL SELECT event_id, 'users' FROM m WHERE ends_with(k, '.u1') UNION ALL SELECT event_id, 'clicks' FROM m WHERE k = 'click.u2'""")
def topic_route(spark, sf_dir):
    m = events(spark, sf_dir).select("event_id", F.concat("event_type", F.lit(".u"), (F.col("user_id") % 4).cast("string")).alias("routing_key"))
    return P.route(m, spark.createDataFrame(BINDINGS, "queue string, binding string")).select("event_id", "queue")


@query("route_collection", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'pncp.' || event_type ELSE 'pncp' END AS collection FROM events")
def route_collection(spark, sf_dir):
    c = P.collection_of(F.lit("pncp"), F.col("event_type"), {"pncp": ["click", "view"], "dom": ["ato"]})
    return events(spark, sf_dir).select("event_id", c.alias("collection"))


@query("doc_find", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND value < 20 AND user_id >= 10 ORDER BY event_id LIMIT 25")
def doc_find(spark, sf_dir):
    return D.find(events(spark, sf_dir), {"event_type": "click", "value": {"$lt": 20.0}, "user_id": {"$gte": 10}}, "event_id", 25).select("event_id", "user_id", "value")


@query("doc_update", "SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_nationkey = 3 THEN c_acctbal + 10 ELSE c_acctbal END AS c_acctbal, c_custkey = (SELECT min(c_custkey) FROM customer WHERE c_nationkey = 5) AS first FROM customer")
def doc_update(spark, sf_dir):
    c = D.update(table(spark, sf_dir, "customer"), {"c_nationkey": 3}, {"$set": {"c_mktsegment": "MOVED"}, "$inc": {"c_acctbal": 10.0}})
    c = D.update(c.withColumn("first", F.lit(False)), {"c_nationkey": 5}, {"first": True}, key="c_custkey")
    return c.select("c_custkey", "c_mktsegment", "c_acctbal", "first")


@query("doc_delete", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey <> (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'O')")
def doc_delete(spark, sf_dir):
    o = D.delete(table(spark, sf_dir, "orders"), {"o_orderstatus": "F"})
    return D.delete(o, {"o_orderstatus": "O"}, key="o_orderkey").select("o_orderkey")


@query("retention", "SELECT event_id FROM events WHERE NOT (event_type = 'click' AND ts < (SELECT max(ts) FROM events) - INTERVAL 30 DAY)")
def retention(spark, sf_dir):
    e = events(spark, sf_dir)
    rows = e.select("event_id", (F.col("event_type") == "click").alias("resolved"), F.col("ts").alias("resolved_at"))
    last = e.agg(F.max("ts").alias("last"))
    return D.retained(rows.join(F.broadcast(last), F.lit(True)), F.col("last")).select("event_id")


@query("typed_split", """WITH v AS (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'x' ELSE user_id::VARCHAR END AS user_id, event_type FROM events)
       SELECT event_id, CASE WHEN regexp_full_match(user_id, '[0-9]+') THEN user_id END AS user_id, 'false' AS active, event_type AS extra, CASE WHEN user_id = 'x' THEN 'user_id' ELSE '' END AS errors FROM v""")
def typed_split(spark, sf_dir):
    uid = F.when(F.col("event_id") % 6 == 0, "x").otherwise(F.col("user_id").cast("string"))
    rows = events(spark, sf_dir).select("event_id", F.create_map(F.lit("user_id"), uid, F.lit("active"), F.lit("no"), F.lit("extra"), F.col("event_type")).alias("m"))
    r = D.typed_split(rows, "event_id", "m", {"user_id": "integer", "active": "boolean", "seen": "date"})
    return r.select("event_id", F.col("typed")["user_id"].alias("user_id"), F.col("typed")["active"].alias("active"), F.col("dynamic")["extra"].alias("extra"), F.array_join("errors", ",").alias("errors"))


@query("param_sql", "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice)::DOUBLE AS total FROM orders WHERE o_totalprice > 1000 AND o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1")
def param_sql(spark, sf_dir):
    from garimpo.sources.tables import run_sql

    return run_sql(spark, {"orders": table(spark, sf_dir, "orders")}, """SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM {orders}
        WHERE o_totalprice > :least AND o_orderdate >= :since GROUP BY o_orderstatus""", least=1000, since="1996-01-01")


@query("url_dedupe", "SELECT url, min(page) AS page FROM (SELECT url, page_id AS page FROM pages UNION ALL SELECT url, page_id + 1 FROM pages WHERE page_id % 2 = 0) GROUP BY 1")
def url_dedupe(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("page"))
    again = p.filter("page % 2 = 0").withColumn("page", F.col("page") + 1)
    return D.newest(p.unionByName(again), ["url"], [F.col("page")])


@query("union_collections", "SELECT event_id, user_id, value FROM events WHERE event_type IN ('click', 'view')")
def union_collections(spark, sf_dir):
    from garimpo.sources.landing import union_of

    e = events(spark, sf_dir)
    return union_of([e.filter("event_type = 'click'").select("event_id", "user_id", "value"), e.filter("event_type = 'view'").select("event_id", "value", "user_id")])


@query("missing_days", """WITH d AS (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-10', INTERVAL 1 DAY))::DATE AS day), p AS (SELECT DISTINCT event_type FROM events)
       SELECT event_type AS portal, day::VARCHAR AS day FROM p, d WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = p.event_type AND e.ts::DATE = d.day AND e.event_id % 50 <> 0)""")
def missing_days(spark, sf_dir):
    from garimpo.operators.requests import gaps

    e = events(spark, sf_dir)
    have = e.filter("event_id % 50 <> 0").select(F.col("event_type").alias("portal"), day().alias("day"))
    return gaps(e.select(F.col("event_type").alias("portal")).distinct(), have, "2023-12-25", "2024-02-10").select("portal", F.col("day").cast("string").alias("day"))
