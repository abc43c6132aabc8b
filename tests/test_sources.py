"""Links, page trees, page ranges and runs, landing, vector models and name patterns."""

import json
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from garimpo.operators import filters, linking, models
from garimpo.sources import html, landing
from garimpo.sources.shared import shared_dir

ANCHORS = """<a href='/n/one'>x</a><A HREF="/n/two">x</A><a class=c href=/n/three>x</a><a href="/n/four">x</a><a href="/n/five?x=1#f">x</a><a href="//cdn.x/n/1">x</a>
<a href="../n/2">x</a><a href="n/rel">x</a><a href="?q=1">x</a><a href="/n/a&amp;b">x</a><a name="no">x</a><a href="">x</a><a href="http://[bad/n">x</a><a href="/n/four">again</a>
<a data-href="/n/not">x</a><link href="/n/style"><script>document.write('<a href="/n/script">')</script><!-- <a href="/n/comment"> --><a href="HTTPS://Other.example/n/6">x</a><a href="mailto:a@b">x</a>"""
BASE = "https://p.example/dir/sub/page.html?x=1"


def test_links_of_all_forms():
    want = ["https://p.example/n/one", "https://p.example/n/two", "https://p.example/n/three", "https://p.example/n/four", "https://p.example/n/five", "https://cdn.x/n/1", "https://p.example/dir/n/2",
            "https://p.example/dir/sub/n/rel", "https://p.example/dir/sub/page.html", "https://p.example/n/a&b", "HTTPS://Other.example/n/6", "mailto:a@b"]
    got = html.found_links(html.Page(ANCHORS), BASE, {"tag": "a"})
    assert [x.lower() for x in got] == [x.lower() for x in want]
    assert html.found_links(html.Page(ANCHORS), BASE, {"tag": "a", "href_prefixes": ["https://p.example/n/t", "/n/one"]}) == want[1:3]  # only absolute links are compared
    assert html.found_links(html.Page(ANCHORS), BASE, {"tag": "a", "attrs": {"class": "c"}}) == ["https://p.example/n/three"]


def test_links_by_portal(spark):
    pages = spark.createDataFrame([(1, "p", BASE, ANCHORS), (2, "q", BASE, ANCHORS), (3, "r", BASE, None)], "page_id long, portal string, url string, html string")
    got = html.links(pages, F.col("url"), {"p": {"tag": "a", "attrs": {"class": "c"}}, "*": {"tag": "link"}}).collect()
    assert sorted(map(tuple, got)) == [(1, "https://p.example/n/three"), (2, "https://p.example/n/style")]


def test_main_links(spark):
    text = "Prefeitura abre nova licitação"
    one = lambda a: f"<p>{a}</p>"
    cases = {
        1: (f"<a href='/tag/x'>{text}</a><A HREF=/n/1><b>Prefeitura abre</b> <i>nova licitação</i></A>", "https://p.example/n/1"), 2: (f'<a href="n/1">{text}</a><a href="https://o.example/2">{text}</a>', "https://o.example/2"),
        3: (f'<a href="/n/3">Anuncie {text}</a><a href="/n/x">curto</a>', None), 4: (f'<a href="/CATEGORIA/4">{text}</a><a href="//o.example/4">{text}</a>', "https://p.example//o.example/4"), 5: (None, None),
    }
    pages = spark.createDataFrame([(k, BASE, one(h) if h else None) for k, (h, _) in cases.items()], "page_id long, url string, html string")
    assert {r.page_id: r.url for r in html.main_link(pages).collect()} == {k: u for k, (_, u) in cases.items() if u}


def test_deep_pages_take_linear_time():
    n = 100_000
    t = time.time()
    p = html.Page("<div class=a>" * n + "<p>one<p>two" + "</div>" * n + "<time datetime=2024-01-01>x</time>")
    assert html.content(p, None) == "one\ntwo" and html.profile(p) == (None, ["2024-01-01"], None, []) and p.elements[0].end == n + 2
    assert html.first_date(p, [{"tag": "div", "attrs": {"class": "b"}}, {"tag": "time"}]) == "x" and time.time() - t < 30


def test_article_fields_and_page_ranges(spark):
    page = "<h1>T</h1><h2 class=sub>S &amp; s</h2><article><p>one<p>two</p></article><p>outside</p><time datetime=''></time><span class=d>24/07/2025 - 10:00</span>"
    sel = {"title": {"tag": "h1"}, "subtitle": {"tag": "h2", "attrs": {"class": "sub"}}, "content": {"tag": "article", "find_all": ["p"]}, "date": [{"tag": "time", "attribute": "datetime"}, {"tag": "span", "attrs": {"class": "d"}}]}
    table = spark.createDataFrame([("a", json.dumps({"min_page": 2, "max_page": 3, "article_selectors": sel, "date_parser": "dmy"})), ("b", json.dumps({"max_page": 1, "article_selectors": sel | {"content": {"tag": "nav"}}}))], "portal string, config string")
    config = html.configuration(table)
    pages = spark.createDataFrame([(k, f"u{k}", page, portal, n) for k, (portal, n) in enumerate([("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2), ("c", 1), ("a", None)])], "page_id long, url string, html string, portal string, page_number int")
    got = {r.page_id: r for r in html.articles(pages, config).collect()}
    assert set(got) == {1, 2, 4, 7}
    r = got[1]
    assert (r.title, r.chamada, r.text, r.url, r.portal, r.page_number, str(r.date_publication)) == ("T", "S & s", "one\ntwo", "u1", "a", 2, "2025-07-24")
    assert got[4].text == "" and got[4].date_publication is None  # no such container; the date is of another form


@pytest.mark.parametrize("block", [3, 7, 100_000])
@pytest.mark.parametrize("by", [[], ["portal"]])
def test_page_runs_equal_a_scan(spark, block, by):
    rng = random.Random(block)
    rows = [(rng.choice(["p", "q", None]), n, rng.random() < 0.8) for n in range(-5, 60)]
    if not by:
        rows = [("p", n, hit) for _, n, hit in rows]
    want, first = set(), {}
    for portal in {r[0] for r in rows}:
        pages = sorted(n for p, n, hit in rows if p == portal and hit)
        runs = []
        for n in pages:
            if runs and n == runs[-1][1] + 1:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        want |= {(portal, *r) for r in runs}
        first[portal] = set(range(runs[0][0], runs[0][1] + 1))
    profile = spark.createDataFrame(rows, "portal string, page long, has_target boolean")
    got = filters.page_runs(profile, "page", by, block).collect()
    assert len(got) == len(want) and {((r.portal if by else "p"), r.first_page, r.last_page) for r in got} == want
    hit = filters.target_run(profile, "page", by, block).collect()
    assert {p: {r.page for r in hit if r.portal == p} for p in first} == first
    assert filters.target_run(profile.filter("not has_target"), "page", by).count() == 0


def test_landing_again_changes_nothing_and_refused_records_are_apart(spark):
    path, bad = shared_dir(spark), shared_dir(spark)
    rows = [(1, "x", "n", None), (2, "y", None, None), (None, " ", "n", None), (4, "z", "2024", "{broken")]
    df = spark.createDataFrame(rows, "id long, t string, entity_type string, _bad string")

    def land(frame, run):
        landing.land(landing.stamp(landing.refused(frame, ["id", "t"]), "Src", run, ["id", "t"]), path, bad)

    for _ in range(2):
        land(df, "c1")
    land(df.filter("id = 1"), "007")  # another run
    assert landing.landed(spark, path, "c1") == 2 and landing.landed(spark, path, "007") == 1
    back = landing.collections_of(spark, path, "src")
    assert sorted((r.id, r.collect_id, r.entity_type) for r in back.collect()) == [(1, "007", "n"), (1, "c1", "n"), (2, "c1", "none")]
    assert sorted(r.error for r in spark.read.parquet(bad).collect()) == ["record without identity", "unreadable record"]


def test_vector_classifier_on_rows_it_has_not_seen(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0.6 if i % 2 else -0.6, 1, 16)], i % 2) for i in range(600)]
    rows += [(600, None, 1), (601, [1.0], 0), (602, [float("nan")] * 16, 1), (603, [None] * 16, 0), (604, [0.1] * 16, None)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label int")
    model = models.fit_vector_classifier(df.filter("id % 4 <> 2"), 16)
    got = {r.id: r for r in models.classify_vectors(model, df, 16).collect()}
    held = [i for i in range(600) if i % 4 == 2] + [i for i in range(600) if i % 4 == 3]
    assert np.mean([got[i].prediction == i % 2 for i in held if i % 4 == 2]) > 0.95
    assert len(got) == 605 and all(got[i].prediction is None and got[i].margin is None for i in range(600, 604)) and got[604].prediction is not None


def test_text_classifier_on_rows_it_has_not_seen(spark):
    """Texts of two kinds that share most of their words; three in four are learned from."""
    rng = random.Random(6)
    own = {0: ["festa", "jogo", "praia", "chuva"], 1: ["fraude", "desvio", "propina", "cartel"]}
    rows = [(i, " ".join(rng.choice(own[i % 2]) if rng.random() < 0.2 else f"comum{rng.randrange(200)}" for _ in range(40)), float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, text string, label double")
    scored = models.classify(models.fit_classifier(df.filter("id % 8 < 6")), df.filter("id % 8 >= 6"))
    assert scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > 0.9


@pytest.mark.parametrize("wide", [False, True])
def test_patterns_equal_brute_force(spark, wide):
    places = [(1, "Balneário Rincão"), (2, "Alem da Serra A"), (3, "São Além"), (4, "Vila_Nova"), (5, "100% Novo"), (6, "ALEMANHA"), (7, "")]
    asked = ["%ALEM%A", "alem", "Vila\\_N", "%Novo%", "rinc_o", "100\\%"] + (["%", "_", "a", "%a_"] if wide else [])
    a, b = spark.createDataFrame([(x,) for x in asked], "t string"), spark.createDataFrame(places, "id long, place string")
    want = a.join(b, F.expr("place ilike concat('%', t, '%')")).select("t", "id").collect()
    found = linking.containing(a, b, "t", "place", [])
    assert sorted(map(tuple, found.select("t", "id").collect())) == sorted(map(tuple, want)) and len(want) > 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("NestedLoop" in plan or "Cartesian" in plan) == wide
    wild = {r.name: r.id for r in linking.resolve_names(a.withColumnRenamed("t", "name"), b).filter("tier = 1").collect()}
    every = a.join(b, F.expr("place ilike t")).filter(F.col("t").rlike("[%_\\\\]") | (F.lower("t") == F.lower("place"))).groupBy("t").agg(F.min("id").alias("id"))
    assert wild == {r.t: r.id for r in every.collect()}


def test_editais_of_any_length(spark):
    df = spark.createDataFrame([("Edital nº 90000012/2024 e processo 0012345678/2023",)], "t string")
    assert df.select(models.editais(F.col("t"))).first()[0] == ["90000012/2024", "12345678/2023"]


def test_chains_of_any_length_are_resolved(spark):
    from garimpo.operators import keys

    n = spark.createDataFrame([(i, i - 1 if i else None) for i in range(30)], "id long, ref long").coalesce(1)
    ready, pending = keys.gate({"a": n}, "id", [keys.Dependency("a", "a", "ref", "id")])
    assert ready.count() == 30 and pending.count() == 0


def test_truthy_fields_and_texts_required(spark):
    from garimpo.functions.text import first_filled, missing

    df = spark.createDataFrame([(1, "", None, "b"), (2, None, "", None), (3, "t", "c", "b")], "id int, text string, conteudo string, body string")
    got = {r.id: (r.x, r.error) for r in filters.with_text(df.withColumn("x", first_filled(F.col("text"), F.col("conteudo"), F.col("body"))), "x").collect()}
    assert got == {1: ("b", None), 2: (None, "text missing"), 3: ("t", None)}
    tokens = spark.createDataFrame([(x,) for x in (None, "", "NaN", "null", "None", "0", " ")], "s string")
    assert [r[0] for r in tokens.select(missing(F.col("s"))).collect()] == [True] * 5 + [False] * 2


def test_scan_of_a_prefix_through_a_mounted_store(spark, tmp_path):
    """Only Spark's readers open this path, as an object store's; folders below the prefix count, other prefixes don't."""
    from garimpo.sources import articles

    for name in ("news/a.json", "news/deep/b.json", "other/c.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(json.dumps([{"title": name}]))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.bucket.link./in", f"file://{tmp_path}")
    got = articles.load(spark, {"folder_path": "viewfs://bucket/in/news", "entity_type": "noticia"})
    assert sorted(r.title for r in got.collect()) == ["news/a.json", "news/deep/b.json"]
