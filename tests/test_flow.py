"""The queries without SQL against results worked out row by row in Python, and the flow as a whole."""

import html
import re

import pytest
from pyspark.sql import functions as F

from garimpo import registry
from garimpo.operators import linking, models
from garimpo.plans import flow

Q = registry.queries()
FORMS = list(models.MODALITIES.items())


@pytest.fixture(scope="module")
def relevant(spark, sf_dir):
    """Documents that the classifier, fitted on the same rows, keeps; with a sentence on a tender behind them."""
    texts = flow.tender_texts(spark, sf_dir)
    model = models.fit_classifier(flow.labelled(spark, sf_dir))
    return {r.doc_id: r for r in models.classify(model, texts).filter("prediction = 1").collect()}


def test_classifier_separates_labelled_rows(spark, sf_dir):
    got = Q["classify_docs"](spark, sf_dir)
    both = got.join(spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality is not null"), "doc_id")
    right = both.agg(F.avg((F.col("prediction") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9 and got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert sorted(map(tuple, Q["fraud_gate"](spark, sf_dir).collect())) == sorted(map(tuple, got.filter("prediction = 1").collect()))


def test_texts_are_classified_once_and_cleaned_once_for_the_fit(spark, sf_dir, monkeypatch):
    """A choice by prediction cleaned each text again, and each pass of the fit all of them (F16, F17, F18, F21)."""
    seen, fit = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    model = models.fit_classifier(flow.labelled(spark, sf_dir))
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert len(seen) == 1 and "regexp_replace" not in optimized(seen[0])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = optimized(models.classify(model, docs).filter("prediction = 1"))
    assert plan.count("<(script|style)") == optimized(models.cleaned(docs)).count("<(script|style)") > 0


def test_matches_are_kept_before_they_are_scored(spark, sf_dir):
    """As one plan, the driver held the stages and broadcasts of all matches at a time (F2 to F6)."""
    plan = Q["link_candidates"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitsa" not in plan and "_lit" not in plan


def test_processed_articles(spark, sf_dir, relevant):
    got = {r.raw_data_id: r for r in Q["process_articles"](spark, sf_dir).collect()}
    parts = {r.p_partkey - 1: r.p_name for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect()}
    assert set(got) == {str(d) for d in relevant}
    for d in relevant:
        r = got[str(d)]
        assert (r.numero_edital, r.municipio, r.modalidade, r.data_source) == (f"{d}/2023", parts.get(d), FORMS[d % len(FORMS)][1], "noticias")
        assert r.nome_portal == (relevant[d].source or "p")
    sums = {r.portal: r for r in Q["pipeline_summary"](spark, sf_dir).collect()}
    assert sum(r.verified for r in sums.values()) == len(relevant) and all(r.with_edital == r.verified for r in sums.values())
    assert sum(r.with_place for r in sums.values()) == sum(d in parts for d in relevant)


def test_flow_end_to_end(spark, sf_dir, relevant):
    out = {k: {r[0]: r for r in df.collect()} if k == "news" else df.collect() for k, df in flow.flow(spark, sf_dir).items()}
    assert out["statistics/totals"][0].documents == len(out["landed"]) == sum(r.n for r in out["statistics/by_portal"]) and len(out["statistics/by_collect"]) == 1
    assert {str(r.date) for r in out["statistics/recent_dates"]} == {"2024-01-01"} and len(out["statistics/first_last"]) == len(out["statistics/by_portal"])
    parts = {r.p_partkey - 1: r.p_name for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect()}
    first = {}
    for d, name in sorted(parts.items()):
        first.setdefault(name, d + 1)
    known = {name: i for name, i in first.items() if i % 11}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len(out["landed"]) == docs and {r.collect_id for r in out["landed"]} == {"run-1"}
    url = lambda r: int(r.url.rsplit("/", 1)[1])
    number = {r.raw_data_id: url(r) for r in out["landed"]}
    assert {number[r.raw_data_id] for r in out["failed"]} == {d for d in relevant if d % 7 == 0}
    good = {d for d in relevant if d % 7}
    # A name that is not in the catalogue may still be contained in, or similar to, one that is.
    places = spark.createDataFrame([(i, name) for name, i in known.items()], "id long, place string")
    resolved = {r.name: r.id for r in linking.resolve_names(spark.createDataFrame([(n,) for n in first], "name string"), places).collect()}
    assert all(resolved[name] == i for name, i in known.items())
    waiting = {d for d in good if d in parts and parts[d] not in resolved}
    assert {number[r.raw_data_id] for r in out["waiting"]} == waiting
    news = {number[k]: r for k, r in out["news"].items()}
    assert set(news) == good - waiting
    # The tender of an article's own number is its candidate where its place is known, and the only one or the most similar.
    links = {number[r.id_noticia]: r for r in out["links"]}
    for d, r in news.items():
        assert r.id_municipio == resolved.get(parts.get(d)) and r.id_processo_licitatorio == links[d].id_processo_licitatorio
        if d in parts and d % 5 and parts[d] in known:
            assert links[d].n_candidates >= 1 and (links[d].status != "linked" or links[d].id_processo_licitatorio == d)
        if d not in parts:
            assert links[d].status == "no_match"
    sums = Q["flow_end_to_end"](spark, sf_dir).collect()
    assert sum(r.n for r in sums) == len(news) and sum(r.linked for r in sums) == sum(r.status == "linked" for r in links.values()) > 0
    assert sum(r.written for r in sums) == sum(r.id_processo_licitatorio is not None for r in news.values())


def test_page_queries(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    article = {r.page_id: r for r in Q["article_extract"](spark, sf_dir).collect()}
    content = {r.page_id: r.text for r in Q["page_content"](spark, sf_dir).collect()}
    head = {r.page_id: r.head for r in Q["html_first_words"](spark, sf_dir).collect()}
    assert set(article) == set(content) == set(head) == set(pages)
    for i, p in pages.items():
        bare = re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", "", p.html)
        words = set(re.findall(r"\w+", html.unescape(re.sub(r"<[^>]+>", " ", bare))))
        assert set(re.findall(r"\w+", content[i] or "")) <= words
        assert content[i] == article[i].text and article[i].url == p.url
        title = re.search(r"(?is)<h1\b[^>]*>(.*?)</h1>", bare)
        assert article[i].title == ((html.unescape(re.sub("<[^>]+>", "", title[1])).strip() if title else "") or "sem-titulo")
        first = head[i].split(" ")
        assert len(first) == 2000 or len(first) < 2000 and set(re.findall(r"\w+", head[i])) >= set(re.findall(r"\w+", content[i] or ""))
    hosts = {r.host: r for r in Q["page_profile"](spark, sf_dir).collect()}
    count = lambda i: re.sub(r"^www\.", "", re.match(r"[a-z]+://([^/?#:]*)", pages[i].url)[1])
    for host, r in hosts.items():
        own = [i for i in pages if count(i) == host]
        assert r.pages == len(own) and r.with_h1 == sum(bool(re.search(r"(?i)<h1\b", pages[i].html)) for i in own)
