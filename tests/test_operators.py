"""Edge rows and invariants of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from garimpo.operators import cache, documents, filters, graph, keys, linking, models, pipeline
from garimpo.sources import articles, html, landing, shared
from garimpo.sources.shared import shared_dir


def test_gate_is_disjoint_and_cycles_wait(spark):
    a = spark.createDataFrame([(1, None), (2, 1), (3, 4), (4, 3), (5, 9)], "id long, ref long")
    ready, pending = keys.gate({"a": a}, "id", [keys.Dependency("a", "a", "ref", "id")])
    assert sorted(r.id for r in ready.collect()) == ["a:1", "a:2"]
    assert sorted(r.id for r in pending.collect()) == ["a:3", "a:4", "a:5"]


def test_mandatory_key_rejects(spark):
    a = spark.createDataFrame([(1, ""), (2, "x")], "id long, ref string")
    b = spark.createDataFrame([(7, "x")], "id long, code string")
    ready, _ = keys.gate({"a": a, "b": b}, "id", [keys.Dependency("a", "b", "ref", "code", True)])
    assert sorted(r.id for r in ready.collect()) == ["a:2", "b:7"]


def test_foreign_key_zero_is_a_value(spark):
    a = spark.createDataFrame([(1, 0)], "id long, ref long")
    b = spark.createDataFrame([(0,)], "id long")
    assert keys.pendencies(a, "id", {"b": b}, [keys.Dependency("a", "b", "ref", "id")], F.current_timestamp()).count() == 0


def test_closure_depth(spark):
    n = spark.createDataFrame([(i, i - 1 if i else None) for i in range(30)], "id long, ref long")
    got = {r.id: r.depth for r in keys.closure(n.select("id"), n, most=20).collect()}
    assert got == {i: i for i in range(21)}


def test_cache_takes_the_earliest_config_that_holds_all_settings(spark):
    reqs = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"b": "2", "a": "1"}), (3, {"a": "1", "b": "2", "no_cache": "true"}), (4, {"a": "1", "b": "2", "use_cache": "false"}), (5, {"a": "1"}), (6, {"a": "1", "b": "2", "c": None}), (7, {"a": "1", "b": "3"}), (8, {"a": "1", "z": "2"}), (9, {})], "request_id long, config map<string,string>")
    known = spark.createDataFrame([("c2", {"b": "2", "a": "1"}), ("c1", {"a": "1", "b": "2", "more": "x"}), ("c0", {"q": "9"})], "collect_id string, config map<string,string>")
    got = {r.request_id: (r.action, r.collect_id) for r in cache.lookup(reqs, known).collect()}
    assert got == {1: ("hit", "c1"), 2: ("hit", "c1"), 3: ("miss", None), 4: ("bypass", None), 5: ("hit", "c1"), 6: ("hit", "c1"), 7: ("miss", None), 8: ("miss", None), 9: ("hit", "c0")}


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "n", "a", "x", "2024-01-01")], "id_object long, attribute_name string, id_source string, attribute_value string, date_updated string")
    new = spark.createDataFrame([(1, "n", "A", "y", "2023-01-01"), (1, "n", "", "z", "2024-01-01"), (1, "", "a", "q", "2024-01-01"), (1, "m", "a", "", "2024-01-01")], old.schema)
    once = graph.upsert_attributes(old, new)
    twice = graph.upsert_attributes(once, new)
    assert sorted(map(tuple, once.select("attribute_name", "id_source", "attribute_value").collect())) == [("n", "a", "y"), ("n", "unknown", "z")]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_relate_pairs_and_products(spark):
    rows = spark.createDataFrame([(["#1:1", "#1:2"], ["#2:1", "#2:2"]), (["#1:3"], ["#2:1", " #2:2 ", "bad"])], "a array<string>, b array<string>")
    none = spark.createDataFrame([("#1:1", "#2:1")], "src string, dst string")
    got = sorted((r.src, r.dst) for r in graph.relate(rows, "a", "b", F.lit("s"), none).collect())
    assert got == [("#1:2", "#2:2"), ("#1:3", "#2:1"), ("#1:3", "#2:2")]


def test_similar_pairs_equal_brute_force(spark):
    names = ["edital 12/2020", "edital 12/2021", "pregao 9/2020", "12/2020", "", "x", "pregao 99/2020", "edital 012/2020"]
    a = spark.createDataFrame(list(enumerate(names)), "a long, text string")
    b = a.withColumnRenamed("a", "b")
    got = {(r.a, r.b) for r in linking.similar_pairs(a, b, 0.5).collect()}
    every = a.join(b.withColumnRenamed("text", "t2"), F.lit(True)).withColumn("s", linking.similarity(F.col("text"), F.col("t2")))
    assert got == {(r.a, r.b) for r in every.filter("s > 0.5").collect()}


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_similar_pairs_of_short_and_long_texts(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab1 /") for _ in range(rnd.randint(0, n))) for n in (2, 5, 9, 40) for _ in range(25)]
    a = spark.createDataFrame(list(enumerate(texts)), "a long, text string").withColumn("s", F.col("a") % 2)
    b = a.withColumnRenamed("a", "b")
    for least in (0.2, 0.4, 0.5, 0.8):
        got = {(r.a, r.b) for r in linking.similar_pairs(a, b, least, ["s"]).collect()}
        every = a.join(b.withColumnRenamed("text", "t2"), "s").withColumn("x", linking.similarity(F.col("text"), F.col("t2")))
        assert got == {(r.a, r.b) for r in every.filter(F.col("x") > F.lit(least).cast("float")).collect()}


def test_texts_without_a_partner_of_their_size(spark):
    a = spark.createDataFrame([(1, "x")], "a long, text string")
    b = spark.createDataFrame([(2, "a text that is a great deal longer than the other")], "b long, text string")
    assert linking.similar_pairs(a, b, 0.5).count() == 0


def test_only_counted_frames_are_broadcast(spark):
    rows = shared.stored(spark.range(10))
    assert broadcasts(rows.join(shared.small(shared.stored(spark.range(10)), 5), "id")) == 0
    assert broadcasts(rows.join(shared.small(shared.stored(spark.range(10)), 10), "id")) == 1
    texts = spark.createDataFrame([(1, "12/2020"), (2, "12/2021")], "a long, text string")
    # The counts of trigrams, once for either side; neither texts nor pairs.
    assert broadcasts(linking.similar_pairs(texts, texts.withColumnRenamed("a", "b"), 0.5)) == 2


def test_resolve_tiers(spark):
    places = spark.createDataFrame([(1, "Balneário Rincão"), (2, "Joinville"), (3, "Rincão Velho")], "id long, place string")
    names = spark.createDataFrame([("joinville",), ("Rincão",), ("Joinvile",), ("Nowhere",), (" ",), (None,)], "name string")
    got = {r.name: (r.id, r.tier) for r in linking.resolve_names(names, places).collect()}
    assert got == {"joinville": (2, 1), "Rincão": (1, 2), "Joinvile": (2, 3)}


@pytest.mark.parametrize("binding,key,want", [("insert.*", "insert.noticias", True), ("insert.*", "insert.a.b", False), ("#", "a.b", True), ("a.#", "a", True), ("a.#", "a.b.c", True), ("a.#", "ab", False), ("#.c", "c", True), ("#.c", "a.b.c", True), ("*.b", "b", False)])
def test_topics(spark, binding, key, want):
    df = spark.createDataFrame([(binding, key)], "b string, k string").withColumn("rx", filters.topic_pattern(F.col("b")))
    assert df.select(F.expr("k rlike rx")).first()[0] == want


def test_find_null_matches_missing(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id long, f string")
    assert [r.id for r in documents.find(df, {"f": None}, "id").collect()] == [1]
    assert documents.find(df, {"f": {"$ne": "x"}}, "id").count() == 1


def test_json_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"title": "a"}, {"title": "b"}]')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.json").write_text('{"title": "c"}')
    (tmp_path / "bad.json").write_text("{broken")
    (tmp_path / "other.txt").write_text("x")
    rows = articles.scan_json(spark, str(tmp_path)).cache()
    assert sorted(r.title for r in rows.filter("_bad is null").collect()) == ["a", "b", "c"]
    assert rows.filter("_bad is not null").count() == 1


def test_landing_counts(spark):
    df = spark.createDataFrame([(1, "x", "n"), (2, "y", None)], "id long, t string, entity_type string")
    path = shared_dir(spark)
    landing.land(landing.stamp(df, "Src", "c", ["id", "t"]), path)
    assert landing.landed(spark, path, "c") == 2 and landing.landed(spark, path, "other") == 0
    back = landing.collections_of(spark, path, "SRC")
    assert back.count() == 2 and back.select("raw_data_id").distinct().count() == 2


PAGE = """<html><head><script>var t="</p>";</script></head><body><div class="box main"><h1> T </h1><h2 class="sub">S</h2>
<p>one<p>two <b>bold</b></p><h3>head</h3></div><span class="date mb-3">24/07/2025 - 10:00</span><time datetime=""></time><p>outside</p></body></html>"""


def test_page_fields():
    p = html.Page(PAGE)
    assert p.text(p.first("h1")) == "T"
    assert html.content(p, {"tag": "div", "attrs": {"class": "main"}, "find_all": ["p", "h3"]}) == "one\ntwo bold\nhead"
    assert p.first("span", {"class": "date mb-3"}) and p.first("span", {"class": "date"}) and not p.first("span", {"class": "mb-3 date"})
    assert html.first_date(p, [{"tag": "time", "attribute": "datetime"}, {"attrs": {"class": "date mb-3"}}]) == "24/07/2025 - 10:00"
    assert html.content(p, {"tag": "section"}) == ""


def test_editais(spark):
    df = spark.createDataFrame([("Edital nº 0123/2023 e pregão número 24 de 2022; edital nº 123/2023",)], "t string")
    assert df.select(models.editais(F.col("t"))).first()[0] == ["123/2023", "24/2022"]


def test_names_of_any_number_of_words_and_whole_objects(spark):
    from garimpo.operators import models

    item = " ".join(f"item {i} de papel" for i in range(40))
    texts = spark.createDataFrame([(1, f"Em São Miguel da Boa Vista, objeto: {item}. Fim"), (2, "Em Lages; compra de giz"), (3, None)], "id int, text string")
    places = spark.createDataFrame([("São Miguel da Boa Vista",), ("Lages",), ("São Miguel",), ("--",)], "name string")
    got = {r.id: r for r in models.extract(texts, "id", "text", places).collect()}
    assert got[1].municipio == ["São Miguel", "São Miguel da Boa Vista"] and got[2].municipio == ["Lages"] and got[3].municipio == []
    assert got[1].objeto == [item] and got[2].objeto == ["giz"]
    assert all(r.municipio == [] for r in models.extract(texts, "id", "text", places.limit(0)).collect())


@pytest.mark.parametrize("text,want", [
    ("Pregões eletrônicos e o pregão presencial 3/2020", ["pregão presencial", "pregão eletrônico"]), ("dispensas e inexigibilidade", ["dispensa de licitação", "inexigibilidade de licitação"]),
    ("frustrar a concorrência pública e restringiu a concorrência", []), ("na modalidade concorrência; concorrência nº 12/2023", ["concorrência"]), ("concorrência pública 1", ["concorrência"]),
    ("concurso público para cargos", []), ("licitação na modalidade de concurso", ["concurso"]), ("sistema de registro de preços por pregão", ["pregão"]), ("pregão público", []),
    ("aceitou o convite para a festa", []), ("carta-convite 12/2001", ["convite"]), ("convite nº 12/2001", ["convite"]), ("Regime\nDiferenciado de Contratação", ["regime diferenciado de contratação"]), (None, []),
])
def test_modalities_named_clearly(spark, text, want):
    from garimpo.operators import models

    got = spark.createDataFrame([(text,)], "t string").select(models.modalities(F.coalesce("t", F.lit("")))).first()[0]
    assert got == want


@pytest.mark.parametrize("few", [True, False])
def test_names_with_and_without_first_words(spark, few, monkeypatch):
    from garimpo.operators import models

    monkeypatch.setattr(models, "FIRST_WORDS", 100 if few else 1)
    texts = spark.createDataFrame([(1, "A Nova  Trento e Nova-Veneza."), (2, "Nova"), (3, ""), (4, "em São José do Cedro, São José")], "id int, text string")
    places = spark.createDataFrame([("Nova Trento",), ("Nova Veneza",), ("São José",), ("São José do Cedro",), ("",)], "name string")
    got = {r.id: r.names for r in models.named(texts, "id", "text", places).collect()}
    assert got == {1: ["Nova Trento", "Nova Veneza"], 4: ["São José", "São José do Cedro"]}


def test_load_reads_files_or_pages(spark, tmp_path):
    import json

    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text(json.dumps([{"portal": "p", "title": "t1"}, {"portal": "q", "title": "t2"}]))
    (tmp_path / "in" / "deep" / "b.json").write_text(json.dumps({"portal": "p", "title": "t3"}))
    (tmp_path / "in" / "bad.json").write_text("{no json")
    (tmp_path / "in" / "c.txt").write_text("[]")
    got = articles.load(spark, {"folder_path": str(tmp_path / "in"), "entity_type": "noticia"})
    assert sorted((r.title, r.entity_type) for r in got.collect()) == [("t1", "noticia"), ("t2", "noticia"), ("t3", "noticia")]
    assert sum(r._bad is not None for r in articles.scan_json(spark, str(tmp_path / "in")).collect()) == 1
    pages = spark.createDataFrame([("x", "2024-01-01"), ("y", "2024-01-02")], "title string, d string").select("title", F.to_date("d").alias("date_publication"))
    titles = lambda request: sorted(r.title for r in articles.load(spark, request, pages).collect())
    assert titles({"date": "2024-01-02"}) == ["y"] and titles({"collect_all": True, "date": "2024-01-02"}) == ["x", "y"] and titles({}) == ["x", "y"]


def test_report_export_is_lines_of_json(spark, tmp_path):
    import json

    rows = [("a", 1), ("b", 2)]
    for _ in range(2):  # written anew, not added to
        articles.export_report(spark.createDataFrame(rows, "portal string, n int"), str(tmp_path / "out"))
    got = [json.loads(line) for f in (tmp_path / "out").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted((r["portal"], r["n"]) for r in got) == rows


def test_target_day(spark):
    from garimpo.operators.requests import target_day

    df = spark.createDataFrame([("05/02/2024",), ("31/02/2024",), ("2024-02-05",), (None,), ("",)], "t string")
    assert [str(r[0]) for r in df.select(target_day(F.col("t"), F.lit("2024-03-01").cast("date"))).collect()] == ["2024-02-05"] + ["2024-02-29"] * 4


def test_strict_types(spark):
    from garimpo.functions.coerce import fits, is_exactly

    df = spark.createDataFrame([("12", 12, True, 1.5)], "s string, i int, b boolean, d double")
    kinds = {"s": "text", "i": "integer", "b": "boolean", "d": "double precision"}
    row = df.select(*[is_exactly(df, c, k).alias(f"{c}_{k.split()[0]}") for c in df.columns for k in kinds.values()], fits(F.col("s"), "integer").alias("loose")).first()
    assert {k for k, v in row.asDict().items() if v} == {"s_text", "i_integer", "b_boolean", "d_double", "loose"}


def test_a_batch_delivered_again_is_no_second_result(spark, tmp_path):
    from garimpo.streaming import stages

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text('{"id": 1}\n{"id": 2}\nno json\n')
    stage = stages.Stage(lambda df: df.withColumn("error", F.when(F.col("id") == 2, "two")))
    run = lambda: stages.run(stages.messages(spark, str(tmp_path / "in")), "id long", stage, str(tmp_path / "out"), str(tmp_path / "check"))
    run()
    run()  # nothing new
    for f in (tmp_path / "check" / "commits").glob("[!.]*"):  # as if the stream had died before its commit
        f.unlink()
    for f in (tmp_path / "check" / "commits").glob(".*"):
        f.unlink()
    run()
    assert [stages.read_out(spark, str(tmp_path / "out"), x).count() for x in ("published", "failed", "unparsable")] == [1, 1, 1]
    failed = stages.read_out(spark, str(tmp_path / "out"), "failed").first()
    assert (failed.error, failed.error_type, failed.stack_trace) == ("two", "ValidationError", None)


def test_a_message_that_breaks_the_stage_goes_to_the_dead_letters(spark, tmp_path):
    from garimpo.streaming import stages

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text('{"id": 1}\n{"id": 0}\n')
    (tmp_path / "in" / "2.txt").write_text('{"id": 4}\n')
    stage = stages.Stage(lambda df: df.withColumn("x", F.when(F.col("id") == 0, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id") * 2)))
    stages.run(stages.messages(spark, str(tmp_path / "in")), "id long", stage, str(tmp_path / "out"), str(tmp_path / "check"))
    out = lambda name: stages.read_out(spark, str(tmp_path / "out"), name)
    assert sorted(r.x for r in out("published").collect()) == [2, 8]
    failed = out("failed").collect()
    assert len(failed) == 1 and all("broken row" in r.error and r.error_type and r.stack_trace for r in failed)


def test_news_rows_broadcast_only_the_modalities(spark):
    row = "raw_data_id string, municipio struct<nome_municipio:string>, noticia struct<numero_edital:string,objeto:string,nome_portal:string>, modalidade_licitacao struct<descricao:string>"
    records = spark.createDataFrame([("1", ("A",), ("1/2023", "o", "p"), ("CONVITE",))], row)
    resolved = shared.stored(spark.createDataFrame([("A", 7)], "name string, id_municipio long"))
    kinds = spark.createDataFrame([(1, "CONVITE")], "id_modalidade_licitacao int, descricao string")
    got = pipeline.news_of(records, "raw_data_id", resolved, kinds)
    assert broadcasts(got) == 1
    assert [(r.id_noticia, r.id_municipio, r.id_modalidade_licitacao) for r in got.collect()] == [("1", 7, 1)]
