"""Vectors of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from garimpo.functions import answers, coerce, dates, text, trigram


def one(spark, f, *values):
    row = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


D = dt.date(2025, 7, 24)


@pytest.mark.parametrize("f,s,want", [
    (dates.iso_or_portuguese, "2025-07-24T23:38:34-03:00", D), (dates.iso_or_portuguese, "2025-07-24T23:38:34Z", D), (dates.iso_or_portuguese, "24 jul 2025 às 14h38", D),
    (dates.iso_or_portuguese, "24 Jul 2025", D), (dates.iso_or_portuguese, "24 SET 2025", None), (dates.iso_or_portuguese, "2025-07-24", None), (dates.iso_or_portuguese, "", None),
    (dates.iso_or_portuguese, "31 fev 2025", None), (dates.iso_or_portuguese, None, None),
    (dates.day_month_year, "24/07/2025 - 14:38", D), (dates.day_month_year, "24/07/2025 14:38", None), (dates.day_month_year, "31/02/2025", None),
    (dates.day_month_year_hour, "24/07/2025 às 14h38 Atualizada em 25/07/2025", D), (dates.day_month_year_hour, "24/07/2025", None),
    (dates.normalize_date, "99/99/2025", "2025-99-99"), (dates.normalize_date, "30/5/2025", "30/5/2025"), (dates.normalize_date, "2025-05-30T10:00", "2025-05-30"), (dates.normalize_date, "", None),
    (text.normalize_edital, "005/2023", "5/2023"), (text.normalize_edital, "000/2023", "0/2023"), (text.normalize_edital, "PL 184/2021", "PL 184/2021"), (text.normalize_edital, "1/2/3", "1/2/3"),
    (text.clean_text, "<b>A, B\\C!</b>  d", "a b\\c d"), (text.clean_text, "<p>fraude</p><p>edital</p> a&amp;b<br>c", "fraude edital ab c"),
    (text.clean_text, "x<script>var a</script>y<!-- no -->z 3 < 4 &eacute;&#x1F600;&#128;&nope; &copy", "x y z 3 4 é\U0001f600\x80nope copy"), (text.portal_of_url, "https://g1.globo.com/x", "g1"), (text.portal_of_url, "https://www.nsctotal.com.br/y", "nsctotal"), (text.portal_of_url, "no scheme", ""),
    (text.fold, "São José", "sao jose"), (text.fold_exact, "São José №", "sao jose no"),
])
def test_vectors(spark, f, s, want):
    assert one(spark, f, s) == want


@pytest.mark.parametrize("a,b,want", [
    ("PL 184/2021", "184/2021", 0.75), ("5/2023", "005/2023", 0.4545), ("word", "two words", 0.3636), ("São José", "Sao Jose", 0.2857), ("", "x", 0.0), ("", "", 0.0), (None, "x", 0.0),
])
def test_similarity(spark, a, b, want):
    assert one(spark, trigram.similarity, a, b) == pytest.approx(want, abs=1e-4)


def test_similarity_is_single_precision(spark):
    row = spark.range(1).select((F.lit(0.4).cast("float") > F.lit(0.4).cast("double")).alias("x"))
    assert row.first()["x"]


def test_answers(spark):
    raw = '```json\n{"municipio": ["  A ", "A", ""], "modalidade": "pregão", "edital": ["005/2023", "5/2023", 7], "objeto": {"a": 1}}\n```'
    df = spark.createDataFrame([(raw,), ("broken",), (None,)], "r string")
    rows = df.select(*[c.alias(k) for k, c in answers.parse_answer(F.col("r")).items()]).collect()
    assert rows[0].asDict() == {"municipio": ["A"], "modalidade": ["pregão"], "edital": ["5/2023", "7"], "objeto": []}
    assert all(v == [] for r in rows[1:] for v in r.asDict().values())


def test_chosen_id(spark):
    df = spark.createDataFrame([('{"id_processo_licitatorio": 5}', [4, 5]), ('{"id_processo_licitatorio": 9}', [4, 5]), ("4", [4]), ("none", [4])], "a string, c array<bigint>")
    assert [r[0] for r in df.select(answers.chosen_id(F.col("a"), F.col("c"))).collect()] == [5, None, 4, None]


@pytest.mark.parametrize("value,kind,want", [("1", "integer", 1), ("x", "integer", None), ("0", "integer", 0), ("sim", "boolean", True), ("no", "boolean", False), ("2024-02-30", "date", None), ("a", "ARRAY", ["a"]), ("{}", "jsonb", "{}"), ("{", "jsonb", None)])
def test_coerce(spark, value, kind, want):
    assert one(spark, lambda c: coerce.coerce(c, kind), value) == want


def test_parse_dates_has_the_columns_of_its_sql(spark, sf_dir):
    from garimpo.plans.scalars import parse_dates

    assert parse_dates(spark, sf_dir).columns == ["event_id", "raw", "iso_or_portuguese", "dmy", "dmy_hour", "by_portal"]
