"""Queries of the scalar functions."""

from pyspark.sql import functions as F

from garimpo.functions import answers, coerce, dates, text, trigram
from garimpo.plans.tables import table
from garimpo.registry import query

_MON = "'jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'"

#: Strings of every form that portals use, made from event times; Spark SQL.
DATE_STRINGS = f"""
    CASE pmod(event_id, 9)
      WHEN 0 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '-03:00')
      WHEN 1 THEN concat(day(ts), ' ', element_at(array({_MON}), month(ts)), ' ', year(ts), ' às ', date_format(ts, 'HH'), 'h', date_format(ts, 'mm'))
      WHEN 2 THEN concat(day(ts), ' SET ', year(ts))
      WHEN 3 THEN date_format(ts, 'yyyy-MM-dd')
      WHEN 4 THEN date_format(ts, 'dd/MM/yyyy - HH:mm')
      WHEN 5 THEN date_format(ts, 'dd/MM/yyyy HH:mm')
      WHEN 6 THEN concat(date_format(ts, 'dd/MM/yyyy'), ' às ', date_format(ts, 'HH'), 'h', date_format(ts, 'mm'), ' Atualizada em ', date_format(ts, 'dd/MM/yyyy'))
      WHEN 7 THEN concat('31/02/', year(ts), ' - 10:00')
      ELSE '' END"""
_DUCK_STRINGS = f"""
    CASE event_id % 9
      WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-03:00'
      WHEN 1 THEN day(ts) || ' ' || list_extract([{_MON}], month(ts)) || ' ' || year(ts) || ' às ' || strftime(ts, '%Hh%M')
      WHEN 2 THEN day(ts) || ' SET ' || year(ts)
      WHEN 3 THEN strftime(ts, '%Y-%m-%d')
      WHEN 4 THEN strftime(ts, '%d/%m/%Y - %H:%M')
      WHEN 5 THEN strftime(ts, '%d/%m/%Y %H:%M')
      WHEN 6 THEN strftime(ts, '%d/%m/%Y às %Hh%M Atualizada em %d/%m/%Y')
      WHEN 7 THEN '31/02/' || year(ts) || ' - 10:00'
      ELSE '' END"""


@query(
    "parse_dates",
    f"""
    WITH s AS (SELECT event_id, {_DUCK_STRINGS} AS raw FROM events),
    m AS (SELECT *, list_position([{_MON}], lower(split_part(split_part(raw, ' às ', 1), ' ', 2))) AS mon,
                 string_split(trim(split_part(raw, ' às ', 1)), ' ') AS tok FROM s)
    SELECT event_id, raw, iso_or_portuguese::VARCHAR AS iso_or_portuguese, dmy::VARCHAR AS dmy, dmy_hour::VARCHAR AS dmy_hour, by_portal::VARCHAR AS by_portal FROM (
    SELECT event_id, raw,
      CASE WHEN contains(raw, 'T') THEN CASE WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T.*') THEN try_cast(substr(raw, 1, 10) AS DATE) END
           WHEN len(tok) = 3 AND mon > 0 THEN try_cast(tok[3] || '-' || lpad(mon::VARCHAR, 2, '0') || '-' || lpad(tok[1], 2, '0') AS DATE) END AS iso_or_portuguese,
      CASE WHEN regexp_full_match(trim(split_part(raw, ' - ', 1)), '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}')
           THEN try_strptime(trim(split_part(raw, ' - ', 1)), '%d/%m/%Y')::DATE END AS dmy,
      try_strptime(trim(split_part(raw, 'Atualizada', 1)), '%d/%m/%Y às %Hh%M')::DATE AS dmy_hour,
      CASE event_id % 3 WHEN 0 THEN iso_or_portuguese WHEN 1 THEN dmy ELSE dmy_hour END AS by_portal
    FROM m)
    """,
)
def parse_dates(spark, sf_dir):
    s = table(spark, sf_dir, "events").select("event_id", F.expr(DATE_STRINGS).alias("raw"))
    forms = ("iso_or_portuguese", "dmy", "dmy_hour")
    parser = F.element_at(F.array(*map(F.lit, forms)), (F.col("event_id") % 3 + 1).cast("int"))
    return s.select("event_id", "raw", *[dates.PARSERS[n](F.col("raw")).cast("string").alias(n) for n in forms], dates.parse_by_name(F.col("raw"), parser).cast("string").alias("by_portal"))


@query(
    "normalize_date",
    f"""
    WITH s AS (SELECT event_id, CASE WHEN event_id % 11 = 3 THEN '99/99/2025' WHEN event_id % 11 = 4 THEN '30/5/2025' ELSE {_DUCK_STRINGS} END AS raw FROM events)
    SELECT event_id, CASE WHEN raw = '' THEN NULL
      WHEN regexp_matches(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN regexp_extract(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
      WHEN regexp_matches(raw, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN regexp_extract(raw, '([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}})', 3) || '-' ||
        regexp_extract(raw, '([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}})', 2) || '-' || regexp_extract(raw, '([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}})', 1)
      ELSE raw END AS normalized, try_cast(normalized AS DATE)::VARCHAR AS day FROM s
    """,
)
def normalize_date(spark, sf_dir):
    raw = F.expr(f"CASE WHEN pmod(event_id, 11) = 3 THEN '99/99/2025' WHEN pmod(event_id, 11) = 4 THEN '30/5/2025' ELSE {DATE_STRINGS} END")
    n = dates.normalize_date(F.col("raw"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).select(
        "event_id", n.alias("normalized"), F.when(n.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), n.try_cast("date")).cast("string").alias("day")
    )


@query(
    "normalize_edital",
    """
    WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '00' || o_orderkey || '/' || year(o_orderdate) WHEN 1 THEN 'PL ' || o_orderkey || '/' || year(o_orderdate)
      WHEN 2 THEN ' 000/' || year(o_orderdate) ELSE '1/2/' || o_orderkey END AS edital FROM orders)
    SELECT o_orderkey, CASE WHEN len(string_split(trim(edital), '/')) = 2
      THEN coalesce(nullif(ltrim(split_part(trim(edital), '/', 1), '0'), ''), '0') || '/' || split_part(trim(edital), '/', 2) ELSE trim(edital) END AS edital FROM s
    """,
)
def normalize_edital(spark, sf_dir):
    raw = F.expr("""CASE pmod(o_orderkey, 4) WHEN 0 THEN concat('00', o_orderkey, '/', year(o_orderdate)) WHEN 1 THEN concat('PL ', o_orderkey, '/', year(o_orderdate))
        WHEN 2 THEN concat(' 000/', year(o_orderdate)) ELSE concat('1/2/', o_orderkey) END""")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.normalize_edital(raw).alias("edital"))


@query(
    "clean_text",
    r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(lower(replace(replace(replace(regexp_replace('<p>A&amp;B<br>c' || text || '\</p>&ccedil;&#227;o', '</?[A-Za-z][^>]*>', ' ', 'g'),
      '&amp;', '&'), '&ccedil;', 'ç'), '&#227;', 'ã')), '[!"#$%&''()*+,\-./:;<=>?@\[\]^_`{|}~]', '', 'g'), '[\s\x{00a0}]+', ' ', 'g')) AS cleaned FROM documents
    """,
)
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.concat(F.lit("<p>A&amp;B<br>c"), "text", F.lit("\\</p>&ccedil;&#227;o"))).alias("cleaned"))


@query("fold_text", "SELECT doc_id, translate(lower(text), 'áàâãäåçéèêëíìîïñóòôõöúùûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy') AS folded FROM documents")
def fold_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@query(
    "fold_text_exact",
    """SELECT doc_id, regexp_replace(lower(strip_accents(text)), '[^\\x00-\\x7f]', '', 'g') AS folded FROM documents""",
)
def fold_text_exact(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fold_exact(F.col("text")).alias("folded"))


@query(
    "portal_name",
    r"""
    SELECT page_id, coalesce(nullif(regexp_extract(url, '^[a-z]+://(?:www\.)?([^./?#:]*)', 1), ''), '') AS portal FROM
    (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', '://www.') ELSE regexp_replace(url, '^[a-z]+://', '') END AS url FROM pages)
    """,
)
def portal_name(spark, sf_dir):
    u = F.expr("CASE pmod(page_id, 3) WHEN 0 THEN url WHEN 1 THEN replace(url, '://', '://www.') ELSE regexp_replace(url, '^[a-z]+://', '') END")
    return table(spark, sf_dir, "pages").select("page_id", text.portal_of_url(u).alias("portal"))


@query("summary200", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN source ELSE substr(text, 1, 200) END AS summary FROM documents WHERE text <> ''")
def summary200(spark, sf_dir):
    chamada = F.when(F.col("doc_id") % 5 == 0, F.col("source")).when(F.col("doc_id") % 5 == 1, "")
    return table(spark, sf_dir, "documents").filter("text <> ''").select("doc_id", text.summary(chamada, F.col("text")).alias("summary"))


@query(
    "truncate_words",
    r"""
    WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents)
    SELECT doc_id, CASE WHEN len(w) > 200 THEN array_to_string(w[1:200], ' ') ELSE text END AS head FROM w
    """,
)
def truncate_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_words(F.col("text"), 200).alias("head"))


TRGM_SQL = """list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''),
      lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""


def sim_sql(a: str, b: str) -> str:
    """Similarity of two trigram lists in DuckDB."""
    return f"(CASE WHEN len({a}) + len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE END)::FLOAT"


@query(
    "trgm_similarity",
    f"""
    WITH t AS (SELECT p_partkey, {TRGM_SQL.format('p_name')} AS a, {TRGM_SQL.format('p_type')} AS b FROM part)
    SELECT p_partkey, round({sim_sql('a', 'b')}::DOUBLE, 6) AS similarity FROM t
    """,
)
def trgm_similarity(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(trigram.similarity(F.col("p_name"), F.col("p_type")).cast("double"), 6).alias("similarity"))


@query("nested_path", """SELECT event_id, json_extract_string('{"a": ' || props || '}', '$.a.k') AS inner_k, NULL::VARCHAR AS absent FROM events""")
def nested_path(spark, sf_dir):
    doc = F.concat(F.lit('{"a": '), "props", F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", text.nested(doc, "a.k").alias("inner_k"), text.nested(doc, "a.k.z").alias("absent"))


@query(
    "parse_answers",
    """
    WITH e AS (SELECT event_id, event_type, user_id FROM events)
    SELECT event_id,
      CASE event_id % 5 WHEN 4 THEN '' WHEN 3 THEN '' ELSE event_type END AS municipio,
      CASE event_id % 5 WHEN 4 THEN '' ELSE 'x' || user_id END AS modalidade,
      CASE event_id % 5 WHEN 4 THEN '' WHEN 2 THEN user_id::VARCHAR ELSE user_id || '/2023' END AS edital,
      '' AS objeto
    FROM e
    """,
)
def parse_answers(spark, sf_dir):
    raw = F.expr(r"""CASE pmod(event_id, 5)
        WHEN 0 THEN concat('```json\n{"municipio": [" ', event_type, ' ", "', event_type, '"], "modalidade": "x', user_id, '", "edital": ["00', user_id, '/2023"], "objeto": []}\n```')
        WHEN 1 THEN concat('{"municipio": "\'', event_type, '\'", "modalidade": ["x', user_id, '", ""], "edital": "', user_id, '/2023", "objeto": null}')
        WHEN 2 THEN concat('```\n{"municipio": ["', event_type, '"], "modalidade": ["x', user_id, '"], "edital": ', user_id, ', "objeto": {"a": 1}}\n```')
        WHEN 3 THEN concat('{"municipio": true, "modalidade": ["x', user_id, '"], "edital": ["', user_id, '/2023", "0', user_id, '/2023"]}')
        ELSE concat('not json ', event_id) END""")
    lists = answers.parse_answer(F.col("raw"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).select("event_id", *[F.array_join(c, "|").alias(k) for k, c in lists.items()])


@query(
    "coerce_types",
    """
    WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN 'sim' WHEN 2 THEN strftime(ts, '%Y-%m-%d') ELSE 'x1' END AS v FROM events)
    SELECT event_id, try_cast(CASE WHEN regexp_full_match(v, '[0-9]+') THEN v END AS INTEGER) AS as_int, lower(v) IN ('true','t','1','yes','y','sim') AS as_bool,
      try_cast(v AS DATE)::VARCHAR AS as_date, try_cast(CASE WHEN regexp_full_match(v, '[0-9.]+') THEN v END AS DOUBLE) AS as_double, '[' || v || ']' AS as_array,
      CASE WHEN regexp_full_match(v, '[0-9]+') THEN v END AS as_json, NULL::VARCHAR AS as_uuid,
      regexp_full_match(v, '[0-9]+') AS is_int
    FROM v
    """,
)
def coerce_types(spark, sf_dir):
    v = F.expr("CASE pmod(event_id, 4) WHEN 0 THEN cast(user_id AS string) WHEN 1 THEN 'sim' WHEN 2 THEN date_format(ts, 'yyyy-MM-dd') ELSE 'x1' END")
    c = F.col("v")
    return table(spark, sf_dir, "events").select("event_id", v.alias("v")).select(
        "event_id",
        coerce.coerce(c, "integer").alias("as_int"), coerce.coerce(c, "boolean").alias("as_bool"),
        F.when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), coerce.coerce(c, "date")).cast("string").alias("as_date"),
        coerce.coerce(c, "double precision").alias("as_double"),
        F.concat(F.lit("["), F.array_join(coerce.coerce(c, "ARRAY"), ","), F.lit("]")).alias("as_array"),
        coerce.coerce(c, "jsonb").alias("as_json"), coerce.coerce(c, "uuid").alias("as_uuid"), coerce.fits(c, "integer").alias("is_int"),
    )


@query("article_id", "SELECT page_id, coalesce(nullif(list_extract(string_split(url, '/'), -1), ''), 'article_' || page_id) AS article_id FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '/' ELSE url END AS url FROM pages)")
def article_id(spark, sf_dir):
    url = F.expr("CASE pmod(page_id, 4) WHEN 0 THEN concat(url, '/') ELSE url END")
    return table(spark, sf_dir, "pages").select("page_id", text.article_id(url, F.col("page_id")).alias("article_id"))
