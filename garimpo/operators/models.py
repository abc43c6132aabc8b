"""Classification and rule-based extraction of news."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions.text import clean_text, normalize_edital
from garimpo.sources.shared import small, stored

# Tender modalities as texts write them, and their normal form.
MODALITIES = {
    "pregão presencial": "pregão presencial", "pregões presenciais": "pregão presencial", "pregão eletrônico": "pregão eletrônico", "pregões eletrônicos": "pregão eletrônico",
    "concorrência presencial": "concorrência presencial", "concorrência eletrônica": "concorrência eletrônica", "concorrência pública": "concorrência",
    "tomada de preços": "tomada de preços", "tomadas de preços": "tomada de preços", "dispensa de licitação": "dispensa de licitação", "dispensas de licitação": "dispensa de licitação",
    "inexigibilidade de licitação": "inexigibilidade de licitação", "leilão": "leilão", "leilões": "leilão", "carta convite": "convite", "regime diferenciado de contratação": "regime diferenciado de contratação",
    "dispensa": "dispensa de licitação", "dispensas": "dispensa de licitação", "pregões": "pregão", "modalidade convite": "convite", "modalidade concurso": "concurso", "edital de concorrência": "concorrência",
}
#: What is no modality: price registers, generic auctions, competition in its general sense, selection of staff.
NO_MODALITY = (
    r"(?:sistemas? de )?registros? de preços?|preg(?:ão|ões) públicos?|concursos? públicos?"
    r"|\b(?:frustr|fraud|restring|prejudic|elimin|limit|burl|viol|ampli|livre|falta|sem)\p{L}*(?: d)?(?: ?[ao]s?)? (?:caráter competitivo e (?:a )?)?(?:livre )?concorrência(?: pública)?"
)
# A modality is sure where the text says so or numbers it.
_SURE, _NUMBERED = r"\b(?:modalidade(?: de)?|edital(?: de)?|licitação(?: por| de)?|processo(?: de)?) ", r"(?: n[º°o.]*| número)? ?[0-9]"


def _sure(words: str) -> str:
    return f"{_SURE}{words}\\b|\\b{words}{_NUMBERED}"


#: Patterns of each normal form, over lower-case text without what is no modality.
MODALITY_PATTERNS = {
    "pregão presencial": r"\bpreg(?:ão|ões) presencia(?:l|is)\b", "pregão eletrônico": r"\bpreg(?:ão|ões) eletrônicos?\b", "pregão": r"\bpreg(?:ão|ões)\b(?! presencia| eletrônic)",
    "concorrência presencial": r"\bconcorrências? presencia(?:l|is)\b", "concorrência eletrônica": r"\bconcorrências? eletrônicas?\b",
    "concorrência": rf"\bconcorrências? públicas?\b|{_sure('concorrências?(?! presencia| eletrônic)')}",
    "tomada de preços": r"\btomadas? de preços?\b", "dispensa de licitação": r"\bdispensas?\b", "inexigibilidade de licitação": r"\binexigibilidades?\b", "leilão": r"\bleil(?:ão|ões)\b",
    "convite": rf"\bcartas?[ -]convites?\b|{_sure('convites?')}", "concurso": _sure("concursos?"),
    "regime diferenciado de contratação": r"\bregimes? diferenciados? de contrataç(?:ão|ões)\b|\brdc\b",
}
EDITAL = r"(?i)(?:edital|preg[aã]o(?:\s+(?:eletr[oô]nico|presencial))?|concorr[eê]ncia|processo|licita[cç][aã]o|tomada de pre[cç]os)\s*(?:n[º°o.]*|n[uú]mero)?\s*([0-9]+\s*(?:/|\sde\s)\s*[0-9]{4})"
OBJECT = r"(?i)(?:objeto|contrata[cç][aã]o de|aquisi[cç][aã]o de|constru[cç][aã]o de|fornecimento de|compra de)\s*:?\s*([^.;\n]{3,})"

#: What a text holds that names a modality, where it isn't the first four letters.
STEMS = {"regime diferenciado de contratação": ("regime", "rdc")} | {n: ("concorr",) for n in MODALITY_PATTERNS if n.startswith("concorr")}

#: Distinct first words of a dictionary up to which texts are searched for them before words are joined up.
FIRST_WORDS = 20_000


def fit_classifier(texts: DataFrame, label: str = "label", features: int = 1 << 14, iterations: int = 20) -> PipelineModel:
    """Cleaned words, hashed and weighted, and a linear support-vector machine; ``text`` and 0/1 ``label``.

    Texts are cleaned and hashed once, for all passes of the fit.
    """
    words = PipelineModel([RegexTokenizer(inputCol="cleaned", outputCol="words", pattern=r"\s+"), HashingTF(inputCol="words", outputCol="tf", numFeatures=features)])
    steps = [IDF(inputCol="tf", outputCol="tfidf"), LinearSVC(featuresCol="tfidf", labelCol=label, maxIter=iterations)]
    fitted = Pipeline(stages=steps).fit(stored(words.transform(cleaned(texts)).select("tf", label)))
    return PipelineModel([*words.stages, *fitted.stages])


def cleaned(texts: DataFrame) -> DataFrame:
    return texts.withColumn("cleaned", clean_text(F.coalesce(F.col("text"), F.lit(""))))


def classify(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Texts with their ``prediction``, 0 or 1.

    As the element of an array, the prediction is made once where rows are chosen by it; else the choice would clean and classify each text again.
    """
    out = model.transform(cleaned(texts)).drop("cleaned", "words", "tf", "tfidf", "rawPrediction")
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "prediction"], F.explode(F.array("prediction")).alias("prediction"))


def usable(vectors: DataFrame, vector: str, size: int) -> Column:
    """Whether a row's vector has the size and holds finite numbers alone."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) == size) & fine


def fit_vector_classifier(vectors: DataFrame, size: int, label: str = "label", vector: str = "embedding", iterations: int = 50, regularisation: float = 0.01) -> PipelineModel:
    """A linear support-vector machine over text embeddings (arrays of ``size`` numbers), scaled; unusable rows and rows without label are left out."""
    rows = vectors.filter(usable(vectors, vector, size) & F.col(label).isNotNull())
    steps = [
        StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True, withStd=True),
        LinearSVC(featuresCol="_scaled", labelCol="_label", maxIter=iterations, regParam=regularisation),
    ]
    return Pipeline(stages=steps).fit(rows.select(array_to_vector(F.col(vector).cast("array<double>")).alias("_vector"), F.col(label).cast("double").alias("_label")))


def classify_vectors(model: PipelineModel, vectors: DataFrame, size: int, vector: str = "embedding") -> DataFrame:
    """All rows with ``prediction`` (0 or 1) and ``margin``, the distance from the plane; both NULL for unusable vectors."""
    fine = usable(vectors, vector, size)
    zero = F.array_repeat(F.lit(0.0), size)
    rows = vectors.withColumns({"_fine": fine, "_vector": array_to_vector(F.when(fine, F.col(vector).cast("array<double>")).otherwise(zero))})
    out = model.transform(rows).withColumns({
        "margin": F.when(F.col("_fine"), F.get(vector_to_array("rawPrediction"), F.lit(1))), "prediction": F.when(F.col("_fine"), F.col("prediction")),
    })
    return out.drop("_fine", "_vector", "_scaled", "rawPrediction")


def editais(text: Column) -> Column:
    """Tender numbers that a text names, as ``NUMBER/YEAR``, without repeats."""
    raw = F.regexp_extract_all(text, F.lit(EDITAL), F.lit(1))
    return F.array_distinct(F.transform(raw, lambda x: normalize_edital(F.regexp_replace(x, r"\s*(?:/|\sde\s)\s*", "/"))))


def modalities(text: Column) -> Column:
    """Modalities that a text clearly names, in their normal form, without repeats.

    Patterns run only on texts that hold the stem of their word.
    """
    holds = lambda t, stems: reduce(Column.__or__, [F.contains(t, F.lit(x)) for x in stems])
    flat = lambda t: F.regexp_replace(F.regexp_replace(t, r"\s+", " "), f"(?U){NO_MODALITY}", " ")

    def named_in(t: Column) -> Column:
        return F.array(*[F.when(holds(t, STEMS.get(name, (name[:4],))) & t.rlike(f"(?U){form}"), F.lit(name)) for name, form in MODALITY_PATTERNS.items()])

    # As the element of an array, the prepared text is made once for all patterns.
    low = F.transform(F.array(F.lower(text)), lambda t: F.when(holds(t, {x for n in MODALITY_PATTERNS for x in STEMS.get(n, (n[:4],))}), flat(t)))
    return F.filter(F.flatten(F.transform(F.filter(low, lambda t: t.isNotNull()), named_in)), lambda x: x.isNotNull())


def objects(text: Column) -> Column:
    """What a text says is being bought, as it stands there."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(OBJECT), F.lit(1)), lambda x: F.trim(x)))


def named(rows: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """``key, names``: dictionary entries (``name``) that stand in a text, found by an equi-join on word n-grams.

    The n-grams are of the lengths that the dictionary's entries have and, where those are
    few, begin with the first word of one.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    parts = F.filter(F.split(F.lower("name"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    entries = dictionary.select("name", parts.alias("parts")).filter(F.size("parts") > 0).distinct()
    lengths = sorted(r.n for r in entries.select(F.size("parts").alias("n")).distinct().collect())
    first = [r.w for r in entries.select(F.get("parts", F.lit(0)).alias("w")).distinct().limit(FIRST_WORDS + 1).collect()]
    each = rows.select(key, F.explode(F.array(words)).alias("w"))
    place = F.sequence(F.lit(1), F.size("w"))
    if 0 < len(first) <= FIRST_WORDS:
        place = F.filter(place, lambda i: F.element_at("w", i).isin(first))
    grams = F.flatten(F.transform(place, lambda i: F.array(*[F.when(i + (n - 1) <= F.size("w"), F.array_join(F.slice("w", i, F.lit(n)), " ")) for n in lengths])))
    grams = F.when(F.size("w") > 0, grams) if lengths else F.array().cast("array<string>")
    index = entries.select("name", F.array_join("parts", " ").alias("g"))
    found = each.select(key, F.explode(F.array_distinct(grams)).alias("g")).join(small(index), "g")
    return found.groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("names"))


def extract(rows: DataFrame, key: str, text: str, places: DataFrame) -> DataFrame:
    """Rows with the four lists ``municipio, modalidade, edital, objeto``; explicit mentions only."""
    lists = rows.withColumns({"modalidade": modalities(F.col(text)), "edital": editais(F.col(text)), "objeto": objects(F.col(text))})
    found = named(rows, key, text, places).select(F.col(key).alias("_k"), F.col("names").alias("municipio"))
    return lists.join(found, F.col(key) == F.col("_k"), "left").drop("_k").withColumn("municipio", F.coalesce("municipio", F.array().cast("array<string>")))
