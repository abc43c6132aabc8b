"""Personal data by weak supervision, with DataFrame functions alone.

Base patterns give the spans that always count.  Beside them loose patterns propose
candidates (secrets, numbers in groups, spelled-out mail addresses, titled names); three
kinds of labelers vote on each: a strict pattern, a gazetteer and the words to its left.
Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is, and the posteriors train the final classifier, naive Bayes over features of
the span, which decides what joins the base spans.

Only counts of vote patterns and of feature values reach the driver: at most
``len(KINDS) * 27`` and a few dozen numbers, whatever the input.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import stored

# Fixed patterns of the base spans, written so that no text makes them slow: possessive
# repeats where giving back can't help, and a start only where a run of the class begins
# or the match before ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Twelve repeats at least: shorter runs are never cards, and the run's start is the same.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Kinds of candidates, their loose pattern and the strict one that votes.
KINDS = {
    "secret": (
        r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+",
        r"^(?:[0-9a-f]{32,}|(?:AKIA|ghp_|sk-|sk_|xox)[A-Za-z0-9_-]{12,})$",
    ),
    "number": (
        r"(?<![0-9A-Za-z+(.])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9A-Za-z.])",
        r"^(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$",
    ),
    "mail": (
        r"(?<![A-Za-z0-9._])[A-Za-z0-9._]{2,40}+\x20?[\[({]\x20?(?i:at|arroba)\x20?[\])}]\x20?[A-Za-z0-9.-]{2,60}+",
        r"(?i)(?:\.|dot[\])}]?\x20?)(?:com|org|net|edu|gov|de|fr|es|br)$",
    ),
    "name": (
        r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora|Sr|Sra)\b\.?\x20\p{Lu}\p{Ll}{1,20}+(?:\x20\p{Lu}\p{Ll}{1,20}+)?",
        r"\p{Lu}\p{Ll}+\x20\p{Lu}\p{Ll}+$",
    ),
}
#: What a text must hold for a kind to be searched.
NEEDS = {"secret": r"[0-9]", "number": r"[0-9]{2}[\x20.)-]", "mail": r"(?i)[\[({]\x20?(?:at|arroba)", "name": r"\b(?:M[rs]|Dr|Herr|Frau|Mme|Mons|Mada|Se|Sr)"}
#: Gazetteers: parts that speak for a kind.
GAZETTEER = {
    "secret": r"(?i)(?:akia|ghp_|sk-|sk_|xox|key|tok)",
    "number": r"^(?:\(?(?:201|202|212|213|305|310|312|415|555|617|702|800|888)\)?)",
    "mail": r"(?i)(?:gmail|mail|outlook|yahoo|hotmail|example|proton)",
    "name": r"\b(?:Anna|Ana|Carlos|David|Eva|Hans|Jean|João|John|José|Juan|Karl|Luis|Maria|María|Marie|Mary|Michael|Paul|Peter|Pierre|Smith|Müller|García|Silva)\b",
}
#: Words to the left that speak for a kind, and words that speak against any.
CUES = {
    "secret": r"(?i)(?:token|secret|passw(?:or)?d|api.?key|key|auth|bearer)\W{0,6}$",
    "number": r"(?i)(?:call|phone|tel|mobile|fax|ssn|telefon|telefono|teléfono|contact)\W{0,6}(?:is|no|number)?\W{0,4}$",
    "mail": r"(?i)(?:mail|e-mail|contact|write|correo)\W{0,6}(?:to|me|is)?\W{0,4}$",
    "name": r"(?i)(?:by|from|for|contact|dear|von|de|par|por|with)\W{0,3}$",
}
AGAINST = r"(?i)(?:version|v|isbn|issn|page|pages|fig|figure|section|chapter|table|commit|sha|md5|uuid|doi|lines?|rev)\W{0,4}$"
LEFT_CHARS = 32


def matches(text: Column, pattern: str, need: Column) -> Column:
    """Array of (start, end, body) of the leftmost non-overlapping matches, in code points.

    What ``split`` leaves between the matches and the matches themselves add up to the
    text; running sums of their lengths are taken in blocks, so many matches stay cheap.
    """
    none = F.array().cast("array<struct<start:long,end:long,body:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    sizes = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("own"), m.alias("body")))

    def placed(parts: Column) -> Column:
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x["gap"] + x["own"])
        block = 128
        sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / block)), lambda b: total(F.slice(parts, b.cast("int") * block + 1, block)))

        def one(x: Column, i: Column) -> Column:
            b = F.floor(i / block).cast("int")
            before = F.aggregate(F.slice(sums, 1, b), F.lit(0).cast("long"), lambda a, s: a + s)
            start = before + total(F.slice(parts, b * block + 1, i - b * block)) + x["gap"]
            return F.struct(start.alias("start"), (start + x["own"]).alias("end"), x["body"].alias("body"))

        return F.transform(parts, one)

    # The piece after the last match has no match beside it.
    return F.when(need, placed(F.filter(sizes, lambda x: x["body"].isNotNull()))).otherwise(none)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(body: Column) -> Column:
    d = F.reverse(_digits(body))
    terms = F.transform(
        F.sequence(F.lit(1), F.length(d)),
        lambda i: F.when(i % 2 == 1, F.substr(d, i, F.lit(1)).cast("int")).otherwise(
            (F.substr(d, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substr(d, i, F.lit(1)).cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind: arrays of (start, end, body)."""
    digit = text.rlike("[0-9]")
    part = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substr(F.ltrim(p, F.lit("0")), F.lit(1), F.lit(3)).try_cast("int"), F.lit(0)) <= 255)
    size = lambda x: F.length(_digits(x["body"]))
    return {
        "email": matches(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(matches(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda x: F.forall(F.split(x["body"], r"\."), part)),
        "card": F.filter(matches(text, CARD, digit), lambda x: F.when(size(x).between(13, 19), _luhn(x["body"])).otherwise(False)),
        "phone": F.filter(matches(text, PHONE, F.contains(text, F.lit("+"))), lambda x: size(x).between(9, 15)),
    }


def candidates(text: Column, gazetteer: dict[str, str] = GAZETTEER) -> Column:
    """Array of candidates with their votes and features; ``gazetteer`` has a pattern for each kind."""

    def judged(kind: str) -> Column:
        loose, strict = KINDS[kind]

        def votes(x: Column) -> Column:
            left = F.substr(text, F.greatest(x["start"] - LEFT_CHARS + 1, F.lit(1)).cast("int"), F.least(x["start"], F.lit(LEFT_CHARS)).cast("int"))
            body, n = x["body"], F.length(x["body"])
            share = F.floor(F.length(_digits(body)) * 4 / n)
            return F.struct(
                F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                F.when(body.rlike(strict), 1).otherwise(-1).alias("v_pattern"),
                F.when(body.rlike(gazetteer[kind]), 1).otherwise(0).alias("v_gazetteer"),
                F.when(left.rlike(CUES[kind]), 1).when(left.rlike(AGAINST), -1).otherwise(0).alias("v_context"),
                F.concat(F.lit(f"{kind}:len"), F.least(F.floor(n / 8), F.lit(6)).cast("string")).alias("f_len"),
                F.concat(F.lit(f"{kind}:digits"), share.cast("string")).alias("f_digits"),
                F.concat(F.lit(f"{kind}:left"), F.when(left.rlike(CUES[kind]), "+").when(left.rlike(AGAINST), "-").when(left.rlike(r"[=:]\W*$"), "=").otherwise("0")).alias("f_left"),
                F.concat(F.lit(f"{kind}:form"), F.when(body.rlike(strict), "1").otherwise("0")).alias("f_form"),
            )

        return F.transform(matches(text, loose, text.rlike(NEEDS[kind])), votes)

    return F.concat(*[judged(k) for k in KINDS])


FEATURES = ("f_len", "f_digits", "f_left", "f_form")
VOTES = ("v_pattern", "v_gazetteer", "v_context")


def reliabilities(patterns: list[dict], rounds: int = 30) -> dict[tuple, float]:
    """Posterior of each (kind, votes) by expectation-maximisation over counted vote patterns.

    Every labeler has, for each kind and class, a distribution over its votes; a Dirichlet
    prior says that labelers are better than chance, which also settles kinds that were
    met rarely.
    """
    post: dict[tuple, float] = {}
    for kind in KINDS:
        rows = [(tuple(p[v] for v in VOTES), p["n"]) for p in patterns if p["kind"] == kind]
        if not rows:
            continue
        q = {v: 0.9 if sum(v) >= 2 else 0.5 if sum(v) == 1 else 0.05 for v, _ in rows}
        for _ in range(rounds):
            total = sum(n for _, n in rows)
            prior = (sum(n * q[v] for v, n in rows) + 1) / (total + 4)
            theta = []
            for j in range(len(VOTES)):
                t = {}
                for c in (0, 1):
                    w = {x: (3.0 if x == (1 if c else -1) else 1.0 if x == 0 else 0.5) for x in (-1, 0, 1)}
                    for v, n in rows:
                        w[v[j]] += n * (q[v] if c else 1 - q[v])
                    s = sum(w.values())
                    t[c] = {x: w[x] / s for x in w}
                theta.append(t)
            for v, _ in rows:
                one = prior * math.prod(theta[j][1][x] for j, x in enumerate(v))
                zero = (1 - prior) * math.prod(theta[j][0][x] for j, x in enumerate(v))
                q[v] = one / (one + zero)
        post |= {(kind, *v): p for v, p in q.items()}
    return post


def _lookup(table: dict[str, float], key: Column, default: float) -> Column:
    if not table:
        return F.lit(default)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv]), key), F.lit(default))


def classifier(found: DataFrame) -> dict[str, float]:
    """Log-odds of every feature value and ``kind``, from the posteriors of the labelled candidates."""
    each = found.select(F.explode("cands").alias("c")).select("c.*")
    patterns = [r.asDict() for r in each.groupBy("kind", *VOTES).agg(F.count("*").alias("n")).collect()]
    post = reliabilities(patterns)
    votes = F.concat_ws("|", "kind", *[F.col(v).cast("string") for v in VOTES])
    p = _lookup({"|".join(map(str, k)): float(x) for k, x in post.items()}, votes, 0.5)
    values = each.withColumn("p", p).select(
        "p", F.explode(F.array("kind", *FEATURES)).alias("value")
    ).groupBy("value").agg(F.sum("p").alias("pos"), F.sum(1 - F.col("p")).alias("neg")).collect()
    sums = {r["value"]: (r["pos"], r["neg"]) for r in values}
    weights: dict[str, float] = {}
    for value, (pos, neg) in sums.items():
        if value in KINDS:
            weights[value] = math.log((pos + 0.5) / (neg + 0.5))
        else:
            kp, kn = sums[value.partition(":")[0]]
            weights[value] = math.log((pos + 0.5) / (kp + 2)) - math.log((neg + 0.5) / (kn + 2))
    return weights


def scan(docs: DataFrame, gazetteer: dict[str, str] = GAZETTEER) -> DataFrame:
    """One row per document: base counts, ``base_sha256`` and ``spans``, all spans as text.

    Spans are ``kind:start:end`` in code points, end exclusive; base kinds in the order email,
    ip, card, phone, then the kinds of ``KINDS``; by start within a kind.  Added spans that
    touch a base span are left to it.  ``n_spans`` counts all.  Null text counts as empty.  Rows that
    repeat an identifier are rows of their own; without candidates nothing is added; even odds
    add nothing.  Texts of any length are searched whole, no pattern backtracks over a run.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = base_spans(text)
    found = stored(
        docs.select(
            F.col("doc_id"),
            *[F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(k) for k, c in base.items()],
            candidates(text, gazetteer).alias("cands"),
        )
    )
    weights = classifier(found)

    def odds(c: Column) -> Column:
        parts = [_lookup({k: w for k, w in weights.items() if k in KINDS}, c["kind"], -1.0)]
        for f in FEATURES:
            tag = f":{f[2:]}"
            parts.append(_lookup({k: w for k, w in weights.items() if tag in k}, c[f], 0.0))
        return reduce(Column.__add__, parts)

    every = F.concat(*[F.col(k) for k in base])
    accepted = F.filter(
        "cands",
        lambda c: (odds(c) > 0) & ~F.exists(every, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    rows = found.withColumn("added", accepted)

    def named_spans(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat(F.lit(f"{kind}:"), x["start"], F.lit(":"), x["end"]))

    named = {k: named_spans(k) for k in base}
    extra = F.transform("added", lambda c: F.concat(c["kind"], F.lit(":"), c["start"], F.lit(":"), c["end"]))
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.array_join(F.concat(*named.values()), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*named.values(), extra), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        reduce(Column.__add__, [F.size(k) for k in (*base, "added")]).cast("long").alias("n_spans"),
    )
