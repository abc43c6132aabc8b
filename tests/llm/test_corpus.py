"""The corpus operators against brute force, and their edge rows."""

import functools
import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from compare import canon

from garimpo.llm import exact_dedup, jaccard_join, langid, licenses, mixing, packing, pii, quality, queries, repeats, suffixes, topk
from garimpo.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, label string"
LONG = "alpha beta gamma delta " * 3000


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls everywhere, empty and long texts, repeated rows, columns with names that operators use."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "one two three four five six", "en", "b"), (5, "one  two\nthree four five six", "de", None),
            (5, "one  two\nthree four five six", "de", None), (None, "no id here at all", "en", "a"), (6, LONG, "en", "c"), (7, LONG, "en", "c"), (8, "ONE two three four five six", None, "b"), (None, None, None, None)]
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, "x") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    a, b = canon(queries.queries()[name](spark, sf_dir).toPandas()), canon(duck.execute(SQL[name]).df())
    assert list(a.columns) == list(b.columns)
    assert a.equals(b)


# Exact dedup -----------------------------------------------------------------------------


def test_exact_dedup_edges(edge):
    got = [tuple(r) for r in exact_dedup.exact_groups(edge).select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 3, True), (2, 1, 3, False), (None, 1, 3, False), (3, 3, 1, True), (4, 4, 3, True), (5, 4, 3, False), (5, 4, 3, False), (None, None, 1, True), (6, 6, 2, True), (7, 6, 2, False), (8, 8, 1, True)], key=str)


def test_exact_dedup_of_a_hot_text(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("t"), (F.col("id") % 500).cast("string"))).alias("text"))
    got = exact_dedup.exact_groups(df).toPandas()
    want = df.toPandas().assign(t=lambda d: d["text"]).merge(df.groupBy("text").agg(F.min("doc_id").alias("m"), F.count("*").alias("n")).toPandas(), on="text").set_index("doc_id")
    assert all(want.m[r.doc_id] == r.keep_id and want.n[r.doc_id] == r.group_size for r in got.itertuples())
    assert got.kept.sum() == want.m.nunique()
    assert exact_dedup.exact_dedup(df).count() == want.m.nunique()


def test_exact_dedup_keeps_one_of_repeated_rows(edge):
    assert exact_dedup.exact_dedup(edge.filter("doc_id = 5")).count() == 1
    assert exact_dedup.exact_dedup(edge.limit(0)).count() == 0


# Mixing ------------------------------------------------------------------------------------


def test_mix_is_near_its_targets(docs):
    got = mixing.mix(docs).toPandas()
    per = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), most=("size", "max"))
    assert (abs(per.taken - per.target) <= per.most).all()
    assert (got.taken <= 3 * got["size"]).all()
    assert abs(per.target.sum() - got["size"].sum()) < 1
    assert canon(got).equals(canon(mixing.mix(docs.repartition(7)).toPandas()))


def test_mix_edges(edge):
    got = mixing.mix(edge).toPandas()
    assert len(got) == edge.count() and (got.taken <= 3 * got["size"]).all()
    assert mixing.mix(edge.limit(0)).count() == 0
    assert mixing.mix(edge.filter("doc_id = 2")).toPandas().taken.tolist() == [0]
    assert set(mixing.mixed(edge).columns) == set(edge.columns)


def test_targets_stop_at_three_times(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 1)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got["a"] == 30.0 and got["d"] == 3.0
    assert got["b"] == pytest.approx((2011 - 33) * 2 / 3) and got["c"] == pytest.approx((2011 - 33) / 3)


# Packing ------------------------------------------------------------------------------------


@functools.cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encode(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [2]


def check_packing(got, texts):
    by = defaultdict(list)
    for r in got.itertuples():
        by[r.doc_id].append(r)
    for doc, text in texts.items():
        ids, own = encode(text), sorted(by[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))] and sum(r.length for r in own) == len(ids)
        assert len(ids) > 1024 or len(own) == 1
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 1024


def test_packing_round_trip(docs, texts):
    got = packing.pack(docs).toPandas()
    check_packing(got, texts)
    assert got.sequence_id.nunique() <= 1.03 * -(-got.length.sum() // 1024) + 2


def test_packing_edges(edge):
    got = packing.pack(edge, group_rows=3).toPandas()
    assert len(got[got.doc_id == 5]) == 2 and got[got.doc_id == 1].length.tolist() == [1]
    assert packing.pack(edge.limit(0)).count() == 0


def test_sequences_hold_every_row_once(spark, edge):
    rows = [(5, "first text of five"), (5, "other text of five"), (None, "no identifier"), (None, None), (5, "first text of five"), (6, LONG)]
    got = packing.sequences(spark.createDataFrame(rows, "doc_id long, text string"), group_rows=3).collect()
    assert all(r.n_tokens == len(r.ids) <= 1024 for r in got)
    assert sorted(x for r in got for x in r.ids) == sorted(x for _, t in rows for x in encode(t))
    found = Counter(part for r in got for part in f" {' '.join(map(str, r.ids))} ".split(" 2 "))
    for _, t in rows[:3]:
        assert found[" ".join(map(str, encode(t)[:-1]))] + found[" " + " ".join(map(str, encode(t)[:-1]))] >= 1
    assert packing.sequences(edge.limit(0)).count() == 0


def test_fast_ids_equal_the_tokenizer():
    rnd, fast = random.Random(5), packing.byte_bpe()
    pools = ["abc XYZ 12 \n\t.,'séßł", "a  \u0085\x1c 中\U0001f600<|endoftext|>", "̀ǅ ' 't 'll\r\n  "]
    for i in range(600):
        t = "".join(rnd.choice(pools[i % 3]) for _ in range(rnd.randint(0, 60))) + rnd.choice(["", "<|endoftext|>", " don't"])
        assert list(fast(t)) == encode(t)[:-1]


def test_usual_texts_do_not_load_the_tokenizer_file(monkeypatch):
    import tokenizers

    class Unread:
        @staticmethod
        def from_file(path):
            raise AssertionError("read for usual texts")

    want = tokenizer().encode("Usual text: é, 12.", add_special_tokens=False).ids
    monkeypatch.setattr(tokenizers, "Tokenizer", Unread)
    ids = packing.byte_bpe()
    assert ids("Usual text: é, 12.") == want
    with pytest.raises(AssertionError, match="read for usual"):
        ids("\u6f22")


def test_sum_of_squares_rule():
    lengths = np.array([600, 424, 600, 300, 124, 1024, 1])
    bins, offsets = packing.sum_of_squares(lengths, 1024)
    assert bins[0] == bins[1] and offsets[1] == 600 and bins[2] == bins[3] == bins[4] and (bins == bins[5]).sum() == 1


# Top-k ---------------------------------------------------------------------------------------


def test_topk_edges_and_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, [float(rnd.randint(-3, 3)) / 256 for _ in range(4)], 0) for i in range(120)]
    rows += [(200, None, 0), (250, [1.0, None, 1.0, 1.0], 0), (300, [float("nan")] * 4, 0), (350, [float("inf")] * 4, 0), (None, [1.0] * 4, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, block_rows=7).collect())
    v = {i: np.floor(256 * np.array(e)).astype(int) for i, e, _ in rows[:120]}
    want = []
    for q in range(0, 120, 50):
        best = sorted(((-int(v[q] @ v[d]), d) for d in v if d != q))[:5]
        want += [(q, i + 1, d, -s) for i, (s, d) in enumerate(best)]
    assert got == want
    assert topk.top_k(df.limit(0)).count() == 0


def brute_topk(rows, k, every):
    """Whole-number scores of every row with every query row; ranks follow them, results stay within 64 bits."""
    v = [(d, [math.floor(256 * x) for x in e]) for d, e in rows]
    out = []
    for i, (q, a) in enumerate(v):
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), d) for j, (d, b) in enumerate(v) if j != i)[:k]
            out += [(q, n + 1, d, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, d) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["huge", "wide", "repeated", "sparse", "lengths"])
def test_topk_of_unusual_rows(spark, kind):
    rnd = random.Random(kind)
    some = lambda n, top=1.0: [rnd.uniform(-top, top) for _ in range(n)]
    rows = {
        "huge": [(1, [1e6, 1.0]), (2, [1e6, 0.0]), (50, [2e6, 0.0]), (4, [-3e5, 2.0])],
        "wide": [(i, some(3, 10.0 ** rnd.randint(0, 15))) for i in range(60)],
        "repeated": [(rnd.choice((0, 3, 50, 51)), some(4)) for _ in range(80)],
        "sparse": [(i, some(4)) for i in range(90)] + [(10**15, some(4)), (-(10**12), some(4))],
        "lengths": [(i, some(rnd.randint(0, 5))) for i in range(70)],
    }[kind]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for options in ({}, {"cell_rows": 16, "cell_queries": 1, "block_rows": 4}):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, k=5, **options).collect())
        assert got == brute_topk(rows, 5, 50)


def test_topk_bands_hold_a_bounded_number_of_rows(spark):
    rows = spark.range(2000).select(F.when(F.col("id") == 0, 10**15).otherwise(F.when(F.col("id") < 700, 7).otherwise(F.col("id"))).alias("vec_id"), F.array(F.rand(3)).alias("embedding"))
    seen = []
    whole, topk.band_bounds = topk.band_bounds, lambda rows: (seen.append(rows.groupBy("band").count().toPandas()["count"].max()), whole(rows))[1]
    try:
        topk.top_k(rows, cell_rows=250).collect()
    finally:
        topk.band_bounds = whole
    assert seen[0] <= 600


def test_topk_prunes():
    import pandas as pd

    rows = pd.DataFrame({"row": range(1000), "vec_id": range(1000), "v": [[i, 1] for i in range(1000)]})
    _, scored = topk.best_of_cell(pd.DataFrame({"row": [-1], "vec_id": [0], "v": [[5, 0]]}), rows, 5, 50)
    assert scored <= 2


# Jaccard join -----------------------------------------------------------------------------------


def brute_components(texts, k, num, den=100):
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        n = min(k, len(w))
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for d in sorted(sets):
        met = Counter(o for s in sets[d] for o in index[s])
        for o, n in met.items():
            if den * n >= num * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
        for s in sets[d]:
            index[s].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(n, seed=1):
    """Groups of near copies around a text, with a passage that all share."""
    rnd, out = random.Random(seed), {}
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    for i in range(n):
        w = list(base) if i % 3 else [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 90))] + passage
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        out[i] = " ".join(w)
    return out


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(spark, k, num, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 12)
    texts = near_copies(120)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(df, k, num, 100).collect()}
    assert got == brute_components(texts, k, num)


def test_shared_by_pair_equals_intersections():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, top, size)) for top, size in ((30, 20), (1000, 60), (12, 9), (1000, 500), (5, 1)) * 12]
    got = jaccard_join.shared_by_pair(np.repeat(np.arange(60), [len(x) for x in sets]), np.concatenate(sets), 60)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(60) for j in range(60) if i != j)


def test_jaccard_on_documents(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs, 4, 85, 100).collect()}
    assert got == brute_components(texts, 4, 85)


def test_jaccard_edges(edge):
    got = sorted(map(tuple, jaccard_join.jaccard_groups(edge, 4, 85, 100).collect()), key=str)
    assert (1, 0, 1) in got and (2, 0, 2) in got and (4, 3, 4) in got and (8, 3, 4) in got and got.count((5, 3, 4)) == 2 and (7, 4, 6) in got
    assert (None, 2, None) in got and len(got) == 11
    assert jaccard_join.jaccard_groups(edge.limit(0)).count() == 0
    assert jaccard_join.keep_one(edge).columns == edge.columns


def test_keep_one_of_null_and_repeated_identifiers(spark):
    text = lambda tag, n=30: " ".join(f"{tag}{i}" for i in range(n))
    rows = [(1, text("a")), (None, text("a") + " z"), (None, text("b")), (4, text("c")), (4, text("a") + " y"), (7, text("c") + " x"), (8, text("d")), (None, None), (4, "")]
    got = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(map(tuple, got), key=key) == sorted([rows[i] for i in (0, 2, 3, 6, 7, 8)], key=key)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# Repeats -----------------------------------------------------------------------------------------


def brute_removed(texts, length):
    out, seen = {}, set()
    for d in sorted(texts):
        t = (texts[d] or "").encode()
        mask, own = bytearray(len(t)), set()
        for i in range(len(t) - length + 1):
            own.add(t[i : i + length])
            if t[i : i + length] in seen:
                mask[i : i + length] = b"\1" * length
        seen |= own
        kept = bytes(b for b, m in zip(t, mask) if not m)
        out[d] = (len(t), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest())
    return out


def removed(df, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df, **options).collect()}


def test_repeats_on_documents(docs, texts):
    assert removed(docs) == brute_removed(texts, 50)


@pytest.mark.parametrize("letters,hot", [("ab", 5000), ("abcd é", 3)])
def test_repeats_equal_brute_force(spark, letters, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "CHUNK", 200)
    rnd = random.Random(3)
    parts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 40))) for _ in range(12)]
    texts = {i: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert removed(df, length=16, k=6) == brute_removed(texts, 16)


def test_repeats_edges(edge):
    got = repeats.remove_repeats(edge).toPandas()
    assert len(got) == edge.count()
    assert got[got.doc_id == 7].n_removed.tolist() == [len(LONG)] and got[got.doc_id == 6].n_removed.tolist() == [0]
    assert repeats.remove_repeats(edge.limit(0)).count() == 0


def test_repeats_give_the_kept_text(spark):
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdé fg") for _ in range(n))
    passage, own = word(90), word(60)
    rows = [(1, passage), (2, passage), (3, own + passage + "tail"), (4, "short"), (5, None)]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {1: passage, 2: "", 3: own + "tail", 4: "short", 5: ""}
    assert {d: bytes(r.kept_text).decode() for d, r in got.items()} == want
    for d, text in rows:
        r, kept = got[d], want[d].encode()
        assert (r.n_bytes, r.n_removed, r.kept_sha256) == (len((text or "").encode()), len((text or "").encode()) - len(kept), hashlib.sha256(kept).hexdigest())
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in repeats.kept_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    at = len(own.encode())
    assert spans == {1: [], 2: [(0, len(passage.encode()))], 3: [(at, at + len(passage.encode()))], 4: [], 5: []}


def test_repeats_of_null_and_repeated_identifiers(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    shared, whole, clean, other = word(80), word(90), word(200), word(70)
    rows = [(1, shared + word(60)), (2, whole), (5, word(30) + shared), (5, clean), (5, whole), (5, word(100) + other), (9, other + word(40)),
            (None, word(55) + shared + word(10)), (None, clean + word(20)), (None, whole), (None, word(150)), (None, other), (None, None), (7, "x" + clean[:60]), (7, "x" + clean[:60])]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    strings = lambda t: {t[i : i + 50] for i in range(len(t) - 49)}
    want = []
    for d, t in rows:
        b = (t or "").encode()
        seen = set().union(*[strings((u or "").encode()) for c, u in rows if c is not None and (d is None or c < d)])
        mask = bytearray(len(b))
        for i in range(len(b) - 49):
            if b[i : i + 50] in seen:
                mask[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, m in zip(b, mask) if not m)
        want.append((d is None, d or 0, len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_maximal_repeats_name_all_occurrences():
    rnd = random.Random(9)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 40))) for _ in range(12)]
    got = {}
    for n, who, at in suffixes.maximal_repeats(strings, np.zeros(len(strings), np.int64), 4, 200):
        assert (text := strings[who[0]][at[0] : at[0] + n]) not in got
        got[text] = sorted(zip(who.tolist(), at.tolist()))
    want = {}
    for n in range(4, 41):
        places = defaultdict(list)
        for i, s in enumerate(strings):
            for j in range(len(s) - n + 1):
                places[s[j : j + n]].append((i, j))
        for t, p in places.items():
            left = {strings[i][j - 1] if j else (i, "start") for i, j in p}
            right = {strings[i][j + n] if j + n < len(strings[i]) else (i, "end") for i, j in p}
            if len(p) > 1 and len(left) > 1 and len(right) > 1:
                want[t] = sorted(p)
    assert got == want


# PII ---------------------------------------------------------------------------------------------

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(t):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_brute_force(spark, texts):
    rnd = random.Random(4)
    fuzz = ["".join(rnd.choice("a1.@+ -()%x0459é\U0001f600_") for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    fuzz += ["a@b.com_x@y.com", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "5 - 4111-1111-1111-1111", "0000255.1.1.1", "1" * 30, "9" * 20_000, "a" * 20_000, "+1 " * 5000, None, "", *texts.values()]
    got = {r.doc_id: r for r in pii.scan(spark.createDataFrame(list(enumerate(fuzz)), "doc_id long, text string")).collect()}
    for i, t in enumerate(fuzz):
        base = brute_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (got[i].spans + ",").startswith("".join(s + "," for s in base))


def test_added_spans(spark):
    rows = [f'see token = "{hashlib.sha1(bytes([i])).hexdigest()}" now' for i in range(20)] + [f"call 415-555-{1000 + i} now" for i in range(20)] + [f"version {i}.22.333.44 of the page" for i in range(20)] + ["plain words without any data"] * 20
    got = [r.spans for r in pii.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert all(s.startswith("secret:13:53") for s in got[:20]) and all(s == "number:5:17" for s in got[20:40]) and not any(got[60:])


def test_pii_edges(edge):
    got = pii.scan(edge).toPandas()
    assert len(got) == edge.count() and (got.n_email == 0).all()
    assert pii.scan(edge.limit(0)).count() == 0


# Licenses ------------------------------------------------------------------------------------------


def test_licenses_edges(spark, edge):
    rows = [(1, "x Released under the MIT license! y"), (2, "permission is hereby granted free of charge to any person obtaining a copy of this software"), (3, None), (4, "mit"), (5, "all all rights rights reserved")]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "MIT"), (5, "All-rights-reserved")]  # 15 of 19 shingles of the MIT text are too few
    assert licenses.scan(edge).count() == 0 and licenses.scan(edge.limit(0)).count() == 0


def test_bands_retrieve_nearly_all_that_is_contained(spark):
    """Recall of the bands against the exact share, over templates with words lost, changed and put in."""
    rnd, rows = random.Random(6), []
    for i in range(600):
        w = rnd.choice(list(licenses.TEMPLATES.values())).split()
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = rnd.choice(["x", "y z", ""])
        fill = lambda: " ".join(rnd.choice("the of software license code a b") for _ in range(rnd.randint(0, 40)))
        rows.append((i, f"{fill()} {' '.join(w)} {fill()}"))
    got = {(r.doc_id, r.license): r.n_found for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {}
    for i, t in rows:
        own = set(licenses.template_shingles(" ".join(re.findall("[a-z0-9]+", t.lower()))))
        for name, template in licenses.TEMPLATES.items():
            s = set(licenses.template_shingles(template))
            if len(own & s) >= math.ceil(len(s) * licenses.CONTAINED - 1e-9):
                want[i, name] = len(own & s)
    assert set(got) <= set(want) and all(want[k] == n for k, n in got.items())
    assert len(want) > 300 and len(got) >= 0.995 * len(want)


# Language ----------------------------------------------------------------------------------------


def test_language_accuracy_on_held_out(spark, docs):
    got = langid.language_id(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    held = got[got.held_out]
    assert held.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2).all() and len(held) > 20
    assert (held.lang_pred == held.lang).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_switched_text_is_labelled_word_by_word(docs):
    rows = [(r.text, r.lang) for r in docs.filter("lang in ('de', 'es')").select("text", "lang").collect()]
    model = langid.train(rows)
    de, es = (next(t for t, lab in rows if lab == x and len(t.split()) > 60) for x in ("de", "es"))
    mixed = " ".join(de.split()[:40] + es.split()[:40])
    best = langid.Tagger(model).tag([mixed])[0].argmax(1)
    assert (best[:30] == model.labels.index("de")).mean() > 0.9 and (best[-30:] == model.labels.index("es")).mean() > 0.9


def test_clean_switched_text_stays(spark, docs):
    rows = {lab: [r.text for r in docs.filter(F.col("lang") == lab).limit(40).collect() if len(r.text.split()) > 60] for lab in ("de", "es", "fr", "en")}
    langs = [lab for lab, t in rows.items() if t][:3]
    switched = [(10**6 + i, " ".join(" ".join(rows[lab][0].split()[:30]) for lab in langs[:n])) for i, n in enumerate((2, 3))]
    extra = spark.createDataFrame([(i, t, None, "x", len(t)) for i, t in switched], docs.schema)
    kept = {r.doc_id for r in langid.keep_identified(docs.unionByName(extra)).filter("doc_id >= 1000000").collect()}
    assert kept == {i for i, _ in switched}


def test_features_are_taken_from_whole_words():
    long = "a" * 30 + "xyz"
    assert set(langid.features(long, {})) != set(langid.features("a" * 33, {})) and langid._GRAM["yz$"] in langid.features(long, {})


def test_forward_backward_equals_enumeration():
    import itertools

    model = langid.ChainModel(["a", "b", "c"], {})
    rng = np.random.default_rng(1)
    model.trans = rng.normal(size=(3, 3))
    chains = [rng.normal(size=(n, 3)) for n in (1, 4, 3)]
    for e, m in zip(chains, model.marginals(chains)):
        total = np.zeros_like(e)
        for path in itertools.product(range(3), repeat=len(e)):
            w = np.exp(sum(e[t, c] for t, c in enumerate(path)) + sum(model.trans[a, b] for a, b in zip(path, path[1:])))
            for t, c in enumerate(path):
                total[t, c] += w
        assert np.allclose(m, total / total.sum(1, keepdims=True))


def test_tagging_holds_one_text_of_words_at_a_time():
    import tracemalloc

    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(500)]
    texts = [" ".join(rnd.choices(words, k=400)) for _ in range(2000)]
    model = langid.ChainModel(["a", "b", "c", "d"], {})
    tracemalloc.start()
    try:
        found = langid.Tagger(model).tag(texts)
        most = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert [len(m) for m in found] == [400] * 2000
    assert most < 100  # the marginals returned are 26 MB


def test_labels_do_not_depend_on_steps(monkeypatch):
    import pyarrow as pa

    model = langid.train([("el gato negro come pescado fresco", "es"), ("the black cat eats fresh fish", "en")] * 5)
    texts = [None, "", "the cat", "el gato " * 50, "1 2 3", "fresh fish", "pescado fresco y the cat"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "_text"])
    label = lambda batches: [r for b in langid.labelled(iter(batches), model) for r in b.to_pylist()]
    whole = label([batch.slice(0, 0), batch])
    assert [r["doc_id"] for r in whole] == list(range(len(texts))) and {r["lang_pred"] for r in whole} == {"und", "en", "es"}
    steps = langid.steps
    for rows, most in ((1, 10), (4, 30), (100, 100)):
        runs = list(steps(np.array([len(t or "") for t in texts]), rows, most))
        assert [i for s, n in runs for i in range(s, s + n)] == list(range(len(texts)))
        assert all(n <= rows and (n == 1 or sum(len(t or "") for t in texts[s : s + n]) <= most) for s, n in runs)
        monkeypatch.setattr(langid, "steps", lambda lengths, rows=rows, most=most: steps(lengths, rows, most))
        for a, b in zip(label([batch.slice(0, 9), batch.slice(9)]), whole, strict=True):
            assert (a["doc_id"], a["lang_pred"], a["n_switches"]) == (b["doc_id"], b["lang_pred"], b["n_switches"]) and abs(a["score"] - b["score"]) < 1e-9


def test_language_edges(edge):
    got = langid.language_id(edge).toPandas()
    assert len(got) == edge.count() and set(got[got.doc_id.isin([1, 2, 3])].lang_pred) == {"und"}
    assert langid.language_id(edge.limit(0)).count() == 0
    assert set(langid.language_id(edge.withColumn("lang", F.lit(None).cast("string"))).toPandas().lang_pred) == {"und"}
    assert langid.keep_identified(edge).columns == edge.columns


# Quality -------------------------------------------------------------------------------------------


def test_resampling_prefers_good_documents(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = quality.resample(docs, labels)
    assert got.count() == docs.count()
    kept = got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).toPandas().set_index("quality").share
    assert kept[1] > 0.9 > 0.5 > kept[0]


def test_resampling_equals_brute_force(spark):
    """Kept rows against an own count of the models, over repeated rows, ties, nulls and a very long text."""
    rnd = random.Random(11)
    word = lambda: rnd.choice("good fine clear text bad noise junk spam a b c d e f".split())
    rows = [(i, " ".join(word() for _ in range(rnd.randint(0, 30)))) for i in range(150)]
    rows += [(3, rows[3][1]), (3, "another text of three"), (None, None), (None, "no identifier"), (None, "no identifier"), (200, LONG)]
    good = {i: int(rows[i][1].count("good") + rows[i][1].count("clear") > 2) for i in range(0, 150, 2)}
    marks = spark.createDataFrame([*good.items(), (200, 1), (7, None), (None, 1)], "doc_id long, quality int")
    got = quality.resample(spark.createDataFrame(rows, "doc_id long, text string"), marks).collect()
    cache = quality.WordHashes()
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(quality.grams(t, cache).tolist())
        if good.get(d) or d == 200:
            target.update(quality.grams(t, cache).tolist())
    p = lambda c, g: math.log((c[g] + 1) / (sum(c.values()) + quality.BUCKETS))
    want = sorted((d is None, d or 0, round(sum(p(target, g) - p(raw, g) for g in quality.grams(t, cache).tolist()), 6)) for d, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, round(r.log_weight, 6)) for r in got) == want
    k = int(len(rows) * (sum(good.values()) + 1) / (len(good) + 1))
    assert sum(r.kept for r in got) == k
    assert min(r.gumbel_key for r in got if r.kept) >= max(r.gumbel_key for r in got if not r.kept)


def test_resampling_keeps_k(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") / 7).alias("key"))
    for k in (1, 100, 250, 499):
        low, high, left = quality.kth_largest(rows, "key", k, enough=5, bins=4)
        assert rows.filter(F.col("key") > high).count() + left == k and rows.filter(F.col("key").between(low, high)).count() >= left


def test_resampling_edges(spark, edge):
    none = spark.createDataFrame([(1, None), (None, 1), (999, 1)], "doc_id long, quality int")
    assert quality.resample(edge, none).filter("kept").count() == edge.count()
    assert quality.resample(edge.limit(0), none.limit(0)).count() == 0


# Pipeline ------------------------------------------------------------------------------------------


CLASH = ["_id", "_doc_id", "_sha", "_h", "n_taken", "_source", "_size", "_text_sha256", "_place", "_lab", "node", "key", "a.b"]


@pytest.fixture(scope="module")
def clash(edge):
    return edge.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


def test_stages_keep_columns_of_any_name(clash):
    rows = [clash, clash.limit(0)]
    for df in rows:
        for f in (langid.keep_identified, exact_dedup.exact_dedup, jaccard_join.keep_one, mixing.mixed):
            got = f(df)
            assert got.columns == df.columns, f.__name__
            assert all(r[c] == f"own {c}" for r in got.collect() for c in CLASH), f.__name__


def test_pipeline_of_edge_tables(spark, clash, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    labelled = [(100 + i, " ".join(random.Random(i).sample(pool, 8)), lang, "a", 0, 1, "x", *[f"own {c}" for c in CLASH]) for i in range(20)
                for lang, pool in (("en", "the of and to in is that for it was with".split()), ("de", "der die und das ist nicht mit von auf ein".split()))]
    for name, rows in (("edge", clash.unionByName(spark.createDataFrame(labelled, clash.schema))), ("none", clash.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").toPandas()
        assert list(got.columns) == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (len(got) > 0) == (name == "edge")
        assert not len(got) or (got.groupby("sequence_id").length.sum() <= 1024).all()


def test_pipeline_stages(spark, sf_dir, docs):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows, last = docs, None
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, rows, sf_dir))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        if name == "exact_dedup":
            assert out.count() == rows.select(exact_dedup.normalised(F.col("text"))).distinct().count()
        if name == "ngram_jaccard_join":
            want = brute_components({r.doc_id: r.text for r in rows.collect()}, 5, 80)
            assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c in want.values()})
        rows, last = out, rows
    got = rows.toPandas()
    assert sorted(set(got.doc_id)) == sorted(r.doc_id for r in last.select("doc_id").distinct().collect())
    assert (got.groupby("sequence_id").length.sum() <= 1024).all()
