"""Conversation repair, collocations and archives against brute force, and their edge rows."""

import gzip
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from garimpo.llm import collocations, conversations, warc
from garimpo.llm.common import Scratch, shared_dir

CONV = "conv_id long, turn long, role string, text string, cell string, place int"


# Conversations ---------------------------------------------------------------------------


def cheapest(rows, most=2):
    """(cost, audit, turns) by trying every edit of (role, text, fault) rows, up to ``most`` insertions at a place."""
    best = None

    def ok(roles):
        return re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r in roles))

    def go(i, cost, audit, turns):
        nonlocal best
        if best and cost > best[0]:
            return
        for k in range(most + 1):
            for roles in itertools.product(("user", "assistant"), repeat=k):
                new = turns + [(r, "") for r in roles]
                c, a = cost + 5 * k, audit + "I" * k
                if i == len(rows):
                    if ok([r for r, _ in new]) and (best is None or (c, a) < best[:2]):
                        best = (c, a, new)
                    continue
                role, text, fault = rows[i]
                go(i + 1, c + 2, a + "D", new)
                if fault in ("blank", "duplicate"):
                    continue
                extra = 5 if fault == "truncated" else 0
                go(i + 1, c + extra, a + "K", new + [(role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, c + 1 + extra, a + "R", new + [(r, text)])

    go(0, 0, "", [])
    return best


def faults(rows):
    """Faults of (role, text) rows in order."""
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else None if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def test_cells_equal_every_edit_at_every_split():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool", " "]), f"t{k}.", rng.choice([None, None, "blank", "duplicate", "truncated"])) for k in range(rng.randrange(5))]
        cells = [conversations._CELLS[r[0][0] if r[0][0] in "sua" else "?", r[2]] for r in rows]
        want = cheapest(rows)
        chart = conversations.Chart()
        for c in cells:
            chart.add(c)
        assert conversations.best(chart.cell()) == want[:2]
        if len(cells) > 1:  # the classic chart, all splits of all spans
            table = {(i, i + 1): c for i, c in enumerate(cells)}
            for n in range(2, len(cells) + 1):
                for i in range(len(cells) - n + 1):
                    splits = [conversations.times(table[i, k], table[k, i + n]) for k in range(i + 1, i + n)]
                    assert all(s == splits[0] for s in splits)
                    table[i, i + n] = splits[0]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def expected(rows):
    """What op11 returns for each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = damaged([r for r in rows if r[0] == conv])
        turns = {r[1] for r in own if r[1] is not None}
        lines = [(r[2], r[3]) for r in own]
        f = faults(lines)
        cost, audit, new = cheapest([(*x, y) for x, y in zip(lines, f)])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(lines))
        text = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in new).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, text)
    return out


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(40), None]:
        for _ in range(rng.randrange(1, 6)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "No", " ", "", None, "So\n?", "x!  \n"])))
    rows += rows[:3]  # repeated rows
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_conversations_equal_brute_force(spark, talks, parts):
    df = spark.createDataFrame([(*r, "x", 1) for r in talks], CONV)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)  # runs of one conversation in several tasks
    try:
        got = conversations.digests(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(talks) and len(got) == 41


def test_a_long_conversation_is_spread(spark):
    """Most rows in one conversation: the same answer, from several tasks."""
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(3000)] + [(i, 0, "user", "a.") for i in range(10, 20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV)
    scratch = Scratch(spark)
    each = scratch.stored(conversations._later(conversations.marked(df)))
    dealt = each.repartitionByRange(8, "conv", "turn", "role", "digest").sortWithinPartitions("conv", "turn", "role", "digest")
    parts = conversations.runs(dealt).groupBy("conv").count().collect()
    assert max(r["count"] for r in parts) > 3
    got = {r.conv_id: r for r in conversations.repair(df).groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.col("edit") == "K").alias("k")).collect()}
    assert (got[7].n, got[7].k) == (3000, 3000) and set(got) == {7}  # a single turn is cheapest deleted
    kept = damaged([r for r in rows if r[0] == 7])
    turns = {r[1] for r in kept}
    one = conversations.digests(df).filter("conv_id = 7").first()
    assert len(one.audit.replace("I", "")) == len(kept) and one.gaps == max(turns) - min(turns) + 1 - len(turns)


def test_no_conversations(spark):
    df = spark.createDataFrame([], CONV)
    assert conversations.digests(df).count() == 0 and conversations.repair(df).count() == 0


def test_conversation_of_dropped_rows(spark):
    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    r = conversations.digests(spark.createDataFrame([(conv, 1, "user", "Hi.", "x", 1)], CONV)).first()
    assert tuple(r) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# Collocations ------------------------------------------------------------------------------


def phrases_of(docs, least, top, share=80, depth=4):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = {(lang, p[i : i + m]) for (lang, p), a in cands.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= share * f[lang, p[i : i + m]]}
    out = {}
    for (lang, p), a in cands.items():
        if (lang, p) in gone:
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i): (p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)}


def as_phrases(df):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


DOC = "doc_id long, text string, lang string, n long, h string, ws string, word string"


@pytest.fixture(scope="module")
def speech(spark):
    rng = random.Random(11)
    vocab = ["the", "of", "a", "Über", "naïve", "x", "y\x00z", "n't", "—"] + [f"w{i}" for i in range(25)]
    docs = [(rng.choice(["en", "de", None]), "".join(rng.choice(vocab) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "; ", " "]) for _ in range(rng.randrange(80)))) for _ in range(150)]
    docs += [("en", "hot pair goes on " * 400), ("en", "Hot Pair. " * 300), ("xx", "one two"), ("en", None), (None, ""), ("de", "..!?\n")]
    return docs


@pytest.mark.parametrize("part", [1, 1 << 14])
@pytest.mark.parametrize("top", [5, 2000])
def test_collocations_equal_brute_force(spark, speech, part, top, monkeypatch):
    monkeypatch.setattr(collocations, "STEP", 500)  # many batches
    docs = spark.createDataFrame([(i, t, lang, 1, "x", "y", "z") for i, (lang, t) in enumerate(speech)], DOC).repartition(3)
    got = as_phrases(collocations.collocations(docs, least=3, top=top))
    assert got == phrases_of(speech, 3, top) and len(got) > 5
    if top == 5:
        assert collocations.collocations(docs.limit(0)).count() == 0


@pytest.mark.parametrize("part", [2, 7, 1 << 14])
def test_three_way_quicksort_counts(part, monkeypatch):
    monkeypatch.setattr(collocations, "PART", part)
    rng = np.random.default_rng(2)
    keys = rng.integers(1, 6, (4, 3000)).astype(np.uint64)
    cut = rng.integers(1, 5, 3000)
    for d in range(1, 4):
        keys[d, cut <= d] = 0
    n = rng.integers(1, 4, 3000)
    for least in ([20] * 4, [1, 1, 1, 40]):
        want = Counter()
        for col, w in zip(keys.T.tolist(), n.tolist()):
            for k in range(2, 5):
                if col[k - 1]:
                    want[tuple(col[:k])] += w
        want = {p: c for p, c in want.items() if c >= least[len(p) - 1]}
        rows, lengths, counts = collocations.frequent(keys, n, least)
        got = {tuple(keys[:k, r].tolist()): c for r, k, c in zip(rows, lengths.tolist(), counts.tolist())}
        assert got == want and len(rows) == len(want)


def test_words_of_equal_hash_take_another_seed(spark, monkeypatch):
    real = collocations.xxhash.xxh64_intdigest
    monkeypatch.setattr(collocations.Hashes, "__missing__", lambda self, w: 0 if w == b"." else 5 if self.seed == 0 else real(w, self.seed))
    docs = [("en", "red car. blue car. red car. red car") for _ in range(3)]
    df = spark.createDataFrame([(1, t, lang, 1, "x", "y", "z") for lang, t in docs], DOC)
    # Tasks import the module anew, so collisions are shown on the driver alone.
    h = collocations.Hashes(0)
    assert h[b"red"] == h[b"car"] and collocations.Hashes(1)[b"red"] != collocations.Hashes(1)[b"car"]
    assert as_phrases(collocations.collocations(df, least=3)) == phrases_of(docs, 3, 2000)


# Archives ------------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string, main string, record_type string, payload string, n long"
TRAP = "<p>WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.0\r\nWARC-Type: metadata\r\n</p>\r\n\r\n" * 3


@pytest.fixture(scope="module")
def site(spark):
    same = "é" * 60
    rows = [(5, "http://a.example/5", same), (3, "http://a.example/3?q=1#f", same), (9, None, same), (9, None, same), (1, "u\r\nX-Evil: 1", "x" * 99), (2, "http://b.example", "x" * 99),
            (4, "http://b.example/WARC/1.1", TRAP), (6, "http://b.example/6", TRAP), (None, "http://c.example", None), (None, None, ""), (7, "http://d.example/7", "WARC/1."), (8, "http://d.example/8", "long " * 200_000)]
    return [(*r, "m", "t", "p", 1) for r in rows]


def want_pages(rows):
    out = []
    for r in rows:
        html = (r[2] or "").encode()
        own = [x for x in rows if (x[2] or "").encode() == html and x[0] is not None]
        head = min((x[0] for x in own), default=None)
        again = len(html) >= 100 and head is not None and r[0] != head
        out.append((r[0], len(html), hashlib.sha256(html).hexdigest(), "revisit" if again else "response", head if again else None))
    return Counter(out)


def test_archives_round_trip(spark, site):
    path = shared_dir(spark)
    got = warc.round_trip(spark.createDataFrame(site, PAGE), path)
    assert Counter(map(tuple, got.collect())) == want_pages(site)
    scratch = Scratch(spark)
    rows = warc.captures(warc.records(spark, path), scratch).collect()
    assert len(rows) == len(site)
    by_uri = {r.target_uri: r for r in rows}
    assert bytes(by_uri["http://b.example/WARC/1.1"].response.payload).decode() == TRAP and by_uri["http://b.example/WARC/1.1"].response.whole
    again = by_uri["http://a.example/5"]
    assert (again.record_type, bytes(again.response.payload), again.of.target_uri, again.of.payload_bytes) == ("revisit", b"", "http://a.example/3?q=1#f", 120)
    assert again.requests[0].block_head.startswith("GET /5 HTTP/1.1\r\nHost: a.example") and "page_id: 5" in again.metadata[0].payload
    assert all(r.response.declared_digest == r.response.payload_digest for r in rows if r.record_type == "response")
    assert "u%0D%0AX-Evil: 1" in by_uri
    scratch.clear()
    empty = spark.createDataFrame([], PAGE)
    assert warc.round_trip(empty).count() == 0


def record(kind, rid, block, **fields):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{rid}>\r\n" + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    return f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """A member for each record, plain files cut into splits, links from either side and through others, records cut short."""
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    a = [record("warcinfo", "i", b"software: x\r\n"), record("response", "r1", http + b"one WARC/1.0 two", WARC_Concurrent_To="<q1>", Content_Type="application/http"), record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", Content_Type="application/http"),
         record("metadata", "m1", b"k: v", WARC_Concurrent_To="<q1>"), record("resource", "r2", b"\x00\xff\xfe raw"), record("metadata", "m2", b"lost", WARC_Concurrent_To="<nowhere>")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in a))
    rng = random.Random(1)
    bodies = {f"p{i}": bytes(rng.choice(b"abc\r\nWARC/1.") for _ in range(rng.randrange(3000))) for i in range(60)}
    plain = b"".join(record("response", k, http + v, Content_Type="application/http") for k, v in bodies.items())
    (tmp_path / "b.warc").write_bytes(plain + record("response", "cut", b"x" * 500)[:-200])
    (tmp_path / "none.warc").write_bytes(b"no record here")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        scratch = Scratch(spark)
        found = warc.records(spark, str(tmp_path))
        rows = {r.record_id.strip("<>"): r for r in warc.captures(found, scratch).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert set(rows) == {"r1", "r2", "cut", *bodies}
    assert all(bytes(rows[k].response.payload) == v and rows[k].response.whole for k, v in bodies.items())
    assert bytes(rows["r1"].response.payload) == b"one WARC/1.0 two" and bytes(rows["r2"].response.payload) == b"\x00\xff\xfe raw"
    assert [x.record_id for x in rows["r1"].requests] == ["<q1>"] and [x.payload for x in rows["r1"].metadata] == ["k: v"]
    assert not rows["cut"].response.whole and rows["r2"].requests in (None, [])
    scratch.clear()


# Families of near copies, and languages written at length ---------------------------------------


def test_a_family_of_near_copies_does_not_multiply(spark, monkeypatch):
    """One text with twelve words changed in each copy: what is sent on stays near the size of the family at every level, though two pairs do link."""
    from garimpo.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "SMALL", 64)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(400):
        t = list(base)
        for j in rng.sample(range(400), 12):
            t[j] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(t))
    texts += [texts[7].replace("w5 ", "q "), texts[9] + " more"]
    sent, real = [], jaccard_join._next_regions

    def counted(near, *rest):
        out = real(near, *rest)
        sent.append((near.count(), out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "_next_regions", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85, 100).collect()}
    assert got == {i: {400: 7, 401: 9}.get(i, i) for i in range(402)}
    assert sent and all(copies <= 4 * sets for sets, copies in sent)


def test_a_language_of_long_texts_alone_is_learned(spark):
    from garimpo.llm import langid

    rng = random.Random(2)
    de, xx = ["und", "der", "die", "nicht", "wir", "haben"], ["zyq", "qorx", "vuxi", "wyzzo", "xaq", "quvy"]
    rows = [(i, " ".join(rng.choice(de) for _ in range(60)), "de") for i in range(40)] + [(40 + i, " ".join(rng.choice(xx) for _ in range(8000)), "xx") for i in range(20)]
    assert all(len(t) > langid.FIT_CHARS for _, t, lang in rows if lang == "xx")
    got = {r.doc_id: r.lang_pred for r in langid.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    assert max(len(t) for t, lang in langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10) if lang == "xx") == langid.FIT_CHARS


def test_cells_that_no_query_visits_get_no_rows(spark):
    from garimpo.llm import topk

    rows = spark.createDataFrame([(b, i, i, [1.0]) for i, b in enumerate([0, 0, 1, 2, 2, 2])], "band int, row long, vec_id long, v array<double>")
    cells = spark.createDataFrame([(7, 0), (8, 0), (7, 2)], "grp int, band int")
    for most in (3, topk.FEW_CELLS + 1):
        assert sorted((r.grp, r.row) for r in topk.for_cells(rows, cells, most).collect()) == [(7, 0), (7, 1), (7, 3), (7, 4), (7, 5), (8, 0), (8, 1)]


def test_packing_needs_hardly_more_than_best_fit(spark, sf_dir):
    from garimpo.llm import packing

    got = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("length", "sequence_id").toPandas()
    falling = np.sort(got.length.to_numpy())[::-1]
    alone = packing.best_fit(falling)[0].max() + 1
    assert alone <= got.sequence_id.nunique() <= alone + max(2, alone // 250)
    bins, offsets = packing.best_fit(np.array([700, 600, 400, 300, 24, 1024, 2000]))
    assert bins.tolist() == [0, 1, 1, 0, 0, 2, 3] and offsets.tolist() == [0, 0, 600, 700, 1000, 0, 0]
