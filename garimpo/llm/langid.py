"""Language identification with a linear-chain conditional random field over words.

Every word is a position of the chain and gets one language.  Emission features are the
word's affixes, its inner character n-grams, its shape and whether the lexicon learned
for a language holds it; transitions between languages are learned with them.  Words are
labelled by forward-backward marginals, so text that switches between languages is
labelled word by word; a document takes the language with the largest mean marginal.

The model is fitted by maximum conditional likelihood on a bounded sample of labelled rows
(``fit_rows`` for each language, drawn by a hash of the text).  Training chains
also join pieces of two documents, so that transitions see real switches.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import fresh, without
from garimpo.llm.words import trim

BUCKETS = 1 << 15
#: Labelled rows of each language that the model is fitted on.
FIT_ROWS = 160
#: Languages that the model learns at most, the most frequent.
FIT_LABELS = 200
#: Words of one training chain; a longer text gives several.
FIT_WORDS = 400
#: Letters of one labelled row that are learned from; a longer text gives a piece of this length. With FIT_ROWS this bounds what reaches the driver.
FIT_CHARS = 20_000
#: Words of chains, with what pads them, whose marginals are held at a time.
CELLS = 200_000
#: Texts, and bytes of them, that a task labels at a time.
STEP_ROWS, STEP_BYTES = 2_000, 8_000_000
UND = "und"
_WORDS = re.compile(r"[^\W\d_]+")


class _Hashed(dict):
    """Feature name to bucket, remembered; bounded by what words of the usual letters can form."""

    def __init__(self, kind: str):
        super().__init__()
        self.kind = kind

    def __missing__(self, name: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[name] = bucket = zlib.crc32(f"{self.kind}{name}".encode()) % BUCKETS
        return bucket


_HEAD, _TAIL, _GRAM, _SHAPE = map(_Hashed, "psgx")


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features of a lower-cased word: affixes, n-grams, length, lexicon membership."""
    w = f"^{word}$"
    grams = len(w)
    out = [_HEAD[w[:2]], _HEAD[w[:3]], _HEAD[w[:4]], _TAIL[w[-2:]], _TAIL[w[-3:]], _TAIL[w[-4:]], _SHAPE[f"n{min(len(word), 12)}"]]
    out += [_GRAM[w[i : i + 2]] for i in range(grams - 1)]
    out += [_GRAM[w[i : i + 3]] for i in range(grams - 2)]
    if word in lexicon:
        out.append(_SHAPE[f"x{lexicon[word]}"])
    return out


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


class ChainModel:
    """Weights of the field: ``emit`` (buckets x labels), ``trans`` (labels x labels)."""

    def __init__(self, labels: list[str], lexicon: dict[str, int]):
        self.labels, self.lexicon = labels, lexicon
        self.emit = np.zeros((BUCKETS, len(labels)), np.float64)
        self.trans = np.zeros((len(labels), len(labels)))

    def scores(self, words: list[str], seen: dict[str, list[int]] | None = None) -> np.ndarray:
        """Emission scores of words, one row each."""
        feats = [features(w, self.lexicon) for w in words] if seen is None else [seen.get(w) or seen.setdefault(w, features(w, self.lexicon)) for w in words]
        flat = np.fromiter((i for f in feats for i in f), np.int64)
        starts = np.cumsum([0] + [len(f) for f in feats[:-1]])
        return np.add.reduceat(self.emit[flat], starts, axis=0)

    def marginals(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        """Label probabilities of every word, for a batch of chains of emission scores."""
        return [m for m, _ in self._forward_backward(chains, False)]

    def _forward_backward(self, chains: list[np.ndarray], pairs: bool):
        n, k = len(chains), len(self.labels)
        order = sorted(range(n), key=lambda i: -len(chains[i]))
        lengths = np.array([len(chains[i]) for i in order])
        t_max = int(lengths[0]) if n else 0
        e = np.ones((t_max, n, k))
        for j, i in enumerate(order):
            x = chains[i]
            e[: len(x), j] = np.exp(x - x.max(1, keepdims=True))
        a = np.exp(self.trans - self.trans.max())
        live = np.searchsorted(-lengths, -np.arange(t_max), side="left")  # chains longer than t
        alpha = np.zeros_like(e)
        for t in range(t_max):
            m = live[t]
            x = e[t, :m] if t == 0 else (alpha[t - 1, :m] @ a) * e[t, :m]
            alpha[t, :m] = x / x.sum(1, keepdims=True)
        beta = np.ones_like(e)
        at = a.T
        for t in range(t_max - 2, -1, -1):
            m = live[t + 1]
            x = (e[t + 1, :m] * beta[t + 1, :m]) @ at
            beta[t, :m] = x / x.sum(1, keepdims=True)
        gamma = np.multiply(alpha, beta, out=None if pairs else beta)
        out: list = [None] * n
        for j, i in enumerate(order):
            g = gamma[: lengths[j], j]
            g = g / g.sum(1, keepdims=True)
            two = None
            if pairs and lengths[j] > 1:
                x = alpha[: lengths[j] - 1, j, :, None] * a[None] * (e[1 : lengths[j], j] * beta[1 : lengths[j], j])[:, None, :]
                two = (x / x.sum((1, 2), keepdims=True)).sum(0)
            out[i] = (g, two)
        return out

    def fit(self, chains: list[tuple[list[str], np.ndarray]], rounds: int = 6, rate: float = 0.2, batch: int = 32, seed: int = 7) -> None:
        """AdaGrad on the conditional log-likelihood of the labelled chains."""
        rng, k = np.random.default_rng(seed), len(self.labels)
        seen: dict[str, list[int]] = {}
        ge, gt = np.full_like(self.emit, 1e-3), np.full_like(self.trans, 1e-3)
        for _ in range(rounds):
            order = rng.permutation(len(chains))
            for s in range(0, len(order), batch):
                part = [chains[i] for i in order[s : s + batch]]
                post = self._forward_backward([self.scores(w, seen) for w, _ in part], True)
                de, dt = np.zeros_like(self.emit), np.zeros_like(self.trans)
                for (words, gold), (g, two) in zip(part, post):
                    miss = np.eye(k)[gold] - g
                    feats = [seen[w] for w in words]
                    flat = np.fromiter((i for f in feats for i in f), np.int64)
                    who = np.repeat(np.arange(len(words)), [len(f) for f in feats])
                    for c in range(k):
                        de[:, c] += np.bincount(flat, miss[who, c], minlength=BUCKETS)
                    if two is not None:
                        np.add.at(dt, (gold[:-1], gold[1:]), 1.0)
                        dt -= two
                de = de / len(part) - 1e-6 * self.emit
                dt /= len(part)
                ge += de * de
                gt += dt * dt
                self.emit += rate * de / np.sqrt(ge)
                self.trans += rate * dt / np.sqrt(gt)


def train(rows: list[tuple[str, str]], lexicon_size: int = 200, seed: int = 7) -> ChainModel:
    """A model from (text, language) rows; the same rows in any order give the same model."""
    rows = sorted((t, lab) for t, lab in rows if t and lab is not None)
    labels = sorted({lab for _, lab in rows})
    index = {lab: i for i, lab in enumerate(labels)}
    texts = [(words_of(t), index[lab]) for t, lab in rows]
    texts = [(w, i) for w, i in texts if w]
    counts = [Counter() for _ in labels]
    for w, i in texts:
        counts[i].update(w)
    lexicon: dict[str, int] = {}
    for i, c in enumerate(counts):
        for word, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:lexicon_size]:
            if n > 2 and all(counts[j][word] <= n for j in range(len(labels))):
                lexicon[word] = i
    model = ChainModel(labels, lexicon)
    rng, chains = np.random.default_rng(seed), []
    # A long text gives several chains, so that all of it is used.
    pieces = [(w[s : s + FIT_WORDS], i) for w, i in texts for s in range(0, len(w), FIT_WORDS)]
    for w, i in pieces:
        chains.append((w, np.full(len(w), i)))
    for _ in range(len(pieces) // 4):
        parts = [pieces[j] for j in rng.integers(0, len(pieces), 3)]
        cut = [(w[: int(rng.integers(3, 30))], i) for w, i in parts]
        chains.append(([x for w, _ in cut for x in w], np.concatenate([np.full(len(w), i) for w, i in cut])))
    if chains:
        model.fit(chains, seed=seed)
    return model


def sample(docs: DataFrame, fit_rows: int, label: str = "lang", text: str = "text", most_labels: int = FIT_LABELS) -> list[tuple[str, str]]:
    """At most ``fit_rows`` labelled texts of each language, those with the smallest hash of the text.

    Of more than ``most_labels`` languages the most frequent are learned, so what reaches the
    driver is bounded.
    """
    rows = docs.select(F.col(label).cast("string").alias("lab"), F.col(text).cast("string").alias("t"))
    key = F.xxhash64("t", F.lit(17))
    # Of a long text a piece from a place that its hash names, so that languages written at length are learned as well.
    start = F.pmod(F.xxhash64("t", F.lit(23)), F.greatest(F.length("t") - FIT_CHARS, F.lit(0)) + 1) + 1
    piece = F.when(F.length("t") > FIT_CHARS, F.substr("t", start.cast("int"), F.lit(FIT_CHARS))).otherwise(F.col("t"))
    labelled = rows.select("lab", piece.alias("t")).filter(F.col("lab").isNotNull() & F.col("t").rlike(r"\p{L}"))
    # Many rows cannot meet in one task: a hash threshold first leaves a few times what is needed.
    counts = labelled.groupBy("lab").count().orderBy(F.desc("count"), "lab").limit(most_labels)
    rate = counts.select(F.col("lab").alias("r_lab"), (F.lit(8.0 * fit_rows) / F.col("count")).alias("rate"))
    near = labelled.join(F.broadcast(rate), F.col("lab") == F.col("r_lab")).filter(F.pmod(key, F.lit(1 << 30)) / float(1 << 30) < F.col("rate"))
    first = Window.partitionBy("lab").orderBy(key, "t")
    got = near.select("t", "lab", F.row_number().over(first).alias("k"))
    return [(r["t"], r["lab"]) for r in got.filter(F.col("k") <= fit_rows).select("t", "lab").collect()]


class _Numbers(dict):
    """Word to its number, in the order in which words are met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Tagger:
    """Applies a model to texts, keeping the scores of words it has met (a bounded number)."""

    def __init__(self, model: ChainModel, keep: int = 100_000):
        self.model, self.keep = model, keep
        self._forget()

    def _forget(self) -> None:
        self.row, self.table = _Numbers(), np.empty((0, len(self.model.labels)))

    def _numbers(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Numbers of every text's words; the words of one text at a time are held as strings."""
        if len(self.row) > self.keep:
            self._forget()
        row = self.row
        numbers = [np.fromiter(map(row.__getitem__, w), np.int32, len(w)) for w in map(words_of, texts)]
        new = list(islice(row, len(self.table), None))
        if new:
            self.table = np.concatenate([self.table, *[self.model.scores(new[s : s + 4096]) for s in range(0, len(new), 4096)]])
        return numbers

    def tag(self, texts: Iterable[str | None], cells: int = CELLS, of: Callable = lambda m: m) -> list:
        """``of(marginals)`` of every text's words; None for a text without letters."""
        words = self._numbers(texts)
        order = sorted((i for i, w in enumerate(words) if len(w)), key=lambda i: len(words[i]))
        out: list = [None] * len(words)
        while order:
            # From the longest: chains of like length share a batch of a bounded size.
            n = max(1, cells // max(1, len(words[order[-1]])))
            part, order = order[-n:], order[:-n]
            for i, m in zip(part, self.model.marginals([self.table[words[i]] for i in part])):
                out[i] = of(m)
        return out


def steps(lengths: np.ndarray, rows: int = STEP_ROWS, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """(start, number) of runs of at most ``rows`` rows and of ``most`` in all; a longer row is a run of its own."""
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and (i - start >= rows or held + n > most):
            yield start, i - start
            start, held = i, 0
        held += n
    if len(lengths) > start:
        yield start, len(lengths) - start


def _verdict(labels: list[str]) -> Callable:
    """A document's columns from its words' marginals."""

    def of(m: np.ndarray) -> tuple[str, float, float, int]:
        mean, best = m.mean(0), m.argmax(1)
        i = int(mean.argmax())
        return labels[i], float(min(1.0, max(0.0, mean[i]))), float(min(1.0, m.max(1).mean())), int((best[1:] != best[:-1]).sum())

    return of


def labelled(batches: Iterator[pa.RecordBatch], model: ChainModel) -> Iterator[pa.RecordBatch]:
    """The batches with the verdicts in place of the texts, which are their last column."""
    tagger, of = Tagger(model), _verdict(model.labels)
    for batch in batches:
        last = batch.num_columns - 1
        for s, n in steps(pc.fill_null(pc.binary_length(batch.column(last)), 0).to_numpy(zero_copy_only=False)):
            part = batch.slice(s, n)
            found = tagger.tag((x.as_py() for x in part.column(last)), of=of) if model.labels else [None] * n
            cols = zip(*[(UND, 0.0, 0.0, 0) if x is None else x for x in found])
            got = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*part.columns[:last], *got], [*batch.schema.names[:last], "lang_pred", "score", "certainty", "n_switches"])
        batch = part = None  # before the next one comes, not after
        trim()
    # Workers live on after the task; what they remember of its words would stay with them.
    for names in (_HEAD, _TAIL, _GRAM, _SHAPE):
        names.clear()
    del tagger
    trim()


def identify(docs: DataFrame, model: ChainModel, doc_id: str = "doc_id", text: str = "text", keep: tuple = ()) -> DataFrame:
    """``doc_id, lang_pred, score, certainty, n_switches`` for every row, and the columns named in ``keep``.

    ``und`` with score 0 where the text is null or has no letter.  ``score`` is the mean
    marginal of the predicted language, ``certainty`` the mean of every word's largest one;
    ``n_switches`` counts changes of the likeliest label from word to word.  Ties go to the
    language that sorts first.  Texts of any length are labelled whole, the longest alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from labelled(batches, sent.value)

    rows = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).cast("string").alias("_text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(run, f"{types}, lang_pred string, score double, certainty double, n_switches long")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Fit on the documents outside the held-out fold, then label every document.

    Only text and non-null ``lang`` of documents with crc32(doc_id) mod 4 other than 2 are
    learned from.  A table without labelled rows gives ``und`` for all.  A null identifier
    is not held out; rows that repeat one are rows of their own.
    """
    rows = sample(docs.filter(~held_out(F.col("doc_id"))), fit_rows)
    found = identify(docs, train(rows))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_switches")


def keep_identified(docs: DataFrame, fit_rows: int = FIT_ROWS, least: float = 0.5) -> DataFrame:
    """The rows whose language is told: not ``und``, and a certainty of ``least`` or more.

    Certainty is the mean over words of each word's largest marginal, so clean text that
    switches between languages stays, whatever share each of them has.  Other columns may
    have any names.
    """
    (name,) = fresh(docs, "_h")
    h = F.xxhash64(F.col("text").cast("string"))
    model = train(sample(docs.filter(~held_out(F.col("doc_id"))), fit_rows))
    found = identify(docs.select("doc_id", "text", h.alias(name)), model, keep=(name,))
    gone = found.filter((F.col("lang_pred") == UND) | (F.col("certainty") < least)).select("doc_id", F.col(name).alias("h"))
    return without(docs, gone, {"doc_id": F.col("doc_id"), "h": h})
