"""Repair of conversations: the cheapest edits after which roles follow ``(s?(ua)+)?``.

*Grammar.*  In Chomsky normal form: a nonterminal ``pq`` for each pair of states (``e`` nothing yet, ``s`` after
the system turn, ``u`` and ``a`` after a user's and an assistant's), with ``pq -> pr rq``.  The cell of a span and a nonterminal is the
least ``(cost, audit)`` of all edits of the span's rows that lead from p to q; audits are the edits' initials in order.  A row's own
cell holds keeping, a new role and deletion, followed by the *insertion closure*: the cheapest turns that lead from each state to each other.

*Bottom-up by span length.*  A path from p to q passes some state between any two rows, so a longer span has
the same cell at every split.  Spans are therefore combined by doubling length, one split each, and a conversation of n turns takes
O(n) products instead of O(n^3); that all splits agree is tested.  Equally cheap audits of one span never
begin one another, as an audit determines its cost, so the least of a whole is made of the least of its parts.

*Distribution.*  Rows are sorted by range partitions of (conversation, turn), so a conversation of any size is spread; every task
combines the runs of its rows, and the few runs of a conversation are combined by their order.  The hash of the repaired
text is sequential by nature: it streams, in order, through one task for each conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import Scratch, partitions, stored

STATES = "esua"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: (role initial, from state, to state): the turns that the pattern allows.
TURNS = {"s": (("e", "s"),), "u": (("e", "u"), ("s", "u"), ("a", "u")), "a": (("u", "a"),)}
#: States in which a conversation may end.
FINAL = ("e", "a")
Cell = dict[str, tuple[int, str]]
FAULTS = ("blank", "duplicate", "truncated")
NO_WORD, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


def _least(cell: Cell, key: str, cost: int, audit: str) -> None:
    if key not in cell or (cost, audit) < cell[key]:
        cell[key] = (cost, audit)


def times(x: Cell, y: Cell) -> Cell:
    """The cell of two neighbouring spans: ``pq -> pr rq``."""
    out: Cell = {}
    for pr, (c, a) in x.items():
        for rq, (d, b) in y.items():
            if pr[1] == rq[0]:
                _least(out, pr[0] + rq[1], c + d, a + b)
    return out


def _closure() -> Cell:
    """Cheapest insertions from each state to each other, none included."""
    one: Cell = {p + q: (INSERT, "I") for role in "ua" for p, q in TURNS[role]}
    out: Cell = {p + p: (0, "") for p in STATES}
    for _ in STATES:
        for key, (cost, audit) in times(out, one).items():
            _least(out, key, cost, audit)
    return out


CLOSURE = _closure()


def row_cell(initial: str, fault: str | None) -> Cell:
    """A row's own edits, and insertions behind it."""
    own: Cell = {p + p: (DELETE, "D") for p in STATES}
    if fault not in ("blank", "duplicate"):
        extra = CUT if fault == "truncated" else 0
        for p, q in TURNS.get(initial, ()):
            _least(own, p + q, KEEP + extra, "K")
        for role in "ua":
            for p, q in TURNS[role]:
                _least(own, p + q, REROLE + extra, "R")
    return times(own, CLOSURE)


_CELLS = {(i, f): row_cell(i, f) for i in "sua?" for f in (None, *FAULTS)}


def best(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation, insertions before its first row included."""
    whole = times(CLOSURE, cell)
    return min(whole["e" + q] for q in FINAL if "e" + q in whole)


class Chart:
    """Cells of a growing span: neighbouring spans of equal length become one of twice the length."""

    def __init__(self):
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, length: int = 1) -> None:
        self.spans.append((length, cell))
        while len(self.spans) > 1 and self.spans[-2][0] <= self.spans[-1][0]:
            (m, x), (n, y) = self.spans[-2:]
            self.spans[-2:] = [(m + n, times(x, y))]

    def cell(self) -> Cell:
        out = None
        for _, x in reversed(self.spans):
            out = x if out is None else times(x, out)
        return out or {p + p: (0, "") for p in STATES}


def damage(rows: DataFrame) -> DataFrame:
    """Rows (``conv_id, turn, role, text``) as a broken export leaves them, by ``crc32(conv_id:turn) % 20``; nulls: one space.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` from it, 3 repeats it, 4 makes its role ``user``.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times_ = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times_).alias("again")).drop("again")


_ROW = "conv string, turn long, role string, initial string, blank boolean, ended boolean, later boolean, n long"
_RUN = (
    "conv string, place int, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, cell map<string,struct<cost:long,audit:string>>"
)


def marked(rows: DataFrame) -> DataFrame:
    """Distinct rows with how often they are there (``n``), whether blank, ended, and seen before in another row of the conversation.

    A conversation's rows are ordered by turn (null first), then role, then the text's MD5.
    """
    known = rows.select(
        F.to_json(F.struct("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text", F.md5(F.col("text").cast("binary")).alias("digest"))
    each = known.groupBy("conv", "turn", "role", "digest", "text").agg(F.count("*").alias("n"))
    return each.select("*", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(NO_WORD)).alias("blank"), F.col("text").rlike(ENDED).alias("ended"))


def _later(each: DataFrame) -> DataFrame:
    """``marked`` rows with ``later``: whether role and text came with an earlier turn.

    Only what comes at several turns is joined, so the partial counts of a hot text carry the load.
    """
    many = each.groupBy("conv", "role", "digest").agg(F.count("*").alias("k"), F.min(F.struct(F.col("turn").isNotNull().alias("there"), "turn")).alias("first")).filter("k > 1")
    many = many.select("conv", "role", "digest", F.col("first.turn").alias("first_turn"), F.lit(True).alias("shared"))
    found = each.join(many, ["conv", "role", "digest"], "left")
    return found.withColumn("later", F.col("shared").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))).drop("shared", "first_turn")


def fault(blank: bool, later: bool, ended: bool) -> str | None:
    return "blank" if blank else "duplicate" if later else None if ended else "truncated"


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


class Run:
    """What one task knows of a conversation: counts and the chart of its rows, in order."""

    def __init__(self, conv):
        self.conv, self.chart, self.counts = conv, Chart(), dict.fromkeys((*FAULTS, "illegal"), 0)
        self.first_turn = self.last_turn = self.turns = None
        self.first = self.last = None

    def add(self, r) -> None:
        turn = None if pd.isna(r.turn) else int(r.turn)
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, (self.turns or 0) + 1
        initial = r.initial if r.initial in "sua" and r.initial else "?"
        for k in range(r.n):  # equal rows: all but the first were seen
            f = fault(r.blank, r.later or k > 0, r.ended)
            if f:
                self.counts[f] += 1
            if self.last is not None:
                self.counts["illegal"] += not _legal(self.last, initial)
            self.first, self.last = self.first or initial, initial
            self.chart.add(_CELLS[initial, f])

    def row(self, place: int) -> tuple:
        cell = {k: {"cost": c, "audit": a} for k, (c, a) in self.chart.cell().items()}
        return (self.conv, place, self.first_turn, self.last_turn, self.turns or 0, *self.counts.values(), self.first, self.last, cell)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [x.split(" ")[0] for x in schema.split(", ")]
    out = pd.DataFrame(rows, columns=names, dtype=object)
    for c in ("first_turn", "last_turn"):
        if c in names:
            out[c] = out[c].astype("Int64")
    return out


def runs(sorted_rows: DataFrame) -> DataFrame:
    """One row of ``_RUN`` for each conversation of each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, done = None, []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if own is None or r.conv != own.conv:
                    if own:
                        done.append((own, place))
                    own, place = Run(r.conv), int(r.place)
                own.add(r)
            yield _frame([o.row(p) for o, p in done], _RUN)
            done = []
        if own:
            yield _frame([own.row(place)], _RUN)

    columns = [x.split(" ")[0] for x in _ROW.split(", ")]
    return sorted_rows.select(*columns, F.spark_partition_id().alias("place")).mapInPandas(run, _RUN)


_WHOLE = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def joined(parts: DataFrame) -> DataFrame:
    """Runs of each conversation, at most one for each task, put together in order."""

    def one(rows: list) -> tuple:
        chart, total, last, low, high, turns = Chart(), dict.fromkeys((*FAULTS, "illegal"), 0), None, None, None, 0
        for r in sorted(rows, key=lambda r: r["place"]):
            for k in total:
                total[k] += r[k]
            if last is not None:
                total["illegal"] += not _legal(last, r["first_initial"])
            last = r["last_initial"]
            if r["first_turn"] is not None:
                turns += r["turns"] - (high == r["first_turn"])
                low, high = r["first_turn"] if low is None else low, r["last_turn"]
            chart.add({k: (c["cost"], c["audit"]) for k, c in dict(r["cell"]).items()})
        gaps = 0 if low is None else high - low + 1 - turns
        return (gaps, *total.values(), *best(chart.cell()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _frame([(conv, *one([x.asDict() if hasattr(x, "asDict") else x for x in rows])) for conv, rows in zip(pdf.conv, pdf.rows)], _WHOLE)

    own = F.struct(*[x.split(" ")[0] for x in _RUN.split(", ")][1:])
    return parts.groupBy("conv").agg(F.collect_list(own).alias("rows")).mapInPandas(run, _WHOLE)


_TURN = "conv string, at long, edit string, role string, text string"


def repaired(each: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of every repaired conversation in order: ``conv, at, edit`` (K, R or I), ``role, text``.

    A conversation's audit and rows stream through one task in order; nothing of it is gathered.
    """
    return _streamed(each, audits, _TURN, _Turns)


def _streamed(each: DataFrame, audits: DataFrame, schema: str, kind) -> DataFrame:
    spark = each.sparkSession
    head = audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), "audit", F.lit("").alias("text"), F.lit(0).cast("long").alias("n"))
    body = each.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", F.lit("").alias("audit"), "text", "n")
    rows = head.unionByName(body).repartition(partitions(spark), "conv").sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, out = None, []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.kind == 0:
                    if own:
                        own.close(out)
                    own = kind(r.conv, r.audit)
                else:
                    for _ in range(r.n):
                        own.row(r.role, r.text, out)
            yield _frame(out, schema)
            out = []
        if own:
            own.close(out)
            yield _frame(out, schema)

    return rows.mapInPandas(run, schema)


class _Turns:
    """Applies an audit to the rows of its conversation, in order."""

    def __init__(self, conv: str, audit: str):
        self.conv, self.audit, self.at, self.turns, self.state = conv, audit, 0, 0, "e"

    def put(self, edit: str, role: str, text: str, out: list) -> None:
        out.append((self.conv, self.turns, edit, role, text))

    def _turn(self, edit: str, role: str | None, text: str, out: list) -> None:
        if role is None:  # a new or inserted turn takes the role that the pattern asks for
            role = "assistant" if self.state == "u" else "user"
        self.state = role[0]
        self.put(edit, role, text, out)
        self.turns += 1

    def _inserted(self, out: list) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._turn("I", None, "", out)

    def row(self, role: str, text: str, out: list) -> None:
        self._inserted(out)
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self._turn(edit, role if edit == "K" else None, text, out)

    def close(self, out: list) -> None:
        self._inserted(out)


class _Digest(_Turns):
    """The hash of the repaired turns, a line each."""

    def __init__(self, conv: str, audit: str):
        super().__init__(conv, audit)
        self.sha = hashlib.sha256()

    def put(self, edit: str, role: str, text: str, out: list) -> None:
        self.sha.update((("\n" if self.turns else "") + f"{role}:{text}").encode())

    def close(self, out: list) -> None:
        super().close(out)
        out.append((self.conv, self.sha.hexdigest()))


def audited(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(marked rows, counts and cheapest audit of each conversation that has rows)."""
    each = scratch.stored(_later(marked(rows)))
    dealt = each.repartitionByRange(partitions(rows.sparkSession), "conv", F.col("turn").asc_nulls_first(), "role", "digest")
    dealt = dealt.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "digest")
    return each, scratch.stored(joined(runs(dealt)))


def repair(rows: DataFrame) -> DataFrame:
    """The repaired turns of conversations (``conv_id, turn, role, text``): ``conv_id, at, edit, role, text``.

    Rows are taken as they are; see :func:`digests` for their order, nulls and ties.
    """
    scratch = Scratch(rows.sparkSession)
    rows = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    each, found = audited(rows, scratch)
    out = stored(repaired(each, found).select(F.from_json("conv", _conv_type(rows)).alias("c"), "at", "edit", "role", "text").select("c.conv_id", "at", "edit", "role", "text"))
    scratch.clear()
    return out


def _conv_type(rows: DataFrame):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField("conv_id", rows.schema["conv_id"].dataType)])


def digests(rows: DataFrame) -> DataFrame:
    """Damages ``rows`` (``conv_id, turn, role, text``), repairs them and gives one row for each original conversation.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost`` (longs), ``audit, repaired_sha256``.  Rows are ordered by turn, null first;
    of equal turns by role, then the MD5 of the text.  Nulls are one space in every column but the order; rows without ``conv_id`` are one
    conversation.  Repeated rows are duplicates; an empty role has no initial and is never kept.  A conversation none of whose rows is left has zeros, an empty audit and the hash of the empty
    string.  Texts and conversations of any length are taken whole; other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(rows.sparkSession)
    kind = _conv_type(rows)
    each, found = audited(damage(rows), scratch)
    hashed = _streamed(each, found, "conv string, repaired_sha256 string", _Digest)
    all_ = rows.select(F.to_json(F.struct("conv_id")).alias("conv")).distinct()
    none = hashlib.sha256(b"").hexdigest()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = all_.join(found, "conv", "left").join(hashed, "conv", "left").select(
        F.from_json("conv", kind).getField("conv_id").alias("conv_id"), *map(zero, ("gaps", *FAULTS, "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
    out = stored(out)
    scratch.clear()
    return out


def oracle() -> str:
    """SQL of :func:`digests` over ``conversations``: a fold of the rows over the cheapest way into each state."""
    way = lambda src, cost, letter, add="''": f"{{'c': {src}.c + {cost}, 'a': {src}.a || '{letter}', 'o': {src}.o || {add}}}"
    none = "{'c': 1000000000::BIGINT, 'a': '~', 'o': ''}"
    state = {p: f"x[{i}]" for i, p in enumerate(STATES, 1)}
    edited = []
    for q in STATES:
        ways = [way(state[q], DELETE, "D")]
        for role, turns in TURNS.items():
            for p in [p for p, to in turns if to == q]:
                ways.append(f"CASE WHEN r.i = '{role}' AND NOT r.gone THEN {way(state[p], f'r.p + {KEEP}', 'K', 'chr(10) || r.line')} ELSE {none} END")
                if role != "s":
                    name = "user" if role == "u" else "assistant"
                    add = f"chr(10) || '{name}:' || r.text"
                    ways.append(f"CASE WHEN NOT r.gone THEN {way(state[p], f'r.p + {REROLE}', 'R', add)} ELSE {none} END")
        edited.append(f"list_min([{', '.join(ways)}])")
    new = lambda src, role: way(src, INSERT, "I", f"chr(10) || '{role}:'")
    with_user = f"list_transform([[{', '.join(edited)}]], lambda x: [x[1], x[2], list_min([x[3], {', '.join(new(state[p], 'user') for p in 'esa')}]), x[4]])[1]"
    step = f"list_transform([{with_user}], lambda x: [x[1], x[2], x[3], list_min([x[4], {new('x[3]', 'assistant')}])])[1]"
    start = f"[{{'c': 0::BIGINT, 'a': '', 'o': ''}}, {none}, {{'c': 5::BIGINT, 'a': 'I', 'o': chr(10) || 'user:'}}, {{'c': 10::BIGINT, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}}]"
    return rf"""
        WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
        k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(4294967295, list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT),
                                            lambda c, b: xor(t.t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT)) % 20 AS kind FROM conversations, t),
        d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM k, (SELECT unnest([1, 2]) AS again) WHERE kind <> 0 AND (again = 1 OR kind = 3)),
        m AS (SELECT *, left(role, 1) AS i, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS later,
                NOT regexp_matches(text, '[.!?][ 	-
]*$') AS open, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
              FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place FROM d)),
        g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (later AND NOT blank) AS duplicate,
                count(*) FILTER (open AND NOT later AND NOT blank) AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
                list_reduce(list({{'i': i, 'gone': blank OR later, 'p': CASE WHEN open THEN {CUT} ELSE 0 END::BIGINT, 'text': text, 'line': role || ':' || text}} ORDER BY place), lambda x, r: {step}, {start}) AS x
              FROM m GROUP BY 1),
        b AS (SELECT * EXCLUDE (x), list_min([x[1], x[4]]) AS z FROM g)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(z.c, 0) AS cost, coalesce(z.a, '') AS audit, sha256(coalesce(substr(z.o, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
    """
