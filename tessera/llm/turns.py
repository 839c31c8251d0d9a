"""Conversation structure repair as lightest derivations (Knuth's agenda).

A conversation is an optional system turn and then pairs of a user's and an
assistant's turn, or nothing: role initials ``(s?(ua)+)?``.  Rows are edited
into that shape: Keep costs 0, Rerole (to user or assistant) 2, Delete 3,
Insert (an empty user or assistant turn) 2; blank and duplicate rows must go,
and a truncated row that stays adds 1.  Of the cheapest edit sequences the one
whose letters (D, I, K, R) come first in ASCII is taken.

The rules are weighted deductions over items (row, state of the shape):

    edit row i in state q    item(i + 1, q') -> item(i, q)
    insert before row i      item(i, q')     -> item(i, q)
    span of rows i to j      span(i, j, q, q') and item(j, q') -> item(i, q)

with weight (cost, rows, audit).  Letters are put in front of an audit, so a
lesser audit stays lesser; an edit adds a row and an insert a cost, so no
result is lighter than what it is made of.  The functions are then monotone
and superior, and an agenda that pops the lightest item finalises each item
at its first pop (Knuth, "A Generalization of Dijkstra's Algorithm", 1977).

Scale: rows are sorted once by (conversation, turn) into ranges, whatever
conversation they are of.  A conversation inside one range is derived there,
a stream of rows at a time.  Only the first and the last conversation of a
range may go on in another; each yields its lightest spans between all pairs of
states, and a conversation's spans (one a range) are joined by the same agenda.
A conversation of any size is so spread over the ranges.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import materialize, small_batches

#: States of the shape: nothing yet, after the system turn, after a user's turn, after a pair.
NOTHING, SYSTEM, USER, PAIR = range(4)
STEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
ENDS = (NOTHING, PAIR)
STATES = range(4)
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
GONE = "-"  # the code of a row that must go; others have their role's initial, upper-case if truncated
#: Rows of a span that are derived at a time.
SPAN = 256
#: Characters of a text that order the rows of one turn; equal ones go by the text's hash.
ORDER_CHARS = 256

Weight = tuple[int, int, str]


def lightest(axioms: Iterable[tuple[Hashable, Weight]], deduce: Callable, goals: set) -> dict[Hashable, Weight]:
    """Lightest weights of the goals that can be derived.

    ``deduce(item, weight, final)`` yields (item, weight) of what follows from
    an item that became final, alone or with other final ones.
    """
    final: dict[Hashable, Weight] = {}
    agenda = [(w, item) for item, w in axioms]
    heapq.heapify(agenda)
    left = set(goals)
    while agenda and left:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        left.discard(item)
        for made, w in deduce(item, weight, final):
            if made not in final:
                heapq.heappush(agenda, (w, made))
    return {g: final[g] for g in goals if g in final}


def _into(state: int) -> list[int]:
    """States from which an inserted or reroled turn leads to ``state``."""
    return [q for (q, role), to in STEP.items() if to == state and role in NAMES]


def _edits(code: str, after: int) -> Iterator[tuple[int, int, str]]:
    """(state before, cost, letter) of the edits of one row that end in state ``after``."""
    yield after, DELETE, "D"
    if code == GONE:
        return
    worse = TRUNCATED if code.isupper() else 0
    for q in STATES:
        if STEP.get((q, code.lower())) == after:
            yield q, KEEP + worse, "K"
    for q in _into(after):
        yield q, REROLE + worse, "R"


@lru_cache(maxsize=1 << 16)
def span(codes: str) -> dict[tuple[int, int], Weight]:
    """(state before, state after) -> lightest weight over the rows of ``codes``, inserts before each row included."""
    n = len(codes)

    def deduce(item, weight, _):
        i, q, end = item
        cost, rows, audit = weight
        if i:
            for before, c, letter in _edits(codes[i - 1], q):
                yield (i - 1, before, end), (cost + c, rows + 1, letter + audit)
        if i < n:
            for before in _into(q):
                yield (i, before, end), (cost + INSERT, rows, "I" + audit)

    found = lightest([((n, q, q), (0, 0, "")) for q in STATES], deduce, {(0, a, b) for a in STATES for b in STATES})
    return {(a, b): w for (_, a, b), w in found.items()}


def _sum(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def join_spans(one: dict, two: dict) -> dict[tuple[int, int], Weight]:
    """Spans over the rows of ``one`` and then ``two``.

    Audits of one span's rows end with a row's letter, so none is the
    beginning of another and the sum of weights is monotone in both.
    """
    out: dict[tuple[int, int], Weight] = {}
    for (a, b), w in one.items():
        for c in STATES:
            if (b, c) in two:
                made = _sum(w, two[b, c])
                if (a, c) not in out or made < out[a, c]:
                    out[a, c] = made
    return out


def spans_of(codes: str) -> dict[tuple[int, int], Weight]:
    out = span(codes[:SPAN])
    for lo in range(SPAN, len(codes), SPAN):
        out = join_spans(out, span(codes[lo:lo + SPAN]))
    return out


def derive(spans: list[dict[tuple[int, int], Weight]]) -> list[tuple[int, int, str]]:
    """(state before, cost, audit) of each of a conversation's spans in its lightest derivation.

    Inserts after the last row belong to the last span.
    """
    n = len(spans)
    into: list[dict[int, list]] = [{} for _ in spans]
    for k, made in enumerate(spans):
        for (a, b), w in made.items():
            into[k].setdefault(b, []).append((a, w))
    back: dict[tuple[int, int], dict[Weight, int]] = {}

    def deduce(item, weight, _):
        k, q = item
        if k:
            for before, w in into[k - 1].get(q, ()):
                made = _sum(w, weight)
                back.setdefault((k - 1, before), {}).setdefault(made, q)
                yield (k - 1, before), made
        if k == n:
            for before in _into(q):
                made = (weight[0] + INSERT, weight[1], "I" + weight[2])
                yield (n, before), made

    final: dict = {}

    def noted(item, weight, known):
        final[item] = weight
        return deduce(item, weight, known)

    lightest([((n, q), (0, 0, "")) for q in ENDS], noted, {(0, NOTHING)})
    out, q = [], NOTHING
    for k in range(n):
        weight = final[k, q]
        after = back[k, q][weight]
        rest = final[k + 1, after]
        last = k == n - 1
        out.append((q, weight[0] - (0 if last else rest[0]), weight[2] if last else weight[2][:len(weight[2]) - len(rest[2])]))
        q = after
    return out


@lru_cache(maxsize=1 << 16)
def _whole(codes: str) -> tuple[int, int, str]:
    """(state before, cost, audit) of a conversation of these rows."""
    return derive([spans_of(codes)])[0]


# -- Rows ---------------------------------------------------------------------------------------

_VISIBLE = r"[^\x20\x09-\x0D]"
_CLOSED = r"[.!?][\x20\x09-\x0D]*\z"
_ORDER = ["turn", "role", "_start", "_hash"]


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with their order columns; a null role or text is one space."""
    named = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                      F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                      F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    return named.withColumns({"_start": F.substring("text", 1, ORDER_CHARS), "_hash": F.unhex(F.sha2("text", 256))})


def _placed(rows: DataFrame) -> DataFrame:
    """The rows sorted into ranges and written: ``at`` follows (conv, turn, role, text), ``part`` is the range."""
    keys = ["conv", *_ORDER]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the last key splits rows that are equal in all columns; their order makes no difference
    dealt = rows.withColumn("_copy", F.monotonically_increasing_id())
    ranged = dealt.repartitionByRange(n, *keys, "_copy").sortWithinPartitions(*keys, "_copy")
    return materialize(ranged.select(
        "conv", "turn", "role", "text", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"),
        F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)).alias("key"),
        (~F.col("text").rlike(_VISIBLE)).alias("blank"), (~F.col("text").rlike(_CLOSED)).alias("cut")), "turns-rows")


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SPAN = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                                  T.StructField("cost", T.LongType()), T.StructField("rows", T.LongType()),
                                  T.StructField("audit", T.StringType())]))


def _segments_schema(conv: T.DataType) -> T.StructType:
    longs = [T.StructField(c, T.LongType()) for c in (*_COUNTS, "low", "high", "turns")]
    return T.StructType([
        T.StructField("conv", conv), T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()), *longs,
        T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("spans", _SPAN),
        T.StructField("state", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])


class _Segment:
    """The rows of one conversation in one range, as they stream by."""

    def __init__(self, conv, part: int, at: int):
        self.conv, self.part, self.at = conv, part, at
        self.codes: list[str] = []
        self.spans: dict | None = None
        self.n = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, initial: str, code: str, fault: str | None) -> None:
        if fault:
            self.n[fault] += 1
        if self.first is None:
            self.first = initial
        else:
            self.n["illegal"] += (self.last + initial) not in LEGAL
        self.last = initial
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        self.codes.append(code)
        if len(self.codes) == 16 * SPAN:
            self._flush()

    def _flush(self) -> None:
        made = spans_of("".join(self.codes))
        self.spans = made if self.spans is None else join_spans(self.spans, made)
        self.codes.clear()

    def row(self, whole: bool) -> dict:
        out = {"conv": self.conv, "part": self.part, "at": self.at, **self.n, "low": self.low, "high": self.high,
               "turns": self.turns, "first": self.first, "last": self.last, "spans": None, "state": None, "cost": None, "audit": None}
        if whole and self.spans is None:
            return out | dict(zip(("state", "cost", "audit"), _whole("".join(self.codes))))
        if self.codes:
            self._flush()
        if whole:
            return out | dict(zip(("state", "cost", "audit"), derive([self.spans])[0]))
        return out | {"spans": [{"a": a, "b": b, "cost": w[0], "rows": w[1], "audit": w[2]} for (a, b), w in self.spans.items()]}


LEGAL = {"su", "ua", "au"}


def _segments(coded_rows: DataFrame, schema: T.StructType) -> DataFrame:
    """One row a conversation and range; with ``spans`` where the conversation may go on in another range."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        now: _Segment | None = None
        opening = True  # the segment is the first of its range

        for b in batches:
            for conv, turn, at, part, initial, code, fault in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now.part != part or now.conv != conv:
                    if now is not None:
                        made.append(now.row(whole=not opening and now.part == part))
                        opening = now.part != part
                    now = _Segment(conv, part, at)
                now.add(turn, initial, code, fault)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=arrow)
                made = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row(whole=False)], schema=arrow)

    n = int(coded_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return coded_rows.repartition(n, "part").sortWithinPartitions("at").mapInArrow(run, schema)


def _joined(schema: T.StructType) -> Callable:
    """Segments of one conversation (one a range at most) with the states, costs and audits of its derivation."""
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        spans = [{(s["a"], s["b"]): (s["cost"], s["rows"], s["audit"]) for s in r["spans"]} for r in rows]
        for r, (state, cost, audit) in zip(rows, derive(spans)):
            r |= {"state": state, "cost": cost, "audit": audit, "spans": None}
        for before, r in zip(rows, rows[1:]):
            r["illegal"] += (before["last"] + r["first"]) not in LEGAL
            # a turn that goes on in the next range counts once
            r["turns"] -= before["high"] is not None and before["high"] == r["low"]
        return pa.Table.from_pylist(rows, schema=arrow)

    return run


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows) of the conversations of ``df``.

    report: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit),
    one row a conversation.  Each row counts for its first fault: blank (no
    character but ASCII white space), duplicate (role and text seen earlier),
    truncated (its last visible character is none of ``.!?``).  illegal counts
    neighbours whose role initials are not su, ua or au; gaps the turn numbers
    missing between the least and the greatest (0 without any).

    repaired: (conv, at, step, edit, turn, role, text) of the rows that stay
    and the inserted ones, ordered by (at, step) within a conversation;
    inserted rows have no turn.

    Rows are taken by turn, nulls first; rows of one turn by role, the first
    ``ORDER_CHARS`` characters and the hash of the text.  A null role or text
    is read as one space: such a text is blank, and a role that begins with
    none of s, u and a (an empty one too) can only be reroled or deleted.  Rows
    with a null conversation are one conversation.  An empty table gives two
    empty results; other columns of ``df`` are left out.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = _placed(_rows(df, conv, turn, role, text))
    seen = (rows.where(~F.col("blank")).groupBy("conv", "key").agg(F.min("at").alias("at"))
            .select("at", F.lit(True).alias("fresh")))
    fault = (F.when(F.col("blank"), "blank").when(F.col("fresh").isNull(), "duplicate").when(F.col("cut"), "truncated"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    coded_rows = (rows.select("conv", "turn", "at", "part", "role", "blank", "cut").join(seen, "at", "left")
                  .select("conv", "turn", "at", "part", initial.alias("initial"),
                          F.when(F.col("blank") | F.col("fresh").isNull(), GONE)
                          .when(F.col("cut"), F.upper(code)).otherwise(code).alias("code"), fault.alias("fault")))
    schema = _segments_schema(rows.schema["conv"].dataType)
    found = materialize(_segments(coded_rows, schema), "turns-segments")
    # at most two open segments a range
    joined = found.where(F.col("spans").isNotNull()).groupBy("conv").applyInArrow(_joined(schema), schema)
    done = materialize(found.where(F.col("spans").isNull()).unionByName(joined).drop("spans"), "turns-derived")
    return _report(done), _repaired(rows, done)


def _report(segments: DataFrame) -> DataFrame:
    gaps = F.max("high") - F.min("low") + 1 - F.sum("turns")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda s: s["audit"]), "")
    return segments.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).cast("long").alias(c) for c in _COUNTS],
        F.sum("cost").alias("cost"), audit.alias("audit"))


def _repaired(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Walk the audit of each segment along its rows, range by range."""
    conv = rows.schema["conv"].dataType
    schema = T.StructType([
        T.StructField("conv", conv), T.StructField("at", T.LongType()), T.StructField("step", T.IntegerType()),
        T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, place, body, state = "", 0, 0, NOTHING
        made: list[tuple] = []

        def insert(conv, at, step) -> int:
            nonlocal place, state
            while place < len(audit) and audit[place] == "I":
                initial = "a" if state == USER else "u"
                made.append((conv, at, step, "I", None, NAMES[initial], ""))
                state, place, step = STEP[state, initial], place + 1, step + 1
            return step

        for b in batches:
            for conv, at, lead, state_, audit_, turn, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if lead == 0:
                    audit, place, body, state = audit_, 0, len(audit_.rstrip("I")), state_
                    continue
                step = insert(conv, at, 0)
                edit, place = audit[place], place + 1
                if edit == "R":
                    role = NAMES["a" if state == USER else "u"]
                if edit != "D":
                    made.append((conv, at, step, edit, turn, role, text))
                    state, step = STEP[state, role[0]], step + 1
                if place == body:
                    insert(conv, at, step)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)
                made.clear()

    null = F.lit(None)
    marks = segments.select("conv", "at", F.lit(0).alias("lead"), "state", "audit", null.cast("long").alias("turn"),
                            null.cast("string").alias("role"), null.cast("string").alias("text"), "part")
    own = rows.select("conv", "at", F.lit(1).alias("lead"), null.cast("int").alias("state"),
                      null.cast("string").alias("audit"), "turn", "role", "text", "part")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (marks.unionByName(own).repartition(n, "part").sortWithinPartitions("at", "lead").drop("part")
            .mapInArrow(run, schema))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired rows ``role:text``, newline-joined.

    A hash is made in order: a conversation's rows stream through one task,
    which holds one batch of them.
    """
    n = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([repaired.schema["conv"], T.StructField("sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            made = []
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
                line = f"{role}:{text}".encode()
                if h is None or conv != now:
                    if h is not None:
                        made.append((now, h.hexdigest()))
                    now, h = conv, hashlib.sha256(line)
                else:
                    h.update(b"\n" + line)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], arrow[0].type), pa.array([h.hexdigest()])], schema=arrow)

    small_batches(repaired.sparkSession)
    return (repaired.repartition(n, "conv").sortWithinPartitions("conv", "at", "step").select("conv", "role", "text")
            .mapInArrow(run, schema))
