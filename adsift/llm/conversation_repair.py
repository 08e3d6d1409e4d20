"""Conversation structure repair by a generalised LR parse with edits.

The role grammar is ``Dialogue -> empty | Turns | s Turns``, ``Turns -> Pair | Turns Pair``,
``Pair -> u a`` (``s``, ``u``, ``a``: the first letter of a role). Its LR automaton reads the rows of a
conversation in order; where a row does not fit, or costs less otherwise, the parse forks over weighted edits: delete
the row, rerole it, insert a row. All forks live in one graph-structured stack: a node is a state
over a shared predecessor, and nodes with equal tops merge into the one with the least ``(cost, audit)``, so a row costs
the same however many forks there were. (An audit that is a proper beginning of another of equal rows lacks only inserts,
and so costs less: the least prefix stays the least whatever follows.)

Conversations are dealt by id, sorted within the tasks and parsed as a stream: a task holds one row, the few stack
nodes and the audit, never a conversation. Each node carries the running SHA-256 of its repaired text, a digest that is
sequential by nature. Repeated turns are found before, by an aggregate over hashes of (conversation, role, text) with
map-side combine, so no task remembers the turns it has seen.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from adsift.llm.common import SPACE_CHARS, hash128, written

USER, ASSISTANT = "user", "assistant"
ENDS = ".!?"
#: Pairs of adjacent role initials that a sound conversation may have.
LEGAL_PAIRS = ("su", "ua", "au")
#: LR states: what has been read. OPEN is a pair without its answer.
START, SYSTEM, TURNS, SYSTEM_TURNS, OPEN = range(5)
#: State after reading a letter; OPEN keeps its predecessor on the stack below it.
SHIFT = {(START, "s"): SYSTEM, (START, "u"): OPEN, (SYSTEM, "u"): OPEN, (TURNS, "u"): OPEN, (SYSTEM_TURNS, "u"): OPEN}
#: ``a`` completes the pair: reduce by Pair -> u a, pop to the predecessor, go to this state over Turns.
GOTO_TURNS = {START: TURNS, TURNS: TURNS, SYSTEM: SYSTEM_TURNS, SYSTEM_TURNS: SYSTEM_TURNS}
ACCEPT = (START, TURNS, SYSTEM_TURNS)
#: Rows after which what all audits have in common leaves the stack.
FLUSH_ROWS = 256


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


class Fork(NamedTuple):
    """The least parse that ends in a stack node. ``below`` is the state under OPEN."""
    cost: int
    audit: str
    digest: Any
    lines: int
    below: int


def _read(digest, lines: int, role: str, text: str):
    out = digest.copy()
    if lines:
        out.update(b"\n")
    out.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
    return out


class Parse:
    """The frontier of the graph-structured stack of one conversation."""

    def __init__(self, costs: Costs):
        self.costs = costs
        self.nodes: dict[int, Fork] = {START: Fork(0, "", hashlib.sha256(), 0, START)}
        self.done: list[str] = []
        self.rows = 0

    @staticmethod
    def _step(top: int, fork: Fork, letter: str) -> tuple[int, int] | None:
        """Shift ``letter`` (and reduce): the new top and the state below it."""
        if top == OPEN:
            return (GOTO_TURNS[fork.below], START) if letter == "a" else None
        state = SHIFT.get((top, letter))
        return None if state is None else (state, top)

    @staticmethod
    def _offer(nodes: dict[int, Fork], at: tuple[int, int] | None, fork: Fork, cost: int, edit: str,
               role: str = "", text: str = "", adds: bool = True) -> bool:
        """Merge a fork into the node with its top; False if it is no better."""
        if at is None:
            return False
        audit, known = fork.audit + edit, nodes.get(at[0])
        if known is not None and (known.cost, known.audit) <= (fork.cost + cost, audit):
            return False
        digest = _read(fork.digest, fork.lines, role, text) if adds else fork.digest
        nodes[at[0]] = Fork(fork.cost + cost, audit, digest, fork.lines + adds, at[1] if adds else fork.below)
        return True

    def _insert(self) -> None:
        """Insert user or assistant rows as long as that opens a cheaper way to a top."""
        todo = list(self.nodes)
        while todo:
            top = todo.pop()
            fork = self.nodes[top]
            role = ASSISTANT if top == OPEN else USER
            at = self._step(top, fork, role[0])
            if self._offer(self.nodes, at, fork, self.costs.insert, "I", role):
                todo.append(at[0])
        self._drop_dominated()

    def _drop_dominated(self) -> None:
        """Forks that cannot win any more: after whole pairs the rest may be whatever may follow a fork that is still at its
        beginning, but for a kept ``s``, which can be deleted. What stays then soon shares most of its audit."""
        whole = [t for t in (TURNS, SYSTEM_TURNS) if t in self.nodes]
        if not whole:
            return
        best = min(whole, key=lambda t: (self.nodes[t].cost, self.nodes[t].audit))
        cost = self.nodes[best].cost
        for top, over in ((START, self.costs.delete), (SYSTEM, 0)):
            if top in self.nodes and self.nodes[top].cost > cost + over:
                del self.nodes[top]
        for top in whole:
            if top != best:
                del self.nodes[top]

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self._insert()
        late = self.costs.truncated if truncated else 0
        after: dict[int, Fork] = {}
        for top, fork in self.nodes.items():
            self._offer(after, (top, fork.below), fork, self.costs.delete, "D", adds=False)
            if must_go:
                continue
            self._offer(after, self._step(top, fork, role[:1]), fork, late, "K", role, text)
            other = ASSISTANT if top == OPEN else USER
            self._offer(after, self._step(top, fork, other[0]), fork, self.costs.rerole + late, "R", other, text)
        self.nodes = after
        self.rows += 1
        if self.rows % FLUSH_ROWS == 0:
            shared = len(os.path.commonprefix([f.audit for f in after.values()]))
            if shared:
                self.done.append(next(iter(after.values())).audit[:shared])
                self.nodes = {t: f._replace(audit=f.audit[shared:]) for t, f in after.items()}

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and SHA-256 of the cheapest repaired conversation."""
        self._insert()
        best = min((self.nodes[t] for t in ACCEPT if t in self.nodes), key=lambda f: (f.cost, f.audit))
        return best.cost, "".join(self.done) + best.audit, best.digest.hexdigest()


class Tally:
    """Counts of one conversation's faults, beside its parse."""

    def __init__(self, costs: Costs):
        self.parse = Parse(costs)
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last: tuple | None = None

    def row(self, turn, role: str, text: str, blank: bool, whole: bool, repeat: bool) -> None:
        if turn is not None and turn != self.last_turn:  # rows come by turn, nulls first
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.turns += 1
        repeat = repeat or self.last == (turn, role, text)
        truncated = not blank and not repeat and not whole
        self.blank += blank
        self.duplicate += repeat and not blank
        self.truncated += truncated
        if self.last is not None:
            self.illegal += self.last[1][:1] + role[:1] not in LEGAL_PAIRS
        self.last = (turn, role, text)
        self.parse.row(role, text, blank or repeat, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit, digest = self.parse.end()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


RESULT = [("gaps", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"),
          ("illegal", "bigint"), ("cost", "bigint"), ("audit", "string"), ("repaired_sha256", "string")]


def damaged(conv: Column, turn: Column) -> Column:
    """What befalls a row: crc32 of ``conv:turn`` modulo 20 (a null is one space)."""
    word = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    return F.crc32(F.encode(F.concat(word(conv), F.lit(":"), word(turn)), "utf-8")) % 20


def damage_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The four columns with known damage: by ``damaged``, 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes it a user's. A null role or text is one space first."""
    kind = damaged(F.col(conv_col), F.col(turn_col))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    out = rows.select(
        F.col(conv_col), F.col(turn_col), F.when(kind == 4, USER).otherwise(role).alias(role_col),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias(text_col),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_copies"))
    return out.filter("_copies > 0").select(
        conv_col, turn_col, role_col, text_col,
        F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")).drop("_copy")


def _lines(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows in the names used here, with what each line is by itself."""
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    filled = F.rtrim("text", F.lit(SPACE_CHARS))
    return rows.select("*", (filled == "").alias("blank"), F.right(filled, F.lit(1)).isin(*ENDS).alias("whole"),
                       *hash128(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", costs: Costs = Costs()) -> DataFrame:
    """The cheapest edits that give every conversation the roles ``(s?(ua)+)?``.

    Rows go by turn (nulls first), then role and text. A row without a visible character is ``blank``; else one whose
    role and text an earlier row has is ``duplicate``; else one whose last visible character is not ``.!?`` is
    ``truncated``. Blank and duplicate rows must be deleted; a truncated row that stays costs extra. Returns one row
    per conversation: ``conv_col``, ``gaps`` (missing turn numbers), the counts of
    faults, ``illegal`` (adjacent roles out of order), ``cost``, ``audit`` (the edits in order: Keep, Rerole, Delete, Insert;
    of equal costs the ASCII-least) and ``repaired_sha256`` (of the repaired ``role:text`` lines).

    A null role or text is one space; an empty role cannot be kept; null ids are one conversation; equal rows are repeats of one
    turn; long texts pass through as a stream. Other columns are not read. An empty table gives an empty result.
    """
    lines = _lines(rows, conv_col, turn_col, role_col, text_col)
    repeated = written(
        lines.groupBy("conv", "h1", "h2").agg(F.count("*").alias("n"), F.count("turn").alias("dated"), F.min("turn").alias("first"))
        .filter("n > 1").select("conv", "h1", "h2", F.when(F.col("n") == F.col("dated"), F.col("first")).alias("first"),
                                F.lit(True).alias("repeated")), "repeated-turns")
    r = repeated.select(F.col("conv").alias("r_conv"), F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first", "repeated")
    later = F.coalesce(F.col("repeated") & F.col("turn").isNotNull() & (F.col("first").isNull() | (F.col("turn") > F.col("first"))),
                       F.lit(False))
    marked = lines.join(r, F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")),
                        "left").select("conv", "turn", "role", "text", "blank", "whole", later.alias("later"))
    schema = StructType([StructField(conv_col, rows.schema[conv_col].dataType),
                         *[StructField(n, LongType() if t == "bigint" else StringType()) for n, t in RESULT]])
    dealt = marked.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, conv, out, target = None, None, [], None
        emit = lambda: pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], target), *[pa.array([r[i + 1] for r in out], pa.int64() if t == "bigint" else pa.string())
                                                      for i, (_, t) in enumerate(RESULT)]], names=schema.names)
        for batch in batches:
            target = batch.schema.field("conv").type
            for c, *row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if tally is None or c != conv:
                    if tally is not None:
                        out.append((conv, *tally.result()))
                    tally, conv = Tally(costs), c
                tally.row(*row)
            if len(out) >= 1000:
                yield emit()
                out = []
        if tally is not None:
            out.append((conv, *tally.result()))
        if out:
            yield emit()

    return dealt.mapInArrow(parsed, schema)


def repaired_rows(rows: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations themselves: ``conv_col, position, role_col, text_col, edit``, from the rows and the
    ``audit`` that ``repair_conversations`` gave. Inserted rows have an empty text."""
    from pyspark.sql import Window
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    numbered = (_lines(rows, conv_col, turn_col, role_col, text_col).select("conv", "turn", "role", "text")
                .select("conv", "role", "text", F.row_number().over(order).alias("at")))
    edits = repairs.select(F.col(conv_col).alias("e_conv"), F.explode(F.filter(
        F.transform(F.split("audit", ""), lambda e, i: F.struct(e.alias("edit"), i.alias("i"))),
        lambda x: x["edit"] != "")).alias("x")).select("e_conv", "x.*")
    steps = Window.partitionBy("e_conv").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("e_conv")
    placed = edits.select("e_conv", "edit", F.count_if(F.col("edit") != "I").over(steps).alias("e_at"),
                          F.count_if(F.col("edit") != "D").over(steps).alias("position"),
                          F.count_if(F.col("edit") != "D").over(every).alias("total"))
    joined = placed.filter("edit <> 'D'").join(
        numbered, F.col("e_conv").eqNullSafe(F.col("conv")) & (F.col("e_at") == F.col("at")) & (F.col("edit") != "I"), "left")
    speaker = F.when((F.col("position") - F.col("total")) % 2 != 0, USER).otherwise(ASSISTANT)
    return joined.select(F.col("e_conv").alias(conv_col), F.col("position").cast("bigint").alias("position"),
                         F.when(F.col("edit") == "K", F.col("role")).otherwise(speaker).alias(role_col),
                         F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias(text_col), "edit")
