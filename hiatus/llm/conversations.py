"""Repair of conversation structure by generalised LR parsing with weighted edits."""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.llm.tables import struct

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {b"u": b"user", b"a": b"assistant"}
_SPACE = b" \t\n\x0b\x0c\r"
#: Rows between two looks at what is decided.
_LOOK = 64

# The grammar: conversation -> nothing | pairs | s pairs; pairs -> pair | pairs pair;
# pair -> u a. The states of its automaton, named after what lies on top of the stack,
# and its shifts. An assistant's turn completes a pair, which is reduced at once.
_START, _SYSTEM, _USER, _ASSISTANT, _PAIRS = range(5)
_SHIFT = {
    (_START, b"s"): _SYSTEM,
    (_START, b"u"): _USER,
    (_SYSTEM, b"u"): _USER,
    (_PAIRS, b"u"): _USER,
    (_USER, b"a"): _ASSISTANT,
}
_ACCEPTED = (_START, _PAIRS)


class _Stack(NamedTuple):
    """The top of a stack with the cheapest edits that led to it, and what lies below."""

    cost: int
    audit: str
    state: int
    below: _Stack | None

    def read(self, role: bytes, cost: int, edit: str) -> _Stack | None:
        state = _SHIFT.get((self.state, role))
        if state is None:
            return None
        if state != _ASSISTANT:
            return _Stack(self.cost + cost, self.audit + edit, state, self)
        base = self.below  # pair -> u a, then pairs -> pair or pairs pair
        return _Stack(self.cost + cost, self.audit + edit, _PAIRS, base.below if base.state == _PAIRS else base)


class Parser:
    """All stacks of one conversation, one for each top: of equal tops the least (cost, audit) stays.

    What follows depends on the top alone, and of two audits of the same cost and the same
    rows neither begins the other, so the least of the parts is part of the least.
    """

    def __init__(self):
        self.tops = {_START: _Stack(0, "", _START, None)}
        self._insert()

    def _merge(self, tops: dict, stack: _Stack | None) -> bool:
        if stack is None or (stack.state in tops and tops[stack.state][:2] <= stack[:2]):
            return False
        tops[stack.state] = stack
        return True

    def _insert(self) -> None:
        """Adds what insertions reach; going round costs more than it saves, so this ends."""
        waiting = list(self.tops.values())
        while waiting:
            stack = waiting.pop()
            for role in ROLES:
                more = stack.read(role, INSERT, "I")
                if self._merge(self.tops, more):
                    waiting.append(more)

    def feed(self, role: bytes, unfit: bool, truncated: bool) -> None:
        """Reads a row by its role's initial; an unfit one can only be deleted."""
        tops: dict[int, _Stack] = {}
        kept = TRUNCATED if truncated else 0
        for stack in self.tops.values():
            self._merge(tops, stack._replace(cost=stack.cost + DELETE, audit=stack.audit + "D"))
            if not unfit:
                self._merge(tops, stack.read(role, kept, "K"))
                for other in ROLES:
                    self._merge(tops, stack.read(other, kept + REROLE, "R"))
        self.tops = tops
        self._insert()

    def decided(self) -> str:
        """Takes off the edits that all stacks share."""
        shared = os.path.commonprefix([stack.audit for stack in self.tops.values()])
        self.tops = {s: stack._replace(audit=stack.audit[len(shared) :]) for s, stack in self.tops.items()}
        return shared

    def finish(self) -> str:
        return min(self.tops[s] for s in _ACCEPTED if s in self.tops).audit


class _Replay:
    """Turns edits and rows into edited rows; the state tells the role that fits."""

    def __init__(self):
        self.top, self.place = _Stack(0, "", _START, None), 0

    def run(self, edits: str, rows: Iterator[tuple]) -> Iterator[tuple]:
        for edit in edits:
            turn, found, text, fault = (None, None, b"", None) if edit == "I" else next(rows)
            role = found
            if edit == "D":
                role = text = None
            else:
                if edit != "K":
                    fitting = next(r for r in ROLES if (self.top.state, r) in _SHIFT)
                    role = ROLES[fitting]
                self.top = self.top.read(role[:1], 0, "")
            yield self.place, turn, edit, fault, found, role, text
            self.place += 1


_NAMES = {"K": "keep", "R": "rerole", "D": "delete", "I": "insert"}
_EDITS = struct("place long, turn long, edit string, fault string, found_role binary, role binary, text binary")
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.binary())


def _fault(text: bytes, again: bool) -> str | None:
    said = text.strip(_SPACE)
    if not said:
        return "blank"
    if again:
        return "duplicate"
    return None if said[-1:] in (b".", b"!", b"?") else "truncated"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edited rows of the conversations, which come one after the other.

    Rows are held until all stacks agree on their edits, so memory does not grow with
    a conversation's length unless its stacks never agree.
    """
    parser = replay = None
    conversation, held, out = object(), [], []
    ids: list = []

    def release(edits: str) -> None:
        rows = iter(held)
        done = list(replay.run(edits, rows))
        held[:] = list(rows)
        out.extend(done)
        ids.extend([conversation] * len(done))

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, turn, role, text, again in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "again")]):
            if parser is None or conv != conversation:
                if parser is not None:
                    release(parser.finish())
                parser, replay, conversation = Parser(), _Replay(), conv
            fault = _fault(text, again)
            held.append((turn, role, text, fault))
            parser.feed(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
            if len(held) % _LOOK == 0:
                release(parser.decided())
        yield _batch(ids, out, kind)
        ids.clear()
        out.clear()
    if parser is not None:
        release(parser.finish())
        yield _batch(ids, out, kind)


def _batch(ids: list, out: list, kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * len(_EDITS)
    columns[2] = [_NAMES[edit] for edit in columns[2]]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), *[pa.array(c, k) for c, k in zip(columns, _KINDS)]], names=["conv", *_EDITS.names]
    )


def repair(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The cheapest edits that make each conversation an optional system turn and user-assistant pairs.

    Returns a row for each edit, in order: the id (under its name), ``place`` (from 0), ``turn``,
    ``edit`` (keep, rerole, delete, insert), ``fault`` (blank, duplicate, truncated or null),
    ``found_role``, ``role`` and ``text`` (null for deleted rows; inserted texts are empty).

    Keeping costs 0, changing a role to user or assistant 1, deleting 2, inserting an
    empty turn of either 5; a truncated row that stays costs 5 more. Blank
    rows and rows whose role and text came earlier are deleted. Of equal costs the least
    sequence of the edits' initials is taken. Conversations may become empty.

    Rows are taken by turn, nulls first, ties by role and text. A null role or text is
    one space. Null ids make one conversation. No rows give no rows; other columns are
    not carried. A conversation is sorted by Spark and read row by row in one task,
    as its edits depend on each other from end to end.
    """
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).cast("binary").alias(n) for c, n in ((role, "role"), (text, "text"))],
    )
    said = F.md5(F.concat(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), "role", "text"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    same = Window.partitionBy("conv", "said").orderBy(F.asc_nulls_first("turn"))
    ordered = (
        rows.repartition("conv")
        .withColumn("said", said)
        .withColumn("nth", F.row_number().over(same))
        .sortWithinPartitions("conv", *order, "nth")
        .select("conv", "turn", "role", "text", (F.col("nth") > 1).alias("again"))
    )
    edits = ordered.mapInArrow(_parse, T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *_EDITS.fields]))
    return edits.select(
        F.col("conv").alias(conv),
        "place",
        "turn",
        "edit",
        "fault",
        *[F.col(c).cast("string").alias(c) for c in ("found_role", "role", "text")],
    )


_REPORT = struct(
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_COSTS = {"keep": 0, "rerole": REROLE, "delete": DELETE, "insert": INSERT}
_LEGAL = (b"su", b"ua", b"au")


class _Report:
    """Running figures of one conversation's edits."""

    def __init__(self):
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.distinct = 0
        self.first = self.last = self.before = None
        self.audit: list[str] = []
        self.hash, self.any = hashlib.sha256(), False

    def add(self, turn, edit: str, fault: str | None, found: bytes | None, role: bytes | None, text: bytes | None) -> None:
        self.audit.append(edit[0].upper())
        self.cost += _COSTS[edit]
        if fault:
            self.faults[fault] += 1
            self.cost += TRUNCATED if fault == "truncated" and edit != "delete" else 0
        if found is not None:
            if self.before is not None and self.before + found[:1] not in _LEGAL:
                self.illegal += 1
            self.before = found[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        if edit != "delete":
            self.hash.update((b"\n" if self.any else b"") + role + b":")
            self.hash.update(text)
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    report, conversation, kind = None, None, None

    def result() -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        columns = list(zip(*done)) or [()] * len(_REPORT)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["conv", *_REPORT.names]
        )

    for batch in batches:
        kind = batch.schema.field("conv").type
        ids, done = [], []
        names = ("conv", "turn", "edit", "fault", "found_role", "role", "text")
        for conv, *row in zip(*[batch.column(c).to_pylist() for c in names]):
            if report is None or conv != conversation:
                if report is not None:
                    ids.append(conversation)
                    done.append(report.row())
                report, conversation = _Report(), conv
            report.add(*row)
        yield result()
    if report is not None:
        ids, done = [conversation], [report.row()]
        yield result()


def repair_report(edits: DataFrame, conv: str = "conv_id") -> DataFrame:
    """A row for each conversation with edits, from the rows of :func:`repair`.

    ``gaps`` are the missing whole numbers between the least and the greatest turn,
    ``blank``, ``duplicate`` and ``truncated`` the faults, ``illegal`` the neighbours found
    whose roles' initials are not su, ua or au, ``cost`` and ``audit`` the edits' sum and
    initials, ``repaired_sha256`` the hash of the lines ``role:text`` that stay.
    """
    rows = edits.select(
        F.col(conv).alias("conv"),
        "place",
        "turn",
        "edit",
        "fault",
        *[F.col(c).cast("binary").alias(c) for c in ("found_role", "role", "text")],
    )
    sorted_rows = rows.repartition("conv").sortWithinPartitions("conv", "place")
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *_REPORT.fields])
    return sorted_rows.mapInArrow(_report, schema).withColumnRenamed("conv", conv)


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults set by the CRC-32 of ``conv:turn``, null values being one space.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes out its full stops,
    exclamation and question marks, 3 repeats it, 4 makes its role user.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn)).cast("binary")), F.lit(20))
    said = F.when(kind == 1, "").when(kind == 2, F.translate(shown(text), ".!?", "")).otherwise(shown(text))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(kind != 0).select(
        F.col(conv),
        F.col(turn),
        F.when(kind == 4, "user").otherwise(shown(role)).alias(role),
        said.alias(text),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
