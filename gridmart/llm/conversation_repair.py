"""Conversation structure repair by a dynamic program with checkpoints.

A conversation's rows, in order of turn (nulls first; rows of one turn by role
and then by the digest of their text), are edited at least cost until their
roles read ``(s?(ua)+)?``: an optional system row, then user and assistant in
turn.  Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty
user or assistant row) 2; a truncated row that stays costs 1 more; blank and
repeated rows must go.  Of the cheapest edits the ASCII-least string of their
initials is given.

``tight_edits`` is the dynamic program.  Going backward it keeps the vector of
costs by state only at every square-root-of-n-th row; walking forward it
recomputes one block of vectors at a time from the checkpoint behind it and
takes the least letter whose cost is tight.  A state determines which role can
come next, so each letter leads to one state and the walk never branches.

On Spark a row is one byte to the program (its role's initial and its fault).
Rows are sorted by conversation and streamed: first the short records (what the
program needs), then the texts in the same order, to which the edits are applied
as they pass.  A task holds one conversation's bytes and edits, never its texts;
the edits of a conversation are one value of the result, and its digest reads
its texts in order, so one task reads each conversation whatever its length.
Repeats are found beforehand: the first turn of each (conversation, role, text)
is aggregated by key, with partial aggregation, and meets its row in the sort.

Defined results: a null role or text is one space; a row of an empty role, or of
one with another initial, can not be kept as it is; a null conv_id is a
conversation of its own; of a row's faults only the first of blank, duplicate,
truncated counts; equal rows of one turn are repeats but the first; a
conversation of ``every`` without rows gets zeros, no edits and the digest of
nothing; gaps above the largest long are given as that; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ENDINGS = ".!?"

# Roles by their initials; a row's byte is 3 * its role + its fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
SOUND, CUT_OFF, MUST_GO = range(3)
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

# States of the walk: nothing yet, after a system, a user, an assistant row.
START, S, U, A = range(4)
#: The state that the one role which can be inserted in a state leads to.
NEXT = (U, U, A, U)
INSERTED = {U: "user", A: "assistant"}
#: (state, role) to the state after a kept row.
KEPT = {(START, SYSTEM): S, (START, USER): U, (S, USER): U, (U, ASSISTANT): A, (A, USER): U}
#: Cost to the end without further rows, by state.
AT_END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def _row_edits(code: int) -> list[tuple[int, int | None, int | None]]:
    """By state: (state after Keep or None, that after Rerole or None, the fee
    of a row that stays)."""
    role, fault = divmod(code, 3)
    if fault == MUST_GO:
        return [(None, None, 0)] * 4
    fee = TRUNCATED if fault == CUT_OFF else 0
    return [(KEPT.get((q, role)), NEXT[q], fee) for q in range(4)]


EDITS = [_row_edits(code) for code in range(12)]


def before_row(code: int, after: Vector) -> Vector:
    """Least costs by state in front of a row, given those behind it."""
    least = []
    for q, (kept, reroled, fee) in enumerate(EDITS[code]):
        cost = after[q] + DELETE
        if kept is not None:
            cost = min(cost, after[kept] + KEEP + fee)
        if reroled is not None:
            cost = min(cost, after[reroled] + REROLE + fee)
        least.append(cost)
    start, s, u, a = least
    u, a = min(u, a + INSERT), min(a, u + INSERT)
    return min(start, u + INSERT), min(s, u + INSERT), u, a


def tight_edits(codes: bytes) -> tuple[int, str]:
    """Least cost of a conversation and the ASCII-least initials of its edits.

    Beside the rows' bytes and the letters it holds the vectors of the
    checkpoints and of one block, both about the square root of the rows."""
    n = len(codes)
    step = max(1, math.isqrt(n))
    checkpoints: dict[int, Vector] = {}
    vector: Vector = AT_END
    for i in range(n, -1, -1):
        if i < n:
            vector = before_row(codes[i], vector)
        if i % step == 0 or i == n:
            checkpoints[i] = vector
    cost = checkpoints[0][START]

    letters, q = [], START
    for first in range(0, n, step):
        last = min(first + step, n)
        block = [checkpoints[last]]
        for i in range(last - 1, first - 1, -1):
            block.append(before_row(codes[i], block[-1]))
        block.reverse()                                    # of rows first to last
        for i in range(first, last):
            here, behind = block[i - first], block[i - first + 1]
            while True:                                    # D before I before K before R
                kept, reroled, fee = EDITS[codes[i]][q]
                if here[q] == behind[q] + DELETE:
                    letters.append("D")
                    break
                if here[q] == here[NEXT[q]] + INSERT:
                    letters.append("I")
                    q = NEXT[q]
                    continue
                if kept is not None and here[q] == behind[kept] + KEEP + fee:
                    letters.append("K")
                    q = kept
                    break
                letters.append("R")
                q = reroled
                break
    while AT_END[q]:
        letters.append("I")
        q = NEXT[q]
    return cost, "".join(letters)


class Applied:
    """Edits applied to rows that pass in order."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows inserted at this place."""
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield "I", INSERTED[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What stands in the row's place: inserted rows, then itself if it stays."""
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, ROLES[role[0]]]
            yield edit, role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield edit, INSERTED[self.state], text


class Conversation:
    """One conversation as its records pass."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high = 0, None, None
        self.first = self.role = self.applied = None
        self.cost, self.edits, self.lines = 0, "", 0
        self.digest = hashlib.sha256()

    def mark(self, key) -> None:
        """The next row of this key is the first of its role and text."""
        self.first = key

    def short(self, key, initial: str, fault: int) -> None:
        turn, role = key[0], ROLES.get(initial, OTHER)
        repeated = self.first != key
        self.first = None
        if fault == MUST_GO:
            self.blank += 1
        elif repeated:
            self.duplicate += 1
            fault = MUST_GO
        elif fault == CUT_OFF:
            self.truncated += 1
        if self.role is not None and (self.role, role) not in LEGAL_PAIRS:
            self.illegal += 1
        self.role = role
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.codes.append(3 * role + fault)

    def solve(self) -> None:
        if self.applied is None:
            self.cost, self.edits = tight_edits(bytes(self.codes))
            self.applied = Applied(self.edits)

    def line(self, role: str, text: str) -> None:
        if self.lines:
            self.digest.update(b"\n")
        self.lines += 1
        self.digest.update(f"{role}:{text}".encode())

    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)


def _records(rows: DataFrame, every: DataFrame | None) -> DataFrame:
    """Marks, short records and texts, together and sorted by conversation."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    trimmed = F.rtrim(F.col("text"), F.lit(common.BLANKS))
    fault: Column = F.when(trimmed == "", MUST_GO) \
        .when(F.substring(trimmed, -1, 1).isin(list(ENDINGS)), SOUND).otherwise(CUT_OFF)
    rows = common.columns(rows, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}) \
        .select("conv_id", "turn", role.alias("role"), text.alias("text")) \
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
    none = {"turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"),
            "digest": F.lit(None).cast("binary"), "text": F.lit(None).cast("string")}
    order = ["conv_id", "kind", "turn", "role", "digest", "step"]
    columns = [*order, "fault", "text"]
    # a (conversation, role, text) stands first at its least turn, null before all
    marks = rows.groupBy("conv_id", "role", "digest").agg(
        F.when(F.count_if(F.col("turn").isNull()) == 0, F.min("turn")).alias("turn")) \
        .withColumns({"kind": F.lit(1), "step": F.lit(0), "fault": F.lit(0), "text": none["text"]})
    both = rows.withColumn("fault", fault).withColumn("kind", F.explode(F.array(F.lit(1), F.lit(2)))) \
        .withColumns({"step": F.lit(1), "text": F.when(F.col("kind") == 2, F.col("text"))})
    records = marks.select(columns).unionByName(both.select(columns))
    if every is not None:
        bare = common.columns(every, {"conv_id": "long"}).distinct() \
            .withColumns({**none, "kind": F.lit(0), "step": F.lit(0), "fault": F.lit(0)})
        records = records.unionByName(bare.select(columns))
    return records.repartition("conv_id").sortWithinPartitions(order)


def _stream(batches, begin: Callable, line: Callable, end: Callable) -> Iterator[list]:
    """Result rows, a list for each batch read: ``line`` gives those of a
    repaired row, ``end`` those of a conversation."""
    conv = None

    def lines(found):
        for edit, role, text in found:
            yield from line(conv, edit, role, text)

    for batch in batches:
        out = []
        names = ("conv_id", "kind", "turn", "role", "digest", "step", "fault", "text")
        for conv_id, kind, turn, role, digest, step, fault, text in zip(
                *(batch.column(n).to_pylist() for n in names)):
            if conv is None or conv_id != conv.conv_id:
                if conv is not None:
                    conv.solve()
                    out += lines(conv.applied.inserted())
                    out += end(conv)
                conv = begin(conv_id)
            if kind == 2:
                conv.solve()
                out += lines(conv.applied.row(role, text))
            elif kind == 1:
                key = (turn, role, digest)
                if step:
                    conv.short(key, role[:1], fault)
                else:
                    conv.mark(key)
        yield out
    if conv is not None:
        conv.solve()
        yield [*lines(conv.applied.inserted()), *end(conv)]


REPORT = {"conv_id": "long", "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long",
          "illegal": "long", "cost": "long", "audit": "string", "repaired_sha256": "string"}
REPAIRED = {"conv_id": "long", "place": "long", "edit": "string", "role": "string", "text": "string"}
ARROW = {"long": pa.int64(), "string": pa.string()}


def _mapped(records: DataFrame, schema: dict[str, str], line: Callable, end: Callable) -> DataFrame:
    def run(batches):
        for out in _stream(batches, Conversation, line, end):
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, ARROW[t]) for values, t in zip(zip(*out), schema.values())],
                    names=list(schema))
    return records.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in schema.items()))


def repair(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row for each conversation: its faults, the least cost, the edits'
    initials and the digest of the repaired rows (``role:text`` lines).
    ``every`` names conversations that are reported even without rows."""
    def line(conv, edit, role, text):
        conv.line(role, text)
        return ()

    def end(conv):
        return [(conv.conv_id, conv.gaps(), conv.blank, conv.duplicate, conv.truncated, conv.illegal,
                 conv.cost, conv.edits, conv.digest.hexdigest())]

    return _mapped(_records(rows, every), REPORT, line, end)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: role and text by place (from 0), with the
    edit (K, R or I) that put them there."""
    def line(conv, edit, role, text):
        conv.lines += 1
        return [(conv.conv_id, conv.lines - 1, edit, role, text)]

    return _mapped(_records(rows, None), REPAIRED, line, lambda conv: ())
