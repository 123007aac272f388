"""Cheapest repairs of conversations, by dynamic programming over turns in order.

A repaired conversation is empty, or turns of user and assistant in pairs, behind a system turn
or not. Rows are sent to their conversation's task, sorted by turn, and read once as a stream; the
programme's state is four costs and the order of four paths, carried from one Arrow batch to the
next. The edits are known only at a conversation's end, so its turns and a byte of backpointers
for each state are kept until then, in memory up to a bound and beyond it in a file of
the task's own, which is gone when the task ends and written anew when it is run again.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import lru_cache
from tempfile import TemporaryFile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
# Where a repaired conversation stands: nothing yet, behind system, behind user, behind assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# The one turn that may be inserted at each state, and the state behind it.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (USER, USER, ASSISTANT, USER)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
# More inserts before a row only come back to a state that is reached for less.
MOST_INSERTS = 2
OPS = (KEEP, REROLE, DELETE)
FAR = 1 << 20
# A state that costs so much more than another is never on the cheapest way: whatever follows it can follow the
# other one for 2 (an insert) + 3 (a system turn deleted instead of kept) more at most.
HOPELESS = 8
# Turns of a block; what of an open conversation stays in memory: turns, their characters, and backpointers.
BLOCK = 4096
HELD_TURNS = 1 << 15
HELD_CHARACTERS = 1 << 24
OUT_TURNS = 4096


def last_visible(text: Column) -> Column:
    """The last character that is not white space; empty without one."""
    return F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)


def faulty(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Rows as ``conv``, ``turn``, ``role``, ``text`` and ``fault``, a conversation in one partition and in order.

    The order is by turn, NULLs first, then by role and text. ``fault`` is the first that holds: ``blank``
    (white space only), ``duplicate`` (the conversation has the same role and text before),
    ``truncated`` (the last character that is not white space is none of ``.!?``), else NULL. A NULL role or
    text is one space. Both sorts spill; a window holds the copies of one turn only.
    """
    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    ).repartition("conv")
    last = last_visible(F.col("text"))
    # The rows are where they belong already: this window sorts and does not shuffle.
    same = Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))
    fault = F.when(last == "", "blank").when(F.col("copy") > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    ordered = (F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("copy"))
    judged = named.withColumn("copy", F.row_number().over(same)).withColumn("fault", fault)
    return judged.sortWithinPartitions(*ordered).drop("copy")


def _after(initial: str, state: int) -> int | None:
    """The state behind a kept turn, if it may stand there."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    return NEXT_STATE[state] if initial == NEXT_ROLE[state][0] else None


@lru_cache(maxsize=1 << 16)
def advance(costs: tuple[int, ...], ranks: tuple[int, ...], initial: str, must_go: bool, truncated: bool):
    """The programme's step over one row, from costs above the least and the order of the states' audits.

    Gives how much the least cost grows, the new costs and ranks, and a byte of backpointer
    for each state: 16 x (state before) + 4 x inserts + place in ``OPS``. No audit of another path
    is a prefix of this one's, as all end with a letter for the same row, so comparing the
    ranks, then the new letters, compares whole audits. There are few different steps, so
    they are remembered.
    """
    best: dict[int, tuple] = {}
    for before in range(STATES):
        if costs[before] >= FAR:
            continue
        state, cost = before, costs[before]
        for inserts in range(MOST_INSERTS + 1):
            kept = _after(initial, state)
            moves = [(DELETE, state)]
            if not must_go:
                moves += [(REROLE, NEXT_STATE[state])] + ([(KEEP, kept)] if kept is not None else [])
            for op, behind in moves:
                price = cost + COSTS[op] + (TRUNCATED_COST if truncated and op != DELETE else 0)
                path = (price, ranks[before], INSERT * inserts + op, before, inserts, op)
                if behind not in best or path < best[behind]:
                    best[behind] = path
            state, cost = NEXT_STATE[state], cost + COSTS[INSERT]
    least = min(p[0] for p in best.values())
    best = {s: p for s, p in best.items() if p[0] < least + HOPELESS}
    order = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
    new_costs = tuple(best[s][0] - least if s in best else FAR for s in range(STATES))
    new_ranks = tuple(order.get(s, STATES) for s in range(STATES))
    back = bytes(16 * best[s][3] + 4 * best[s][4] + OPS.index(best[s][5]) if s in best else 0 for s in range(STATES))
    return least, new_costs, new_ranks, back


START = ((0, FAR, FAR, FAR), (0, 1, 2, 3))


def ending(costs: tuple[int, ...], ranks: tuple[int, ...]) -> tuple[int, int, int]:
    """Added cost, last state and inserts of the cheapest end, the least audit among ties."""
    needed = {EMPTY: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
    found = [(costs[s] + COSTS[INSERT] * n, ranks[s], s, n) for s, n in needed.items() if costs[s] < FAR]
    cost, _, state, inserts = min(found)
    return cost, state, inserts


class Kept:
    """The blocks of an open conversation: turns and backpointers, in a file of its own when there are many."""

    def __init__(self) -> None:
        self.blocks: list[tuple[bytes | list, np.ndarray | None]] = []
        self.turns: list[tuple] = []
        self.back = bytearray()
        self.file = None
        self.places: list[tuple[int, int, int]] = []
        self.characters = 0

    def add(self, turn: tuple, back: bytes) -> None:
        self.turns.append(turn)
        self.back += back
        self.characters += len(turn[2]) + len(turn[1])
        if len(self.turns) >= HELD_TURNS or self.characters >= HELD_CHARACTERS:
            self._spill()

    def _spill(self) -> None:
        """Backpointers in front, so that they can be replaced in place."""
        if self.file is None:
            self.file = TemporaryFile()
        self.file.seek(0, 2)
        at = self.file.tell()
        packed = pickle.dumps(self.turns, pickle.HIGHEST_PROTOCOL)
        self.file.write(self.back)
        self.file.write(packed)
        self.places.append((at, len(self.back), len(packed)))
        self.turns, self.back, self.characters = [], bytearray(), 0

    def resolve(self, state: int) -> None:
        """Follow the backpointers from the end; the first byte of each row becomes its edit."""
        state = self._resolved(self.back, state)
        for at, n, _ in reversed(self.places):
            self.file.seek(at)
            back = bytearray(self.file.read(n))
            state = self._resolved(back, state)
            self.file.seek(at)
            self.file.write(back)

    @staticmethod
    def _resolved(back: bytearray, state: int) -> int:
        for at in range(len(back) - STATES, -1, -STATES):
            step = back[at + state]
            back[at] = step & 15
            state = step >> 4
        return state

    def read(self) -> Iterator[tuple[tuple, int]]:
        for at, n, size in self.places:
            self.file.seek(at)
            edits, turns = self.file.read(n)[::STATES], pickle.loads(self.file.read(size))
            yield from zip(turns, edits)
        yield from zip(self.turns, self.back[::STATES])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Repair:
    """The programme over one conversation."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.costs, self.ranks = START
        self.cost = 0
        self.kept = Kept()

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        grown, self.costs, self.ranks, back = advance(
            self.costs, self.ranks, role[:1], fault in ("blank", "duplicate"), fault == "truncated"
        )
        self.cost += grown
        self.kept.add((turn, role, text, fault), back)

    def edits(self) -> Iterator[tuple]:
        """Rows (conv, place, turn, role, text, fault, edit, new_role) in order; closes the conversation."""
        _, state, last_inserts = ending(self.costs, self.ranks)
        self.kept.resolve(state)
        state, place = EMPTY, 0
        for (turn, role, text, fault), step in self.kept.read():
            for _ in range(step >> 2):
                yield self.conv, place, None, None, "", None, INSERT, NEXT_ROLE[state]
                state, place = NEXT_STATE[state], place + 1
            op = OPS[step & 3]
            new = {KEEP: role, REROLE: NEXT_ROLE[state], DELETE: None}[op]
            yield self.conv, place, turn, role, text, fault, op, new
            place += 1
            if op != DELETE:
                state = _after(new[:1], state)
        for _ in range(last_inserts):
            yield self.conv, place, None, None, "", None, INSERT, NEXT_ROLE[state]
            state, place = NEXT_STATE[state], place + 1
        self.kept.close()


def same_conversation(a, b) -> bool:
    """Whether two ids from a pandas column are one, a missing one being an id of its own."""
    return a == b if not (pd.isna(a) or pd.isna(b)) else pd.isna(a) and pd.isna(b)


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row for each edit of the cheapest repair of each conversation, in order within the partition.

    ``conv``, ``place`` (from 0), ``turn``, ``role``, ``text``, ``fault`` (see ``faulty``), ``edit`` and ``new_role``:

    * ``K`` keeps the row (cost 0), ``R`` gives it the role user or assistant (2), ``D`` deletes it (3);
      a blank or duplicate row must go, and a truncated one that stays costs 1 more;
    * ``I`` inserts an empty text of user or assistant anywhere (2); its ``turn`` and ``role`` are NULL.

    What stays has role initials ``(s?(ua)+)?``, an initial being a role's first character (an
    empty role has none and never fits). Of equally cheap repairs the one whose edits, as a
    string, come first in ASCII is taken. Rows that repeat as a whole are duplicates; rows with a NULL
    conversation are one conversation; an empty table gives no row; other columns are not read.
    A conversation is one task's work, whatever its length; its memory is bounded.
    """
    kind = rows.schema[conv].dataType.simpleString()
    names = ["conv", "place", "turn", "role", "text", "fault", "edit", "new_role"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frames(found: Iterator[tuple]) -> Iterator[pd.DataFrame]:
            nonlocal out, held
            for row in found:
                out.append(row)
                held += len(row[4])
                if len(out) >= OUT_TURNS or held >= HELD_CHARACTERS:
                    yield frame(out)
                    out, held = [], 0

        def frame(found: list[tuple]) -> pd.DataFrame:
            columns = dict(zip(names, zip(*found)))
            return pd.DataFrame({n: pd.Series(c, dtype="Int64" if n in ("place", "turn") else object) for n, c in columns.items()})

        out, held, current = [], 0, None
        for batch in batches:
            # Integers with gaps come as floats, so turns and ids travel as text.
            values = [batch[c].tolist() for c in ("id", "turn", "role", "text", "fault")]
            for key, at, who, said, fault in zip(*values):
                if current is None or not same_conversation(current.conv, key):
                    if current is not None:
                        yield from frames(current.edits())
                    current = Repair(key)
                current.add(None if pd.isna(at) else int(at), who, said, None if pd.isna(fault) else fault)
        if current is not None:
            yield from frames(current.edits())
        if out:
            yield frame(out)

    ordered = faulty(rows, conv, turn, role, text).select(
        F.col("conv").cast("string").alias("id"), F.col("turn").cast("string").alias("turn"), "role", "text", "fault"
    )
    made = ordered.mapInPandas(
        run, "conv string, place bigint, turn bigint, role string, text string, fault string, edit string, new_role string"
    )
    return made.withColumn("conv", F.col("conv").cast(kind))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults for trials, by CRC-32 of ``conv:turn`` modulo 20; a NULL in any column counts as one space.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user.
    ``conv`` and ``turn`` themselves stay NULL; other columns go.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(name) % 20
    shown = rows.select(
        F.col(conv).alias(conv), F.col(turn).alias(turn), F.coalesce(role, space).alias(role), F.coalesce(text, space).alias(text),
        kind.alias("__kind"),
    ).filter("__kind <> 0")
    hurt = shown.withColumns({
        text: F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)),
        role: F.when(F.col("__kind") == 4, "user").otherwise(F.col(role)),
    })
    times = F.when(F.col("__kind") == 3, 2).otherwise(1)
    return hurt.withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).drop("__kind", "__copy")


class Summary:
    """Counts of one conversation's edits, read in order."""

    COLUMNS = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"

    def __init__(self, conv) -> None:
        self.conv = conv
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.initial = None
        self.distinct = self.illegal = self.cost = 0
        self.audit = bytearray()
        self.repaired, self.any = hashlib.sha256(), False

    def add(self, turn: int | None, role: str, text: str, fault: str | None, edit: str, new_role: str | None) -> None:
        self.audit += edit.encode()
        self.cost += COSTS[edit] + (TRUNCATED_COST if fault == "truncated" and edit != DELETE else 0)
        if edit != INSERT:
            if fault is not None:
                self.faults[fault] += 1
            if self.initial is not None:
                self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
            self.initial = role[:1]
            if turn is not None and turn != self.high:  # turns come in order
                self.low = turn if self.low is None else self.low
                self.high, self.distinct = turn, self.distinct + 1
        if new_role is not None:
            self.repaired.update(f"{chr(10) * self.any}{new_role}:{text}".encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.repaired.hexdigest())


def summaries(edits: DataFrame) -> DataFrame:
    """A row for each conversation of ``repair``, whose rows must come as it gives them.

    ``gaps`` (turns missing between the least and the greatest one, NULLs aside), rows by ``fault``,
    ``illegal`` (neighbours before the repair whose role initials are not su, ua or au),
    ``cost`` and ``audit`` (the edits as a string) and ``repaired_sha256`` of the lines ``role:text`` that stay.
    """
    kind = edits.schema["conv"].dataType.simpleString()
    names = [c.split()[0] for c in Summary.COLUMNS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, done = None, []
        for batch in batches:
            values = [batch[c].tolist() for c in ("id", "turn", "role", "text", "fault", "edit", "new_role")]
            for key, at, who, said, fault, edit, new in zip(*values):
                if current is None or not same_conversation(current.conv, key):
                    if current is not None:
                        done.append(current.row())
                    current = Summary(key)
                current.add(None if pd.isna(at) else int(at), who, said, *(None if pd.isna(v) else v for v in (fault, edit, new)))
            if done:
                yield pd.DataFrame(done, columns=names)
                done = []
        if current is not None:
            yield pd.DataFrame([current.row()], columns=names)

    rows = edits.select(
        F.col("conv").cast("string").alias("id"), F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "edit", "new_role"
    )
    return rows.mapInPandas(run, Summary.COLUMNS).withColumn("conv", F.col("conv").cast(kind))
