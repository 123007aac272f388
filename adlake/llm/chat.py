"""Chat formatting with built-in functions only.

A declarative template says how a turn of each role opens and closes and whether
its text is learned. Control strings inside texts are escaped reversibly, so a
formatted conversation can be read back turn by turn. A finite-state machine over
the roles says which conversations keep a valid order.

A formatted conversation is one string and so one row: its turns meet in one task,
which no plan can avoid. Nothing else is gathered by key.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = ""


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles`` by name; the entry ``OTHER`` stands for any other role, whose name is written
    before ``named``. ``moves`` maps a state and a role to the next state, from ``start``; a
    conversation is valid if every role has a move and the last state is in ``final``. Every
    control string begins with a character it has nowhere else, and none has the escape character."""

    roles: dict[str, Role]
    moves: dict[tuple[str, str], str]
    named: str
    start: str = "start"
    final: tuple[str, ...] = ("answered",)
    extra: tuple[str, ...] = ()
    escape: str = "\\"
    controls: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self) -> None:
        marks = {self.named, *self.extra}
        for role in self.roles.values():
            marks |= {role.open, role.close}
        if len({r.open for r in self.roles.values()}) < len(self.roles) or OTHER not in self.roles:
            raise ValueError("each role needs an opening of its own, and there must be one for other roles")
        first = {m[:1] for m in marks}
        if "" in marks or any(self.escape in m or first & set(m[1:]) for m in marks):
            raise ValueError("a control string may have neither the escape character nor a first character inside")
        object.__setattr__(self, "controls", tuple(sorted(marks, key=lambda m: (-len(m), m))))


INSTRUCT = Template(
    roles={
        "system": Role("[SYS]", "[/SYS]"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("[ANS]", "</s>", loss=True),
        OTHER: Role("[ROLE]", "[/END]"),
    },
    named="[/ROLE]",
    extra=("<s>", "<unk>"),
    moves={
        ("start", "system"): "told",
        ("start", "user"): "asked",
        ("told", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
)


def escape(text: Column, template: Template) -> Column:
    """Double the escape character, then put it and ``-`` behind the first character of a control string."""
    e = re.escape(template.escape)
    heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.controls)
    doubled = F.regexp_replace(text, e, F.lit(re.sub(r"([\\$])", r"\\\1", template.escape * 2)))
    return F.regexp_replace(doubled, f"({heads})", F.lit("$1" + re.sub(r"([\\$])", r"\\\1", template.escape) + "-"))


def unescape(text: Column, template: Template) -> Column:
    e = re.escape(template.escape)
    return F.regexp_replace(text, f"{e}(?:({e})|-)", F.lit("$1"))


def _by_role(role: Column, template: Template, pick) -> Column:
    out = F.lit(pick(template.roles[OTHER]))
    for name, mark in template.roles.items():
        if name != OTHER:
            out = F.when(role == name, F.lit(pick(mark))).otherwise(out)
    return out


def segments_of(turn: Column, template: Template) -> Column:
    """Opening, text and closing of a turn, each with its loss flag; only texts are learned."""
    role, text = turn["role"], escape(turn["text"], template)
    known = reduce(lambda a, b: a | b, [role == n for n in template.roles if n != OTHER], F.lit(False))
    opening = F.concat(
        _by_role(role, template, lambda m: m.open),
        F.when(known, "").otherwise(F.concat(escape(role, template), F.lit(template.named))),
    )
    piece = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
    return F.array(
        piece(opening, F.lit(False)),
        piece(text, _by_role(role, template, lambda m: m.loss)),
        piece(_by_role(role, template, lambda m: m.close), F.lit(False)),
    )


def state_after(turns: Column, template: Template) -> Column:
    """Where the machine stands after all turns; NULL once a role had no move."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}>{role}", to)])
    step = lambda state, t: F.try_element_at(moves, F.concat(state, F.lit(">"), t["role"]))
    return F.aggregate(turns, F.lit(template.start), step)


def format_chats(
    rows: DataFrame, template: Template = INSTRUCT, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: its id, ``segments`` (text, loss), ``formatted`` and ``valid``.

    Turns are taken by number; equal numbers by role and text, NULL numbers first.
    A NULL role or text counts as empty, an unknown role is formatted under its own
    name and makes the order invalid, a NULL id is a conversation like any other.
    Repeated rows are turns of their own. Other columns are not read. An empty table
    gives no row.
    """
    one = F.struct(
        F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    gathered = rows.groupBy(F.col(f"`{conversation}`").alias(conversation)).agg(
        F.array_sort(F.collect_list(one)).alias("__turns")
    )
    return gathered.select(
        conversation,
        F.flatten(F.transform("__turns", lambda t: segments_of(t, template))).alias("segments"),
        F.coalesce(state_after(F.col("__turns"), template).isin(*template.final), F.lit(False)).alias("valid"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) of a formatted conversation."""
    openings = {re.escape(m.open): name for name, m in template.roles.items()}
    closings = "|".join(re.escape(m.close) for m in template.roles.values())
    named = re.escape(template.named)
    starts = "|".join(openings)
    pieces = F.filter(F.split(formatted, f"(?={starts})"), lambda p: p != "")

    def read(piece: Column) -> Column:
        body = F.regexp_replace(F.regexp_replace(piece, f"^(?:{starts})", ""), f"(?:{closings})$", "")
        other = piece.startswith(template.roles[OTHER].open)
        role = unescape(F.regexp_extract(body, f"(?s)^(.*){named}", 1), template)
        for name, mark in template.roles.items():
            if name != OTHER:
                role = F.when(piece.startswith(mark.open), F.lit(name)).otherwise(role)
        text = F.when(other, F.regexp_replace(body, f"(?s)^.*{named}", "")).otherwise(body)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.transform(pieces, read)


def learned_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped."""
    picked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(picked, lambda s: unescape(s["text"], template)), "")
