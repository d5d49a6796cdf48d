"""Chat formatting from a declarative template.

A ``Template`` says which roles may follow which (a finite-state machine), how
a turn is marked, and whose text is trained on.  ``format_chats`` orders the
turns of each conversation, runs the machine over their roles, and emits the
segments of the formatted text, each with its loss flag; joined, the segments
are the formatted text.  ``read_back`` parses that text again.

Control strings inside texts (and roles) are broken up with an escape
character after their first character, and the escape character itself is
escaped, so a text can never end its own turn and is read back exactly.

Scale: one shuffle by conversation.  A conversation is one training record, so
its turns meet in one row; nothing else does, and all steps are DataFrame
expressions.

Defined results: null texts and roles are empty; an unknown role is formatted
like any other but makes the conversation invalid; turns with the same number
are ordered by role, then text; repeated rows are turns of their own; rows
without a conversation id form one conversation; empty tables give an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\x1b"


@dataclass(frozen=True)
class Template:
    turn_start: str = "<|im_start|>"
    role_end: str = "\n"
    turn_end: str = "<|im_end|>\n"
    #: strings that must not stand in a text as they are
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>",
                                 "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    trained: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; conversations start in "start"
    turns: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "opened", "user": "asked"},
        "opened": {"user": "asked"},
        "asked": {"assistant": "answered", "tool": "asked"},
        "answered": {"user": "asked"},
    })
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        for a in self.controls:
            if len(a) < 2 or ESCAPE in a:
                raise ValueError(f"not usable as a control string: {a!r}")
            for b in self.controls:
                if any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"{b!r} could start inside {a!r}")
        for marker in (self.turn_start, self.turn_end):
            if not any(marker.startswith(c) for c in self.controls):
                raise ValueError(f"{marker!r} does not start with a control string")


def escaped(text: Column, how: Template) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + "1" + c[1:])),
                  how.controls, text)


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + "1"), F.lit("")), F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def _escaped_role(role: Column, how: Template) -> Column:
    return F.replace(escaped(role, how), F.lit(how.role_end), F.lit(ESCAPE + "2"))


def _unescaped_role(role: Column, how: Template) -> Column:
    return unescaped(F.replace(role, F.lit(ESCAPE + "2"), F.lit(how.role_end)))


def _next_state(how: Template):
    def step(state: Column, role: Column) -> Column:
        moves = [(s, r, to) for s, by_role in how.turns.items() for r, to in by_role.items()]
        s, r, to = moves[0]
        out = F.when((state == s) & (role == r), to)
        for s, r, to in moves[1:]:
            out = out.when((state == s) & (role == r), to)
        return out.otherwise("refused")
    return step


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", how: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, valid (the machine ended in a final
    state), segments array<struct<text, loss>>."""
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).alias("x"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    state = F.aggregate("xs", F.lit("start"), lambda s, x: _next_state(how)(s, x["role"]))

    def segments(x: Column) -> Column:
        def part(t, loss):
            return F.struct(t.alias("text"), loss.alias("loss"))
        no = F.lit(False)
        return F.array(
            part(F.concat(F.lit(how.turn_start), _escaped_role(x["role"], how), F.lit(how.role_end)), no),
            part(escaped(x["text"], how), x["role"].isin(*how.trained)),
            part(F.lit(how.turn_end), no))

    return chats.select("conv_id", state.isin(*how.final).alias("valid"),
                        F.flatten(F.transform("xs", segments)).alias("segments"))


def formatted(segments: str | Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: str | Column) -> Column:
    """All text that is trained on, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescaped(s["text"])), "")


def read_back(text: Column, how: Template = Template()) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    parts = F.split(text, r"\Q" + how.turn_start + r"\E")

    def turn(part: Column) -> Column:
        head = F.substring_index(part, how.role_end, 1)
        start = F.length(head) + len(how.role_end)
        return F.struct(
            _unescaped_role(head, how).alias("role"),
            unescaped(F.substring(part, start + 1, F.length(part) - start - len(how.turn_end))).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)
