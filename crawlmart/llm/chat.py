"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_conversations`` gathers the turns of each conversation, runs the state machine over
their roles and emits text segments, each with a loss flag. ``read_back`` recovers the turns
from the formatted text alone.

Defined results: null text is empty text; a null role is the empty role; roles outside the
template are written with their name and are an error of turn order; turns with the same
number, also repeated rows, follow each other by role, then text; null turns come last; rows
with a null conv_id form one conversation. Further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How roles are written, which control strings must not occur in a text, and which role
    may follow which. Each control string begins with one of ``heads``, and none has a head
    further on."""

    turns: Mapping[str, Turn]
    other: Turn  # for all other roles; between them stand the role and other_text
    other_text: str
    control: tuple[str, ...]
    heads: str
    follows: Mapping[str, tuple[str, ...]]  # state -> roles that may come next
    accepts: tuple[str, ...]  # states in which a conversation may end


INSTRUCT = Template(
    turns={
        "system": Turn("[SYS] ", " [/SYS]\n"),
        "user": Turn("[INST] ", " [/INST]\n"),
        "assistant": Turn("<s> ", " </s>\n", loss=True),
    },
    other=Turn("[ROLE] ", " [/ROLE]\n"),
    other_text=" [TEXT] ",
    control=(
        "[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]",
    ),
    heads="[<",
    follows={
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    accepts=("assistant",),
)
ERROR = "error"


def _tails(template: Template) -> str:
    return "|".join(re.escape(c[1:]).replace("/", "\\/") for c in template.control)


def escape(text: Column, template: Template) -> Column:
    """One more backslash behind the head of each control string, whether it has some or
    none: no control string is left, and ``unescape`` takes exactly one away."""
    heads = re.escape(template.heads)
    return F.regexp_replace(text, rf"([{heads}]\\*)(?={_tails(template)})", "$1\\\\")


def unescape(text: Column, template: Template) -> Column:
    heads = re.escape(template.heads)
    return F.regexp_replace(text, rf"([{heads}]\\*)\\(?={_tails(template)})", "$1")


def _state_after(roles: Column, template: Template) -> Column:
    """The state machine's last state; a move that the template lacks leads to ERROR."""
    moves = [(f"{state}>{role}", role) for state, to in template.follows.items() for role in to]
    table = F.create_map(*[F.lit(x) for move in moves for x in move])

    def step(state: Column, role: Column) -> Column:
        move = F.element_at(table, F.concat(state, F.lit(">"), role))
        return F.coalesce(move, F.lit(ERROR))

    return F.aggregate(roles, F.lit("start"), step)


def _segments(turn: Column, template: Template) -> Column:
    def piece(text: Column | str, loss: bool = False) -> Column:
        text = F.lit(text) if isinstance(text, str) else text
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    text, other = escape(turn["text"], template), template.other
    head = F.concat(
        F.lit(other.open), escape(turn["role"], template), F.lit(template.other_text)
    )
    out = F.array(piece(head), piece(text, other.loss), piece(other.close))
    for role, how in template.turns.items():
        own = F.array(piece(how.open), piece(text, how.loss), piece(how.close))
        out = F.when(turn["role"] == role, own).otherwise(out)
    return out


def format_conversations(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, valid (turn order), complete (valid and ended in an accepting state),
    segments (array of text and loss flag, in order) and formatted (all their text)."""
    turn = F.struct(
        F.col("turn").isNull().alias("last"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = rows.select("conv_id", turn.alias("t")).groupBy("conv_id")
    turns = grouped.agg(F.array_sort(F.collect_list("t")).alias("turns"))
    state = _state_after(F.transform("turns", lambda t: t["role"]), template)
    segments = F.flatten(F.transform("turns", lambda t: _segments(t, template)))
    out = turns.select(
        "conv_id", F.explode(F.array(F.struct(state.alias("state"), segments.alias("all")))).alias("s")
    )
    return out.select(
        "conv_id",
        (F.col("s.state") != ERROR).alias("valid"),
        F.col("s.state").isin(*template.accepts).alias("complete"),
        F.col("s.all").alias("segments"),
        F.array_join(F.transform("s.all", lambda p: p["text"]), "").alias("formatted"),
    )


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """Turns (role, text) of a formatted conversation, recovered from its text alone."""
    marks = [*template.turns.values(), template.other]
    one = "|".join(f"{re.escape(m.open)}.*?{re.escape(m.close)}" for m in marks)

    def turn(whole: Column) -> Column:
        def inside(how: Turn) -> Column:
            size = F.length(whole) - len(how.open) - len(how.close)
            return F.substring(whole, F.lit(len(how.open) + 1), size)

        def made(role: Column, text: Column) -> Column:
            return F.struct(
                unescape(role, template).alias("role"), unescape(text, template).alias("text")
            )

        both = inside(template.other)
        cut = F.instr(both, template.other_text)
        role = F.substring(both, F.lit(1), cut - 1)
        text = F.substring(both, cut + len(template.other_text), F.length(both))
        out = made(role, text)
        for name, how in template.turns.items():
            out = F.when(whole.startswith(how.open), made(F.lit(name), inside(how))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(f"(?s){one}"), F.lit(0)), turn)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    marked = F.filter(segments, lambda p: p["loss"])
    return F.array_join(F.transform(marked, lambda p: unescape(p["text"], template)), "")
