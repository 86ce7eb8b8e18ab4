"""Chat formatting: a finite-state machine over roles, and a declarative template.

The template names, for each role, the marks around its texts and whether they count for the loss. A machine
over the roles, in turn order, says whether a conversation is well formed. A conversation becomes text segments
with a loss flag each. Control strings inside texts are broken by a backslash, and backslashes doubled, so marks
occur only where the template put them and every text can be read back. DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: Mapping[str, Role] = field(
        default_factory=lambda: {
            "system": Role("<<SYS>>\n", "\n<</SYS>>\n"),
            "user": Role("[INST] ", " [/INST]"),
            "assistant": Role("<s> ", " </s>", loss=True),
        }
    )
    #: Any other role: its name stands between the first two marks.
    other: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>", "<<END>>")
    #: Next state by state and role. Each state but those listed as ends needs a further turn.
    start: str = "start"
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    ends: tuple[str, ...] = ("answered",)

    @property
    def controls(self) -> list[str]:
        marks = [m for r in self.roles.values() for m in (r.open, r.close)] + list(self.other)
        return sorted({m.strip() for m in marks})


def escape(text: Column, template: Template) -> Column:
    """Backslashes doubled; a backslash after the first character of each control string."""
    heads = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in template.controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), heads, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def final_state(roles: Column, template: Template) -> Column:
    """State after all roles; `lost` once a role has no move."""
    moves = [x for (state, role), to in template.moves.items() for x in (F.lit(f"{state}>{role}"), F.lit(to))]
    table = F.create_map(*moves)
    step = lambda state, role: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit("lost")
    )
    return F.aggregate(roles, F.lit(template.start), step)


def turn_segments(role: Column, text: Column, template: Template) -> Column:
    """Array of (text, loss): mark, escaped text, mark."""
    segment = lambda value, loss: F.struct(value.alias("text"), F.lit(loss).alias("loss"))
    first, second, last = template.other
    name = F.concat(F.lit(first), escape(role, template), F.lit(second))
    body = escape(text, template)
    chosen = F.array(segment(name, False), segment(body, False), segment(F.lit(last), False))
    for known, marks in template.roles.items():
        parts = [segment(F.lit(marks.open), False), segment(body, marks.loss), segment(F.lit(marks.close), False)]
        chosen = F.when(role == known, F.array(*parts)).otherwise(chosen)
    return chosen


def segments(
    turns: DataFrame, template: Template | None = None, *, conv="conv_id", turn="turn", role="role", text="text"
) -> DataFrame:
    """(conv_id, turn, role, segments) per row of `turns`; needs no shuffle, so a conversation may have any length.

    Null text and null role are empty. Other columns are not read.
    """
    template = template or Template()
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return rows.select("conv_id", "turn", "role", turn_segments(F.col("role"), F.col("text"), template).alias("segments"))


def format_chats(turns: DataFrame, template: Template | None = None, **columns: str) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (array of text and loss, in order), formatted.

    Turns are ordered by turn, then role, then text: repeated rows stay, a null turn comes first, and rows
    without a conversation id form one of their own. `valid` is false where the machine has no move for a role or
    does not end in one of the template's ends; such conversations are formatted all the same. An empty table
    gives no rows. The result is one row of text per conversation, which a row's 2 GB bound.
    """
    template = template or Template()
    rows = segments(turns, template, **columns)
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "segments")))
    grouped = rows.groupBy("conv_id").agg(ordered.alias("turns"))
    state = final_state(F.transform("turns", lambda t: t.role), template)
    flat = grouped.select(
        "conv_id",
        state.isin(*template.ends).alias("valid"),
        F.flatten(F.transform("turns", lambda t: t.segments)).alias("segments"),
    )
    return flat.select("*", F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"))


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """Array of (role, text) that a formatted conversation holds, unescaped."""
    template = template or Template()
    first, second, last = map(re.escape, template.other)
    marks = [f"{re.escape(r.open)}.*?{re.escape(r.close)}" for r in template.roles.values()]
    pattern = "(?s)" + "|".join([*marks, f"{first}.*?{second}.*?{last}"])
    first, second, last = template.other

    def parsed(whole: Column) -> Column:
        inner = F.substr(whole, F.lit(len(first) + 1), F.length(whole) - len(first) - len(last))
        role, rest = F.substring_index(inner, second, 1), F.substring_index(inner, second, -1)
        for name, marks in template.roles.items():
            here = whole.startswith(marks.open)
            size = F.length(whole) - len(marks.open) - len(marks.close)
            role = F.when(here, name).otherwise(role)
            rest = F.when(here, F.substr(whole, F.lit(len(marks.open) + 1), size)).otherwise(rest)
        return F.struct(unescape(role).alias("role"), unescape(rest).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), parsed)


def read_loss_text(segment_array: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(F.filter(segment_array, lambda s: s.loss), lambda s: unescape(s.text)), ""
    )
