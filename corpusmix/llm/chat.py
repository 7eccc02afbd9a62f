"""Conversations as one formatted string each, with a loss mask, and back.

Turns are collected and sorted, neighbours of one role become one block, and the
pieces are put together, all with Spark expressions. Control strings inside texts are
broken by a backslash after their first character, and backslashes are doubled,
so reading back is exact. A conversation is one row in the end, so its turns meet in one
task by definition; nothing larger than a conversation does.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around the blocks of each role, around those of other roles, and between turns."""

    blocks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>> ", " <</SYS>>"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": ("<s> ", " </s>"),
        }
    )
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
    between: str = " [TURN] "
    learnt: tuple[str, ...] = ("assistant",)

    @property
    def opening(self) -> list[str]:
        return [pair[0] for pair in self.blocks.values()] + [self.other[0]]

    @property
    def control(self) -> list[str]:
        marks = [mark for pair in self.blocks.values() for mark in pair]
        return [mark.strip() for mark in (*marks, *self.other, self.between)]


DEFAULT = Template()
# Code points per part of a string that is read at many places.
PART = 4_096


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """``text`` without any control string of the template."""
    rests: dict[str, list[str]] = {}
    for mark in template.control:
        rests.setdefault(mark[0], []).append(re.escape(mark[1:]))
    starts = "|".join(f"{re.escape(first)}(?={'|'.join(rest)})" for first, rest in rests.items())
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({starts})", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "\\\\(\\\\?)", "$1")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a ``value`` that is computed once, though it comes more than once or inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(numbers: Column) -> Column:
    """Sums of the first one, two, three ... of an array of whole numbers.

    Each round adds the sum that stands a power of two before, so n numbers take n log n steps; an ``aggregate``
    that appends to an array copies it each time.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(31)])

    def sums(given: Column) -> Column:
        return F.aggregate(
            F.filter(steps, lambda step: step < F.size(given)),
            given,
            lambda done, step: F.transform(
                done, lambda value, at: value + F.coalesce(F.get(done, at - step), F.lit(0).cast("bigint"))
            ),
        )

    return let(F.transform(numbers, lambda n: n.cast("bigint")), sums)


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = DEFAULT,
) -> DataFrame:
    """``conv_id, formatted, spans``: the string, and where its learnt texts lie.

    ``spans`` holds ``start`` (from 0) and ``length`` in code points, one for each turn of
    a learnt role, the escaped text without any mark. Null text or role counts as empty. Turns
    of one number are ordered by role and text, and repeated rows are turns of their own. A null
    conversation id is one conversation. Other columns are left aside, and an empty table gives an empty one. The work
    grows with a conversation's length, but for a logarithm of its turns.
    """
    blank = F.lit("")
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), blank).alias("role"),
            F.coalesce(F.col(text), blank).alias("text"),
        ).alias("said"),
    )
    sorted_turns = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("_turns"))

    def opened(who: Column) -> Column:
        out = F.concat(F.lit(template.other[0]), escape(who, template), F.lit(template.other[1]))
        for name, (mark, _) in template.blocks.items():
            out = F.when(who == name, F.lit(mark)).otherwise(out)
        return out

    def closed(who: Column) -> Column:
        out = F.lit(template.other[2])
        for name, (_, mark) in template.blocks.items():
            out = F.when(who == name, F.lit(mark)).otherwise(out)
        return out

    def pieces(all_turns: Column) -> Column:
        def piece(one: Column, at: Column) -> Column:
            follows = F.coalesce(F.get(all_turns, at - 1)["role"] == one["role"], F.lit(False))
            goes_on = F.coalesce(F.get(all_turns, at + 1)["role"] == one["role"], F.lit(False))
            return F.struct(
                F.when(follows, blank).otherwise(opened(one["role"])).alias("before"),
                escape(one["text"], template).alias("text"),
                F.when(goes_on, F.lit(template.between)).otherwise(closed(one["role"])).alias("after"),
                one["role"].isin(*template.learnt).alias("learnt"),
            )

        return F.transform(all_turns, piece)

    # A one-element array binds the sorted turns, so that neighbours are looked up in the value.
    merged = sorted_turns.select(
        "conv_id", F.flatten(F.transform(F.array("_turns"), pieces)).alias("_pieces")
    )
    ends = running_sums(
        F.transform("_pieces", lambda p: F.length(p["before"]) + F.length(p["text"]) + F.length(p["after"]))
    )

    def span(piece: Column, end: Column) -> Column:
        length = F.length(piece["text"])
        start = end - F.length(piece["after"]) - length
        return F.struct(start.cast("bigint").alias("start"), length.cast("bigint").alias("length"))

    spans = F.filter(
        F.zip_with("_pieces", ends, lambda piece, end: F.when(piece["learnt"], span(piece, end))),
        lambda one: one.isNotNull(),
    )
    joined = F.array_join(
        F.transform("_pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), ""
    )
    return merged.select("conv_id", joined.alias("formatted"), spans.alias("spans"))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The array of ``role, text`` that a formatted string holds."""
    starts = "|".join(re.escape(mark) for mark in template.opening)
    blocks = F.filter(F.split(formatted, f"(?={starts})"), lambda block: block != "")

    def body(block: Column, opening: Column, closing: str) -> Column:
        inner = F.substr(
            block,
            F.length(opening) + 1,
            F.length(block) - F.length(opening) - len(closing),
        )
        return F.split(inner, re.escape(template.between))

    def turns(block: Column) -> Column:
        named = F.substring_index(block, template.other[1], 1)
        name = F.substr(named, F.lit(len(template.other[0]) + 1))
        texts = body(block, F.concat(named, F.lit(template.other[1])), template.other[2])
        role = unescape(name)
        for known, (opening, closing) in template.blocks.items():
            is_it = F.startswith(block, F.lit(opening))
            texts = F.when(is_it, body(block, F.lit(opening), closing)).otherwise(texts)
            role = F.when(is_it, F.lit(known)).otherwise(role)
        # The role is read once per block, not once per text.
        return let(
            F.struct(role.alias("role"), texts.alias("texts")),
            lambda read: F.transform(
                read["texts"], lambda text: F.struct(read["role"].alias("role"), unescape(text).alias("text"))
            ),
        )

    return F.flatten(F.transform(blocks, turns))


def learnt_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and put together.

    The string is cut into parts first, since finding a code point means counting from the start.
    """

    def cut(parts: Column, span: Column) -> Column:
        start, end = span["start"], span["start"] + span["length"]

        def piece(k: Column) -> Column:
            low, high = F.greatest(start - k * PART, F.lit(0)), F.least(end - k * PART, F.lit(PART))
            return F.substr(F.get(parts, k.cast("int")), (low + 1).cast("int"), (high - low).cast("int"))

        first, last = F.floor(start / PART), F.floor((end - 1) / PART)
        return F.when(
            span["length"] > 0, unescape(F.array_join(F.transform(F.sequence(first, last), piece), ""))
        ).otherwise("")

    parts = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))
    return let(parts, lambda whole: F.array_join(F.transform(spans, lambda span: cut(whole, span)), ""))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read back from the strings."""
    read = formatted.select(
        "conv_id",
        "formatted",
        F.inline(
            F.array(
                F.struct(
                    read_turns(F.col("formatted")).alias("turns"),
                    learnt_text(F.col("formatted"), F.col("spans")).alias("learnt"),
                )
            )
        ),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learnt"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
