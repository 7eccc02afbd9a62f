"""Instruction sources: the first user turn and the first answer of each conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.frames import compute_once
from corpusmix.functions.text import first_usable, strip


def _content_text(content: Column, kind: T.DataType) -> Column:
    """Turn content as text; a list of parts is joined by blanks."""
    if isinstance(kind, T.ArrayType):
        part_kind = kind.elementType
        if isinstance(part_kind, T.StructType):
            has_text = "text" in part_kind.fieldNames()
            content = F.transform(content, lambda part: part["text"] if has_text else F.to_json(part))
        return F.array_join(content, " ")
    return content.cast("string")


def _first_turn(turns: Column, kind: T.StructType, roles: Sequence[str]) -> Column:
    """Text of the first non-blank turn with one of the roles, or an empty text."""
    content_kind = kind["content"].dataType
    spoken = F.transform(
        F.filter(turns, lambda turn: F.lower(turn["role"].cast("string")).isin(*roles)),
        lambda turn: strip(_content_text(turn["content"], content_kind)),
    )
    return F.coalesce(F.get(F.filter(spoken, lambda text: text != ""), F.lit(0)), F.lit(""))


def _from_turns(df: DataFrame, name: str) -> tuple[Column, Column]:
    """Both sides from an array of turns; turns without role and content give none."""
    kind = df.schema[name].dataType.elementType
    readable = isinstance(kind, T.StructType) and {"role", "content"} <= set(kind.fieldNames())
    if not readable:
        return F.lit(""), F.lit("")
    turns = F.col(name)
    return (
        _first_turn(turns, kind, fixed.USER_ROLES),
        _first_turn(turns, kind, fixed.ASSISTANT_ROLES),
    )


def _flat_record(df: DataFrame, source: Column, target: Column, language: Column) -> DataFrame:
    """The flat record, with its texts taken from the turns once, whatever filters follow."""
    picked = compute_once(
        df.select("*", language.alias("_language")), source_text=source, target_text=target
    )
    return picked.select(
        "order_key",
        F.lit(fixed.TASK_INSTRUCTION).alias("task"),
        "source_text",
        "target_text",
        F.col("_language").alias("source_lang_code"),
        F.col("_language").alias("target_lang_code"),
        F.lit(0).alias("emit_ord"),
    )


def instruction_records(df: DataFrame, language: str | Column = "en") -> DataFrame:
    """Flat records of an instruction source, blank sides included.

    Per row: ``messages`` if it is a list, else ``conversations`` if that is one,
    else the flat columns. A list without usable turns does not fall through.
    An answer may stand before the question.
    """
    source = strip(first_usable(df, fixed.INSTRUCTION_SOURCE_COLUMNS))
    target = strip(first_usable(df, fixed.INSTRUCTION_TARGET_COLUMNS))
    for name in ("conversations", "messages"):
        if name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType):
            user, answer = _from_turns(df, name)
            is_list = F.col(name).isNotNull()
            source = F.when(is_list, user).otherwise(source)
            target = F.when(is_list, answer).otherwise(target)
    code = F.lit(language) if isinstance(language, str) else language
    return _flat_record(df, source, target, code)


def turn_table_records(
    turns: DataFrame, conversation: str, turn: str, role: str, text: str
) -> DataFrame:
    """The same rule for tables with one row per turn: ``conversation, source_text, target_text``.

    Minima combine before the shuffle, so a conversation of any length costs each
    task two candidate turns and is never gathered anywhere.
    """
    spoken = strip(F.col(text))

    def first(roles: Sequence[str]) -> Column:
        usable = F.lower(F.col(role)).isin(*roles) & (spoken != "")
        earliest = F.min(F.when(usable, F.struct(F.col(turn), spoken.alias("said"))))
        return F.coalesce(earliest["said"], F.lit(""))

    return turns.groupBy(conversation).agg(
        first(fixed.USER_ROLES).alias("source_text"),
        first(fixed.ASSISTANT_ROLES).alias("target_text"),
    )
