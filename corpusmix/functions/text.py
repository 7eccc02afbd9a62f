"""Column expressions on text. All of them stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmix.functions import fixed_values as fixed


def strip(text: Column) -> Column:
    """Remove outer Unicode white space; plain ``trim`` only knows the blank."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def is_missing(text: Column) -> Column:
    """True for null and for the words that stand for "no value"."""
    return text.isNull() | F.lower(text).isin(*fixed.MISSING_WORDS)


def column(name: str) -> Column:
    """A column by its literal name, which may hold blanks, dots or hyphens."""
    return F.col("`" + name.replace("`", "``") + "`")


def _usable(df: DataFrame, name: str) -> Column:
    """The value as text, or null where it is empty, zero or false."""
    value = column(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.when(value != 0, value.cast("string"))
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("True"))
    return F.nullif(value.cast("string"), F.lit(""))


def first_usable(df: DataFrame, names: Iterable[str]) -> Column:
    """First non-empty value among the named columns that ``df`` has.

    Emptiness is tested before stripping: a value of only white space is taken,
    and becomes blank afterwards.
    """
    present = [_usable(df, name) for name in names if name in df.columns]
    return F.coalesce(*present, F.lit("")) if present else F.lit("")


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def fill_sql(template: str, **slots: str) -> str:
    """``template`` with each ``{slot}`` replaced by a SQL expression, as one ``concat``."""
    names = "|".join(re.escape(name) for name in slots)
    pieces = re.split("{(" + names + ")}", template)
    parts = [slots[piece] if at % 2 else quoted(piece) for at, piece in enumerate(pieces)]
    return f"concat({', '.join(part for part in parts if part != quoted(''))})"


def fill(template: str, **slots: str) -> Column:
    return F.expr(fill_sql(template, **slots))


def pair_hash(source: Column, target: Column, *more: Column) -> Column:
    """Hex SHA-1 of the pair, and of what more is given, with a NUL between; null counts as empty."""
    parts = [F.coalesce(part, F.lit("")) for part in (source, target, *more)]
    return F.sha1(F.concat_ws("\0", *parts))


def keyed_hash(seed: object, key: Column) -> Column:
    """Hex MD5 of ``key`` under ``seed``: a repeatable stand-in for a random number."""
    return F.md5(F.concat(F.lit(f"{seed}\0"), key))


def pick(hashed: Column, count: int) -> Column:
    """A number in ``[0, count)`` from the first four hex digits of a hash."""
    return (F.conv(F.substring(hashed, 1, 4), 16, 10).cast("int") % F.lit(count)).cast("int")


def row_key(df: DataFrame, id_columns: Iterable[str] = ()) -> Column:
    """Text that identifies a row: its declared id, or a digest of all its columns."""
    names = list(id_columns)
    if names:
        parts = [F.coalesce(column(name).cast("string"), F.lit("")) for name in names]
        return reduce(lambda left, right: F.concat(left, F.lit("\0"), right), parts)
    return row_digest(df)


def row_digest(df: DataFrame) -> Column:
    """Hex digest of all columns, with every value in full.

    JSON shortens time stamps and leaves nulls out, so a hash of the values themselves and
    of which ones are null goes with it; hashes in turn pass over nulls inside of values.
    """
    names = df.columns
    hashable = [name for name in names if not _has_map(df.schema[name].dataType)]
    parts = [column(name).isNull() for name in names] + [column(name) for name in hashable]
    return F.concat(
        F.md5(F.to_json(F.struct(*[column(name) for name in names]))),
        F.lpad(F.hex(F.xxhash64(*parts)), 16, "0"),
    )


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)
