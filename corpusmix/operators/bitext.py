"""Translation sources: find the two sides of a pair, then emit one record per direction."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.frames import compute_once
from corpusmix.functions.text import first_usable, quoted, strip
from corpusmix.functions.tokens import Tokenizer


def _sides(df: DataFrame) -> tuple[Column, Column]:
    """English and Welsh text columns, chosen from the schema and not per row."""
    if "translation" not in df.columns:
        return (
            first_usable(df, fixed.ENGLISH_COLUMNS),
            first_usable(df, fixed.WELSH_COLUMNS),
        )
    kind = df.schema["translation"].dataType
    names = kind.fieldNames() if isinstance(kind, T.StructType) else ["en", "cy"]
    return tuple(
        F.col("translation")[name].cast("string") if name in names else F.lit("")
        for name in ("en", "cy")
    )


def _parse_json_pairs(df: DataFrame) -> DataFrame:
    """Turn a ``translation`` column of JSON texts into structs, parsed once per row."""
    if "translation" in df.columns and df.schema["translation"].dataType == T.StringType():
        parsed = F.from_json("translation", "en string, cy string", {"mode": "FAILFAST"})
        return compute_once(df, translation=parsed)
    return df


def map_bitext(df: DataFrame) -> DataFrame:
    """Add the stripped sides ``en_text`` and ``cy_text``; a null side is blank."""
    parsed = _parse_json_pairs(df)
    english, welsh = _sides(parsed)
    blank = F.lit("")
    return parsed.select(
        "*",
        strip(F.coalesce(english, blank)).alias("en_text"),
        strip(F.coalesce(welsh, blank)).alias("cy_text"),
    )


def drop_blank(df: DataFrame, left: str = "source_text", right: str = "target_text") -> DataFrame:
    """Keep rows whose two texts are both non-empty."""
    return df.where(f"{left} <> '' AND {right} <> ''")


def direction_struct(position: int, direction: str, sides: dict[str, str], extra: str = "") -> str:
    """SQL for one flat translation record; ``sides`` names the column of each language."""
    source, target = direction.split("-")
    return (
        f"named_struct('task', {quoted(fixed.TASK_TRANSLATION)}, "
        f"'source_text', {sides[source]}, 'target_text', {sides[target]}, "
        f"'source_lang_code', '{source}', 'target_lang_code', '{target}', "
        f"'emit_ord', {position}{extra})"
    )


def expand_directions(pairs: DataFrame, directions: Iterable[str]) -> DataFrame:
    """Records for each direction from ``en_text`` and ``cy_text``, in one pass.

    If the pairs carry token counts of their sides (``en_len``, ``cy_len``), the
    records get them as ``src_len`` and ``tgt_len``: each side is counted once,
    although two directions use it twice.
    """
    columns = pairs.columns
    records = []
    for position, direction in enumerate(directions):
        source, target = direction.split("-")
        lengths = f", 'src_len', {source}_len, 'tgt_len', {target}_len"
        extra = lengths if "en_len" in columns else ""
        sides = {"en": "en_text", "cy": "cy_text"}
        records.append(direction_struct(position, direction, sides, extra))
    kept = [name for name in columns if name not in {"en_text", "cy_text", "en_len", "cy_len"}]
    expanded = F.expr(f"inline(array({', '.join(records)}))")
    return drop_blank(pairs, "en_text", "cy_text").select(*kept, expanded)


def translation_records(
    df: DataFrame, directions: Iterable[str], tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Flat records of a bitext source; with a tokenizer, also their token counts."""
    pairs = map_bitext(df).select("order_key", "en_text", "cy_text")
    pairs = drop_blank(pairs, "en_text", "cy_text")
    if tokenizer is not None:
        pairs = pairs.select(
            "*",
            tokenizer.count(F.col("en_text")).alias("en_len"),
            tokenizer.count(F.col("cy_text")).alias("cy_len"),
        )
    return expand_directions(pairs, directions)
