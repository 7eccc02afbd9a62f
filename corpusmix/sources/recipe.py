"""The recipe: which sources to read, how much of each, and how to mix them.

A recipe is kilobytes of JSON, so it is parsed on the driver, once, into typed
values. Everything that depends on row counts is decided later, by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusmix.functions import fixed_values as fixed

SECTIONS = ("translation", "dictionary", "instruction")

RECIPE_SCHEMA = T.StructType(
    [
        T.StructField("source_ord", T.IntegerType(), False),
        T.StructField("section", T.StringType(), False),
        T.StructField("dataset_source", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("usage", T.DoubleType(), False),
        T.StructField("directions", T.StringType(), True),
        T.StructField("language", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class SourceEntry:
    """One source of the recipe. ``source_ord`` is its place in the pool."""

    section: str
    name: str
    path: str
    source_ord: int
    usage: float = 1.0
    directions: tuple[str, ...] = fixed.DEFAULT_DIRECTIONS
    language: str = "en"
    config: str | None = None
    format: str = "parquet"
    id_columns: tuple[str, ...] = ()
    schema: str | None = None
    multi_line: bool = True
    corrupt_column: str | None = None

    @property
    def active(self) -> bool:
        return self.usage > 0


@dataclass(frozen=True)
class Recipe:
    entries: tuple[SourceEntry, ...]
    translation_share: float = 0.7
    instruction_share: float = 0.3
    eval_size: int | float = fixed.DEFAULT_EVAL_ROWS
    max_tokens: int = fixed.MAX_TOKENS

    @property
    def active_entries(self) -> tuple[SourceEntry, ...]:
        """Sources that are read at all; a usage of zero means never opened."""
        return tuple(entry for entry in self.entries if entry.active)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                entry.source_ord,
                entry.section,
                entry.name,
                entry.path,
                entry.usage,
                None if entry.section == "instruction" else ",".join(entry.directions),
                entry.language if entry.section == "instruction" else None,
            )
            for entry in self.entries
        ]
        return spark.createDataFrame(rows, RECIPE_SCHEMA)


def parse_directions(names: Any) -> tuple[str, ...]:
    """Normalised directions in the order given, each once."""
    result: dict[str, None] = {}
    for name in fixed.DEFAULT_DIRECTIONS if names is None else names:
        direction = str(name).strip().lower().replace("_", "-")
        if direction not in fixed.DIRECTIONS:
            raise ValueError(f"direction {name!r} is not one of {', '.join(fixed.DIRECTIONS)}")
        result[direction] = None
    return tuple(result)


def parse_ratio(ratio: Any) -> tuple[float, float]:
    """``"70:30"`` or a pair of numbers as two shares that sum to one."""
    parts = ratio.split(":") if isinstance(ratio, str) else list(ratio)
    if len(parts) < 2:
        raise ValueError(f"ratio {ratio!r} needs a translation part and an instruction part")
    numbers = [float(part) for part in parts]
    if min(numbers) <= 0:
        raise ValueError(f"every part of the ratio {ratio!r} must be above zero")
    total = sum(numbers)
    return numbers[0] / total, numbers[1] / total


def eval_rows(eval_size: int | float, total: int) -> int:
    """Rows to hold out: a float is a share of ``total``, an int is a row count."""
    if isinstance(eval_size, float):
        if eval_size > 1:
            raise ValueError(f"eval_size {eval_size} is a share and must not exceed 1")
        wanted = round(total * eval_size)
    else:
        wanted = int(eval_size)
    return max(1, min(wanted, total - 1))


def _entry(section: str, name: str, info: Mapping[str, Any], source_ord: int) -> SourceEntry:
    usage = float(info.get("usage", 1.0))
    if not 0 <= usage <= 1:
        raise ValueError(f"usage of {name!r} must lie between 0 and 1, not {usage}")
    return SourceEntry(
        section=section,
        name=name,
        path=info["path"],
        source_ord=source_ord,
        usage=usage,
        directions=parse_directions(info.get("directions")),
        language=info.get("language", "en"),
        config=info.get("config"),
        format=info.get("format", "parquet"),
        id_columns=tuple(info.get("id_columns", ())),
        schema=info.get("schema"),
        multi_line=bool(info.get("multi_line", True)),
        corrupt_column=info.get("corrupt_column"),
    )


def parse_recipe(content: Mapping[str, Any]) -> Recipe:
    entries: list[SourceEntry] = []
    for section in SECTIONS:
        for name, info in content.get(f"{section}_data", {}).items():
            entries.append(_entry(section, name, info, len(entries)))
    strategy = content.get("meta_strategy", {})
    translation, instruction = parse_ratio(strategy.get("target_ratio", fixed.DEFAULT_RATIO))
    return Recipe(
        entries=tuple(entries),
        translation_share=translation,
        instruction_share=instruction,
        eval_size=strategy.get("eval_size", fixed.DEFAULT_EVAL_ROWS),
        max_tokens=int(strategy.get("max_seq_len", fixed.MAX_TOKENS)),
    )


def load_recipe(path: str) -> Recipe:
    with open(path, encoding="utf-8") as handle:
        return parse_recipe(json.load(handle))
