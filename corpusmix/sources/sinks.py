"""Sinks: the prepared table, JSON lines and one-document summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from corpusmix.sources.published import ROWS_PER_FILE, Version, publish, shuffle_key


def write_prepared(
    df: DataFrame,
    path: str,
    shuffled: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    counters: dict[str, Column] | None = None,
) -> Version:
    """The next version of the prepared table at ``path``; readers see it when it is complete.

    ``shuffled`` gives the files and their rows the seeded random order of ``pair_hash``. Without it rows stay in the
    files of the tasks that made them, which a deduplicated pool leaves in the order of its hashes.
    """
    return publish(df, path, shuffle_key() if shuffled else None, rows_per_file, counters)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are kept, text is not escaped to ASCII."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """One JSON document, for results that are one line by construction, such as totals."""
    write_json_lines(df.coalesce(1), path)
