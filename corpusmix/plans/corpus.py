"""From a recipe to a prepared table.

The pool is one lazy plan over all sources. It is written twice: after the
budget, because several later stages read it, and after deduplication, because
counts decide the stages that follow. Those stages do not move rows: a row is
compared with the last key its task and its stratum may take.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.tokens import PatternTokenizer, Tokenizer
from corpusmix.operators import dedup
from corpusmix.operators.bitext import drop_blank, translation_records
from corpusmix.operators.budget import enforce_budget, measure
from corpusmix.operators.conversations import instruction_records
from corpusmix.operators.dictionary import dictionary_records
from corpusmix.operators.prompts import TRANSLATION_TEMPLATE
from corpusmix.operators.rebalance import balance_directions, rebalance
from corpusmix.operators.reports import task_counters, with_shares
from corpusmix.operators.selection import take_shares
from corpusmix.operators.split import stratified_split
from corpusmix.session import StageLedger, materialize_counted
from corpusmix.sources.published import ROWS_PER_FILE, Version
from corpusmix.sources.readers import read_source, with_order_key
from corpusmix.sources.recipe import Recipe, SourceEntry
from corpusmix.sources.sinks import write_json_lines, write_prepared, write_summary

Loader = Callable[[SparkSession, SourceEntry], DataFrame]


def split_counters() -> dict[str, Column]:
    return {
        **task_counters(),
        "training_split_rows": F.count_if(F.col("split") == "train"),
        "eval_split_rows": F.count_if(F.col("split") == "test"),
    }


def usage_slices(frames: list[DataFrame], entries: tuple[SourceEntry, ...]) -> list[DataFrame]:
    """The share of each source that the recipe asks for, drawn by its seeded order, all in one selection."""
    keyed = [with_order_key(df, entry) for df, entry in zip(frames, entries)]
    cut = [at for at, entry in enumerate(entries) if entry.usage < 1]
    for at, taken in zip(cut, take_shares([(keyed[at], entries[at].usage) for at in cut])):
        keyed[at] = taken
    return keyed


def source_records(df: DataFrame, entry: SourceEntry, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Flat records of a keyed source by the rules of its section, without blank ones.

    Translation records carry their token counts if there is a tokenizer, since
    each side is counted once for both directions.
    """
    if entry.section == "translation":
        return translation_records(df, entry.directions, tokenizer)
    if entry.section == "dictionary":
        return drop_blank(dictionary_records(df, entry.directions))
    return drop_blank(instruction_records(df, entry.language))


def tagged(records: DataFrame, entry: SourceEntry) -> DataFrame:
    return records.select(
        "*",
        F.lit(entry.section).alias("section"),
        F.lit(entry.name).alias("dataset_source"),
        F.lit(entry.source_ord).alias("source_ord"),
    )


def build_pool(
    spark: SparkSession,
    recipe: Recipe,
    loader: Loader = read_source,
    tokenizer: Tokenizer | None = PatternTokenizer(),
    template: str = TRANSLATION_TEMPLATE,
) -> DataFrame:
    """All sources in one table, within the token budget.

    Without a tokenizer the budget is left out, and no row is over its limit.
    """
    measured: list[DataFrame] = []
    unmeasured: list[DataFrame] = []
    entries = recipe.active_entries
    for entry, rows in zip(entries, usage_slices([loader(spark, entry) for entry in entries], entries)):
        records = source_records(rows, entry, tokenizer)
        has_counts = tokenizer is not None and entry.section == "translation"
        (measured if has_counts else unmeasured).append(tagged(records, entry))
    if not measured and not unmeasured:
        raise ValueError("the recipe has no source with a usage above zero")
    if tokenizer is None:
        return _union(unmeasured).withColumn("over_limit", F.lit(False))
    # Budget expressions are planned and compiled once for all sources.
    if unmeasured:
        measured.append(measure(_union(unmeasured), tokenizer))
    return enforce_budget(_union(measured), tokenizer, recipe.max_tokens, template=template)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def source_usage(spark: SparkSession, recipe: Recipe, loader: Loader = read_source) -> DataFrame:
    """Per active source: rows available and rows used of it (before expansion)."""
    parts = [
        loader(spark, entry)
        .agg(F.count("*").alias("rows_available"))
        .select(
            F.lit(entry.source_ord).alias("source_ord"),
            "rows_available",
            F.floor(F.col("rows_available").cast("double") * entry.usage)
            .cast("bigint")
            .alias("source_rows_used"),
        )
        for entry in recipe.active_entries
    ]
    counts = _union(parts)
    return recipe.to_frame(spark).where(F.col("usage") > 0).join(counts, "source_ord")


@dataclass(frozen=True)
class Corpus:
    """The stages of a build. ``pool`` and ``unique`` are written tables.

    ``counts`` has what was counted while tables were written, so that no report needs to read them again.
    Used as a context, the stages are removed at its end; else they are left for the cluster's clean-up.
    """

    pool: DataFrame
    unique: DataFrame
    mixed: DataFrame
    split: DataFrame
    ledger: StageLedger
    counts: dict[str, int]

    def __enter__(self) -> Corpus:
        return self

    def __exit__(self, *_: object) -> None:
        self.ledger.release()

    def duplicates(self) -> DataFrame:
        return dedup.duplicate_groups(self.pool)

    def _counted(self, names: tuple[str, ...]) -> DataFrame | None:
        """One line of counts that are known already; None if one is not."""
        if not set(names) <= set(self.counts):
            return None
        kinds = ", ".join(f"{name} bigint" for name in names)
        return self.split.sparkSession.createDataFrame([tuple(self.counts[name] for name in names)], kinds)

    def removed_counts(self) -> DataFrame:
        """One line: rows before and after deduplication and mixing, and what these removed."""
        names = ("pool_rows", "unique_rows", "total_rows")
        line = self._counted(names)
        if line is None:
            written = self._counted(names[:2])
            line = self.mixed.agg(F.count("*").alias("total_rows")).select(
                *[F.lit(value).cast("bigint").alias(name) for name, value in written.first().asDict().items()],
                "total_rows",
            )
        return line.select(
            "*",
            (F.col("pool_rows") - F.col("unique_rows")).alias("duplicates_removed"),
            (F.col("unique_rows") - F.col("total_rows")).alias("removed_by_rebalancing"),
        )

    def summary(self) -> DataFrame:
        """One line: sizes, shares, both splits, and what each stage removed. Reads no table once this was written."""
        sizes = self._counted(tuple(split_counters()))
        if sizes is None:
            sizes = self.split.agg(*[value.alias(name) for name, value in split_counters().items()])
        return with_shares(sizes).join(self.removed_counts(), "total_rows")

    def stratum_counts(self, split: str = "test") -> DataFrame:
        rows = self.split.where(F.col("split") == split)
        return rows.groupBy("stratify_key").agg(F.count("*").alias("rows"))

    def write(self, path: str, shuffled: bool = False, rows_per_file: int = ROWS_PER_FILE) -> Version:
        """The prepared table, the duplicate log and the summary, below ``path``."""
        with self.ledger.writing():
            rows = prepared_rows(self.split)
            version = write_prepared(rows, f"{path}/prepared", shuffled, rows_per_file, split_counters())
            self.counts.update(version.counts)
            write_json_lines(dedup.duplicate_log(self.duplicates()), f"{path}/dropped_duplicates")
            write_summary(self.summary(), f"{path}/summary")
        return version


def build_corpus(
    spark: SparkSession,
    recipe: Recipe,
    loader: Loader = read_source,
    tokenizer: Tokenizer | None = PatternTokenizer(),
    template: str = TRANSLATION_TEMPLATE,
    even_directions: bool = False,
    on_small_stratum: str = "error",
    dedup_key: str = "pair",
) -> Corpus:
    """Pool, deduplicate, mix to the target ratio, and hold out the test rows."""
    rows = F.count("*")
    ledger = StageLedger(spark)
    with ledger.writing():
        pooled = dedup.with_pair_hash(build_pool(spark, recipe, loader, tokenizer, template), dedup_key)
        pool, in_pool = materialize_counted(pooled, "pool", pool_rows=rows)
        unique, in_unique = materialize_counted(dedup.keep_first(pool), "unique", unique_rows=rows)
        even = balance_directions(unique) if even_directions else unique
        mixed = rebalance(even, recipe.translation_share, recipe.instruction_share)
        split = stratified_split(mixed, recipe.eval_size, on_small_stratum)
    return Corpus(pool, unique, mixed, split, ledger, {**in_pool, **in_unique})


def prepared_rows(split: DataFrame) -> DataFrame:
    """The columns of the prepared table."""
    return split.select(
        *fixed.FLAT_COLUMNS, "dataset_source", "stratify_key", "pair_hash", "split"
    )
