"""Counts and length statistics of a pool or a prepared table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed

TOTAL = "TOTAL"


def _rows_of(task: str) -> Column:
    return F.count_if(F.col("task") == task)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)


def source_report(pool: DataFrame) -> DataFrame:
    """Rows per section and source, with a total line per section and one over all.

    The rollup runs on counts per source and task, not on the rows themselves.
    """
    counted = pool.groupBy("section", "dataset_source", "task").agg(F.count("*").alias("n"))

    def rows_of(task: str) -> Column:
        return F.sum(F.when(F.col("task") == task, F.col("n")).otherwise(0)).cast("bigint")

    report = counted.rollup("section", "dataset_source").agg(
        F.grouping("section").alias("all_sections"),
        F.grouping("dataset_source").alias("all_sources"),
        F.sum("n").alias("rows"),
        rows_of(fixed.TASK_TRANSLATION).alias("translation_rows"),
        rows_of(fixed.TASK_INSTRUCTION).alias("instruction_rows"),
    )

    def label(name: str, is_total: str) -> Column:
        return F.when(F.col(is_total) == 1, F.lit(TOTAL)).otherwise(F.col(name)).alias(name)

    return report.select(
        label("section", "all_sections"),
        label("dataset_source", "all_sources"),
        "rows",
        "translation_rows",
        "instruction_rows",
    )


def recipe_report(usage: DataFrame, pool: DataFrame) -> DataFrame:
    """Per source: rows it has, rows taken of it, and rows these became in the pool."""
    became = pool.groupBy("source_ord").agg(F.count("*").alias("rows_used"))
    return usage.join(became, "source_ord", "left").select(
        "section",
        "dataset_source",
        F.coalesce("rows_used", F.lit(0).cast("bigint")).alias("rows_used"),
        "rows_available",
        "source_rows_used",
    )


def task_counters() -> dict[str, Column]:
    return {
        "translation_rows": _rows_of(fixed.TASK_TRANSLATION),
        "instruction_rows": _rows_of(fixed.TASK_INSTRUCTION),
        "total_rows": F.count("*"),
    }


def with_shares(totals: DataFrame) -> DataFrame:
    """Add the shares of both tasks in percent to a line of counts."""
    return totals.select(
        "*",
        percent(F.col("translation_rows"), F.col("total_rows")).alias("translation_percent"),
        percent(F.col("instruction_rows"), F.col("total_rows")).alias("instruction_percent"),
    )


def task_totals(df: DataFrame) -> DataFrame:
    """One line: rows per task, all rows, and the shares of the tasks in percent."""
    return with_shares(df.agg(*[value.alias(name) for name, value in task_counters().items()]))


def direction() -> Column:
    return F.concat(F.col("source_lang_code"), F.lit("->"), F.col("target_lang_code"))


def direction_counts(df: DataFrame) -> DataFrame:
    """Translation rows per direction."""
    rows = df.where(F.col("task") == fixed.TASK_TRANSLATION)
    return rows.groupBy(direction().alias("direction")).agg(F.count("*").alias("rows"))


def length_statistics(lengths: DataFrame) -> DataFrame:
    """Count, mean, maximum and interpolated percentiles of ``total_tokens``.

    One line for all rows and one for each task; a task without rows has a count
    of zero. Rows are first counted per task and length, so the exact percentiles
    are computed on as many lines as there are different lengths.
    """
    is_translation = F.col("task") == fixed.TASK_TRANSLATION
    segment = F.when(is_translation, fixed.TASK_TRANSLATION).otherwise(fixed.TASK_INSTRUCTION)
    histogram = lengths.groupBy(segment.alias("task"), "total_tokens").agg(
        F.count("*").alias("n")
    )
    statistics = histogram.rollup("task").agg(
        F.sum("n").alias("samples"),
        (F.sum(F.col("total_tokens") * F.col("n")) / F.sum("n")).alias("mean_tokens"),
        F.max("total_tokens").cast("bigint").alias("max_tokens"),
        F.percentile(
            F.col("total_tokens"),
            F.array(*[F.lit(point) for point in fixed.PERCENTILES]),
            F.col("n"),
        ).alias("points"),
    )
    labels = (F.lit("all"), F.lit(fixed.TASK_TRANSLATION), F.lit(fixed.TASK_INSTRUCTION))
    names = ("median_tokens", "p95_tokens", "p99_tokens", "p99_9_tokens")
    found = statistics.select(
        F.coalesce("task", F.lit("all")).alias("segment"),
        "samples",
        "mean_tokens",
        "max_tokens",
        *[F.col("points")[at].alias(name) for at, name in enumerate(names)],
    )
    segments = lengths.sparkSession.range(1).select(F.explode(F.array(*labels)).alias("segment"))
    joined = segments.join(found, "segment", "left")
    return joined.withColumn("samples", F.coalesce("samples", F.lit(0).cast("bigint")))
