"""Evaluation around the model calls: rows to translate, scores, and their summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.tokens import loaded_once
from corpusmix.operators.reports import direction
from corpusmix.operators.selection import exact_medians


def require_columns(df: DataFrame, names: tuple[str, ...] = fixed.FLAT_COLUMNS) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"the prepared table lacks the columns {', '.join(missing)}")


def checked_tasks(df: DataFrame) -> DataFrame:
    """The same rows; the query fails at the first row whose task is not known."""
    require_columns(df)
    known = F.col("task").isin(fixed.TASK_TRANSLATION, fixed.TASK_INSTRUCTION)
    message = F.concat(F.lit("unsupported task "), F.coalesce(F.col("task"), F.lit("null")))
    task = F.when(known, F.col("task")).otherwise(F.raise_error(message).cast("string"))
    return df.withColumn("task", task)


def translation_rows(df: DataFrame) -> DataFrame:
    """The translation rows of a split; it is an error if there are none."""
    require_columns(df, ("task",))
    rows = df.where(F.col("task") == fixed.TASK_TRANSLATION)
    if rows.isEmpty():
        raise ValueError("the split has no translation rows to evaluate")
    return rows


def apply_in_batches(
    df: DataFrame,
    loader: Callable[[], Any],
    apply: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Run a caller's model over all rows: loaded once per worker, fed Arrow batches."""
    key = cloudpickle.dumps(loader)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded_once(key, loader)
        for batch in batches:
            yield apply(model, batch)

    return df.mapInPandas(run, schema)


def metric_input(
    predictions: DataFrame, reference_free: bool = False, key: str | None = None
) -> DataFrame:
    """What the metric reads; without references their column is empty.

    With ``key``, each row carries it, so that ``join_scores`` can match its score.
    """
    keys = [] if key is None else [key]
    reference = F.lit("") if reference_free else F.col("target_text")
    return predictions.select(
        *keys, F.col("source_text").alias("source"), "hypothesis", reference.alias("reference")
    )


def join_scores(predictions: DataFrame, scores: DataFrame, key: str = "row_id") -> DataFrame:
    """Predictions with their score, matched by key and not by position."""
    return predictions.join(scores.select(key, "prediction"), key)


def score_coverage(predictions: DataFrame, scores: DataFrame, key: str = "row_id") -> DataFrame:
    """One line: rows matched, predictions without a score, scores without a prediction."""
    left = predictions.select(key, F.lit(True).alias("predicted"))
    right = scores.select(key, F.lit(True).alias("scored"))
    return left.join(right, key, "full_outer").agg(
        F.count_if(F.col("predicted") & F.col("scored")).alias("matched"),
        F.count_if(F.col("scored").isNull()).alias("without_score"),
        F.count_if(F.col("predicted").isNull()).alias("without_prediction"),
    )


def direction_scores(scored: DataFrame) -> DataFrame:
    """Samples, mean and median score per direction, in the order of the directions."""
    rows = scored.select(direction().alias("direction"), "prediction")
    means = rows.groupBy("direction").agg(
        F.count("prediction").alias("samples"), F.avg("prediction").alias("average_score")
    )
    medians = exact_medians(rows, "prediction", ["direction"])
    return (
        means.join(medians, "direction", "left")
        .select(
            "direction",
            "samples",
            "average_score",
            F.col("median").alias("median_score"),
            F.lit(True).alias("lower_is_better"),
        )
        .orderBy("direction")
    )


def overall_scores(
    scored: DataFrame, split: str, requested_split: str, reference_free: bool = False
) -> DataFrame:
    """One line over all scored rows; mean and median are null if there are none."""
    mode = "qe" if reference_free else "reference"
    means = scored.agg(
        F.count("prediction").alias("samples"), F.avg("prediction").alias("average_score")
    )
    median = exact_medians(scored, "prediction")
    both = means.unionByName(median, allowMissingColumns=True)
    return both.agg(
        F.max("samples").alias("samples"),
        F.max("average_score").alias("average_score"),
        F.max("median").alias("median_score"),
    ).select(
        F.lit(split).alias("split"),
        F.lit(requested_split).alias("requested_split"),
        F.lit(fixed.TASK_TRANSLATION).alias("evaluated_task"),
        "samples",
        F.lit(mode).alias("mode"),
        "average_score",
        "median_score",
        F.lit(True).alias("lower_is_better"),
    )


def score_summary(
    scored: DataFrame, split: str, requested_split: str, reference_free: bool = False, metric: str = "score"
) -> DataFrame:
    """The overall scores with those of each direction nested in them, as one document.

    ``metric`` is what averages and medians are called after, such as ``average_score``.
    """
    names = ("samples", "average_score", "median_score", "lower_is_better")
    own = [F.col(name).alias(name.replace("_score", f"_{metric}")) for name in names]
    entry = F.struct("direction", *own)
    directions = direction_scores(scored).agg(
        F.sort_array(F.collect_list(entry)).alias("direction_summaries")
    )
    overall = overall_scores(scored, split, requested_split, reference_free)
    both = overall.unionByName(directions, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name.replace("_score", f"_{metric}")) for name in both.columns])
