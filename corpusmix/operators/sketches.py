"""Quantile sketches of token lengths: small states that are stored and merged instead of reading rows again.

States are KLL sketches. A quantile read from one is off by a share of the rows that follows from the size
of the state, not from the number of rows: see ``rank_error``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed

SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """By what share of the rows the rank of a value may be off, with 99 % confidence."""
    return 2.296 / size**0.9021


def length_sketches(lengths: DataFrame, groups: Sequence[str], size: int = SIZE) -> DataFrame:
    """Per group the state, rows, sum and maximum of ``total_tokens``. States meet before the shuffle."""
    value = F.col("total_tokens").cast("bigint")
    return lengths.groupBy(*groups).agg(
        F.kll_sketch_agg_bigint(value, F.lit(size)).alias("sketch"),
        F.count("total_tokens").alias("samples"),
        F.sum(value).alias("tokens"),
        F.max(value).alias("max_tokens"),
    )


def merge_sketches(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """States of larger groups from those of smaller ones; without groups, of all of them."""
    return sketches.groupBy(*groups).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
        F.sum("samples").alias("samples"),
        F.sum("tokens").alias("tokens"),
        F.max("max_tokens").alias("max_tokens"),
    )


def sketched_statistics(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per group the count, mean, maximum and approximate percentiles of the lengths."""
    merged = merge_sketches(sketches, groups)
    names = ("median_tokens", "p95_tokens", "p99_tokens", "p99_9_tokens")
    points = [
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(point))).alias(name)
        for name, point in zip(names, fixed.PERCENTILES)
    ]
    return merged.select(
        *groups, "samples", (F.col("tokens") / F.col("samples")).alias("mean_tokens"), "max_tokens", *points
    )
