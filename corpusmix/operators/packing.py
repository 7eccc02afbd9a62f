"""Packing plan: which training rows share a block of tokens when all are laid end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.operators.selection import key_bucket

OFFSET_DIGITS = 4


def token_offsets(lengths: DataFrame, order_key: str, length: str) -> DataFrame:
    """Add ``start_token``: the total length of all rows with a smaller key.

    A running sum over the whole table in two steps: totals per bucket of the
    key are summed up first (a fixed number of lines), then each bucket sums up
    its own rows. The buckets are even because keys are hashes of unique rows.
    """
    bucketed = lengths.withColumn("_bucket", key_bucket(order_key, OFFSET_DIGITS))
    totals = bucketed.groupBy("_bucket").agg(F.sum(length).alias("_total"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    within = (
        Window.partitionBy("_bucket")
        .orderBy(order_key)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = bucketed.withColumn("_within", F.coalesce(F.sum(length).over(within), F.lit(0)))
    # At most 65,536 short lines; the join follows the partitioning of the window.
    joined = running.join(offsets, "_bucket")
    return joined.withColumn(
        "start_token", (F.col("_offset") + F.col("_within")).cast("bigint")
    ).drop("_bucket", "_offset", "_within")


def packing_plan(
    lengths: DataFrame,
    order_key: str = "order_key",
    length: str = "total_tokens",
    block_tokens: int = fixed.MAX_TOKENS,
) -> DataFrame:
    """Add ``first_block`` and ``last_block`` to each row; blocks are cut every ``block_tokens``.

    ``lengths`` is read twice, so it should be a written table of these narrow
    columns, or texts are tokenised twice. Rows without tokens take no place.
    """
    placed = token_offsets(lengths.where(F.col(length) > 0), order_key, length)
    return placed.select(
        "*",
        F.expr(f"start_token div {block_tokens}").alias("first_block"),
        F.expr(f"(start_token + {length} - 1) div {block_tokens}").alias("last_block"),
    )


def block_fill(
    plan: DataFrame, length: str = "total_tokens", block_tokens: int = fixed.MAX_TOKENS
) -> DataFrame:
    """``block, rows, tokens, fill`` for each block; a long row is in several blocks."""
    parts = plan.select(
        "start_token",
        (F.col("start_token") + F.col(length)).alias("end_token"),
        F.explode(F.sequence("first_block", "last_block")).alias("block"),
    )
    from_token = F.greatest(F.col("start_token"), F.col("block") * block_tokens)
    to_token = F.least(F.col("end_token"), (F.col("block") + 1) * block_tokens)
    filled = parts.groupBy("block").agg(
        F.count("*").alias("rows"), F.sum(to_token - from_token).alias("tokens")
    )
    return filled.withColumn("fill", F.round(F.col("tokens") / block_tokens, 4))
