"""Connected components of a graph of ids, with its edges in tables throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.session import materialize


def _linked(edges: DataFrame) -> DataFrame:
    """Edges as (high, low), each once, without loops."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (``a, b``) that is not itself the least of its component.

    Alternates two steps, each a minimum per node (combined before the shuffle) and a join:
    all larger neighbours of a node are hung on its least neighbour, then all smaller ones. A node
    with very many neighbours is one key of a join, which adaptive execution splits. The
    number of rounds grows with the logarithm of the longest path. Every round is written.
    """
    current = materialize(_linked(edges), "links")
    before = None
    while True:
        both = current.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            current.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        hung = both.where(F.col("v") > F.col("u")).join(least, "u")
        large = _linked(hung.select(F.col("v").alias("a"), F.least("u", "m").alias("b")))
        large = materialize(large, "links_large")
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        joined = large.join(lowest, "high")
        small = joined.select(F.col("low").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select(F.col("high").alias("a"), F.col("m").alias("b"))
        )
        current = materialize(_linked(small), "links_small")
        after = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("h")
        ).first()
        if after == before:
            return current.select(F.col("high").alias("node"), F.col("low").alias("root"))
        before = after
