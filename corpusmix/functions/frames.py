"""Small helpers on whole DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES_PER_ROW = 10_000


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns that later filters cannot cause to be evaluated again.

    Catalyst pushes a filter on a projected column below the projection and
    inlines the expression there, so a costly one would run twice. A one-element
    ``inline`` is not crossed by filters, costs nothing, and keeps code generation.
    """
    kept = [name for name in df.columns if name not in columns]
    values = [value.alias(name) for name, value in columns.items()]
    return df.select(*[F.col(f"`{name}`") for name in kept], F.inline(F.array(F.struct(*values))))


def join_groups(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, with null as a value like any other."""
    keys = {name: f"_of_{name}" for name in names}
    renamed = right.select(*[F.col(name).alias(keys.get(name, name)) for name in right.columns])
    equal = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(key)) for name, key in keys.items()])
    return left.join(renamed, equal, how).drop(*keys.values())


def emit_copies(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says; the column is dropped.

    A count can be a large share of all rows, so it is first cut into blocks
    that are spread over the cluster, and each block is unrolled in its own task.
    """
    blocks = df.where(F.col(times) > 0).withColumn(
        "_block",
        F.explode(F.expr(f"sequence(0, cast(({times} - 1) div {COPIES_PER_ROW} as int))")),
    )
    sized = blocks.withColumn(
        "_size",
        F.least(F.lit(COPIES_PER_ROW), F.col(times) - F.col("_block") * COPIES_PER_ROW).cast("int"),
    )
    keys = [name for name in df.columns if name != times]
    spread = sized.repartition(*[F.col(name) for name in keys], F.col("_block"))
    return spread.withColumn("_copy", F.explode(F.expr("sequence(1, _size)"))).select(*keys)
