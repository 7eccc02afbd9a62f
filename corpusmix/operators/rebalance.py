"""Task mix: how many rows of each task fit the target ratio, and which ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.text import keyed_hash
from corpusmix.operators.selection import Quota, take_exact

STAGE_SEED = f"{fixed.SEED}/mix"
DIRECTION_SEED = f"{fixed.SEED}/direction"


def ratio_quota(translation_share: float, instruction_share: float) -> Quota:
    """Keep all of the task that is short, and of the other as many as the ratio gives.

    Works on the row counts per task: a table of two lines. If one of the tasks
    has no rows at all, nothing is removed.
    """
    if translation_share <= 0 or instruction_share <= 0:
        raise ValueError("both shares of the task mix must be above zero")

    def quota(counts: DataFrame) -> DataFrame:
        def rows_of(task: str):
            return F.coalesce(
                F.sum(F.when(F.col("task") == task, F.col("available"))), F.lit(0)
            ).cast("double")

        t_share, i_share = F.lit(translation_share), F.lit(instruction_share)
        t, i = F.col("t"), F.col("i")
        short_t = t / t_share <= i / i_share
        keep_t = F.when(short_t, t).otherwise(F.least(t, F.rint(i * t_share / i_share)))
        keep_i = F.when(short_t, F.least(i, F.rint(t * i_share / t_share))).otherwise(i)
        both = (t > 0) & (i > 0)
        sizes = counts.agg(
            rows_of(fixed.TASK_TRANSLATION).alias("t"), rows_of(fixed.TASK_INSTRUCTION).alias("i")
        )

        def line(task: str, available, kept):
            return F.struct(
                F.lit(task).alias("task"),
                available.cast("bigint").alias("available"),
                F.when(both, kept).otherwise(available).cast("bigint").alias("k"),
            )

        return sizes.select(
            F.inline(
                F.array(
                    line(fixed.TASK_TRANSLATION, t, keep_t),
                    line(fixed.TASK_INSTRUCTION, i, keep_i),
                )
            )
        ).where(F.col("available") > 0)

    return quota


def task_counts(pool: DataFrame) -> DataFrame:
    return pool.groupBy("task").agg(F.count("*").alias("available"))


def rebalance(
    unique: DataFrame, translation_share: float, instruction_share: float, seed: object = STAGE_SEED
) -> DataFrame:
    """A seeded sample of each task without replacement, in the target ratio.

    ``unique`` holds each ``pair_hash`` once. A row of neither task belongs to no part of the ratio and is left out.
    """
    drawn = unique.withColumn("_draw", keyed_hash(seed, F.col("pair_hash")))
    quota = ratio_quota(translation_share, instruction_share)
    return take_exact(drawn, quota, "_draw", ["task"]).drop("_draw")


def smallest_quota(counts: DataFrame) -> DataFrame:
    """As many rows of every group as the smallest group has; one line per group."""
    return counts.withColumn("k", F.min("available").over(Window.partitionBy()))


def balance_directions(unique: DataFrame, seed: object = DIRECTION_SEED) -> DataFrame:
    """Equally many rows of each translation direction; other rows, also those without a task, all stay.

    A missing language code is a code of its own.
    """
    is_translation = F.col("task") == fixed.TASK_TRANSLATION
    directions = ["source_lang_code", "target_lang_code"]
    drawn = unique.where(is_translation).withColumn("_draw", keyed_hash(seed, F.col("pair_hash")))
    balanced = take_exact(drawn, smallest_quota, "_draw", directions).drop("_draw")
    return balanced.unionByName(unique.where(~F.coalesce(is_translation, F.lit(False))))


def shuffled(df: DataFrame, seed: object, key: str = "pair_hash") -> DataFrame:
    """The rows in seeded random order, for writing: a distributed sort.

    Only wanted where the files themselves must be in that order; a deduplicated
    pool already lies in the order of its hashes, which is as good as random.
    """
    drawn = df.withColumn("_draw", keyed_hash(seed, F.col(key)))
    return drawn.repartitionByRange("_draw").sortWithinPartitions("_draw").drop("_draw")
