"""Held-out split: an exact number of rows, in proportion to each task and language pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.frames import join_groups
from corpusmix.functions.text import keyed_hash
from corpusmix.operators.selection import Quota, mark_first
from corpusmix.session import pin_small
from corpusmix.sources.recipe import eval_rows

STAGE_SEED = f"{fixed.SEED}/split"


def stratify_key() -> Column:
    return F.concat(
        F.col("task"),
        F.lit(":"),
        F.col("source_lang_code"),
        F.lit("->"),
        F.col("target_lang_code"),
    )


def with_stratify_key(df: DataFrame) -> DataFrame:
    return df.withColumn("stratify_key", stratify_key())


def stratum_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("stratify_key").agg(F.count("*").alias("available"))


def with_stratum_code(df: DataFrame) -> DataFrame:
    """Add the number of the stratum among the sorted strata, from 0."""
    codes = df.select("stratify_key").distinct()
    numbered = codes.withColumn(
        "stratum_code", F.dense_rank().over(Window.orderBy("stratify_key")) - 1
    )
    return df.join(pin_small(numbered), "stratify_key")


def proportional_quota(test_rows: int) -> Quota:
    """Largest remainders in whole numbers: the parts add up to ``test_rows`` exactly.

    Every stratum gets its share rounded down; the rows left over go to the
    largest remainders, ties in the order of the keys. One line per stratum.
    """

    def quota(counts: DataFrame) -> DataFrame:
        everything = Window.partitionBy()
        total = F.sum("available").over(everything)
        scaled = F.col("available").cast("decimal(38,0)") * F.lit(test_rows)
        floors = counts.select(
            "stratify_key",
            "available",
            F.floor(scaled / total).cast("bigint").alias("_floor"),
            (scaled % total).cast("decimal(38,0)").alias("_rest"),
        )
        by_rest = Window.orderBy(F.col("_rest").desc(), F.col("stratify_key"))
        left_over = F.lit(test_rows) - F.sum("_floor").over(everything)
        extra = F.when(F.row_number().over(by_rest) <= left_over, 1).otherwise(0)
        return floors.select(
            "stratify_key", "available", (F.col("_floor") + extra).cast("bigint").alias("k")
        )

    return quota


def _place(key: str | None) -> tuple[bool, str]:
    """The order of the keys, with that of rows that lack a part of it first, as Spark sorts."""
    return key is not None, key or ""


def capped_parts(sizes: dict[str | None, int], test_rows: int) -> dict[str | None, int]:
    """Proportional parts that leave a training row in every stratum.

    A part above its cap is set to it, and what is left is dealt out among the others
    again, until no part is above. Parts are largest remainders, ties in the order of the keys.
    """
    caps = {key: rows - 1 for key, rows in sizes.items() if rows > 1}
    if test_rows > sum(caps.values()):
        raise ValueError(f"{test_rows} test rows would leave a stratum without training rows")
    fixed_parts: dict[str | None, int] = {}
    while True:
        free = sorted((key for key in caps if key not in fixed_parts), key=_place)
        left = test_rows - sum(fixed_parts.values())
        total = sum(sizes[key] for key in free)
        parts = {key: sizes[key] * left // total for key in free}
        by_rest = sorted(free, key=lambda key: (-(sizes[key] * left % total), _place(key)))
        for key in by_rest[: left - sum(parts.values())]:
            parts[key] += 1
        above = {key: caps[key] for key in free if parts[key] > caps[key]}
        if not above:
            return fixed_parts | parts
        fixed_parts |= above


def given_quota(parts: dict[str | None, int]) -> Quota:
    """The stated part of each stratum; others get none."""

    def quota(counts: DataFrame) -> DataFrame:
        lines = counts.sparkSession.createDataFrame(
            list(parts.items()), "stratify_key string, k bigint"
        )
        return join_groups(counts, lines, ["stratify_key"])

    return quota


def stratified_split(
    df: DataFrame,
    eval_size: int | float,
    on_small_stratum: str = "error",
    seed: object = STAGE_SEED,
) -> DataFrame:
    """Add ``stratify_key`` and ``split`` (``train`` or ``test``) to rows with unique hashes.

    A stratum of a single row cannot be on both sides: it is an error, or stays
    in training with ``on_small_stratum="train_only"``; then every stratum keeps a training
    row, others make up for what a small one cannot give, and a size that cannot be
    reached is an error. Counting strata is one
    pass over two narrow columns; after it no row is moved at all.
    """
    if on_small_stratum not in ("error", "train_only"):
        raise ValueError(f"on_small_stratum is {on_small_stratum!r}, not 'error' or 'train_only'")
    keyed = with_stratify_key(df)
    counts = pin_small(stratum_counts(keyed))
    totals = counts.agg(
        F.sum("available").alias("rows"),
        F.count("*").alias("strata"),
        F.count_if(F.col("available") < 2).alias("single"),
    ).first()
    test_rows = eval_rows(eval_size, totals["rows"] or 0)
    if on_small_stratum == "error":
        if totals["single"]:
            raise ValueError(f"{totals['single']} strata have a single row and cannot be split")
        if test_rows < totals["strata"] or totals["rows"] - test_rows < totals["strata"]:
            raise ValueError(f"{test_rows} test rows cannot cover {totals['strata']} strata")

    if on_small_stratum == "error":
        quota = proportional_quota(test_rows)
    else:
        # One line per pair of task and languages.
        sizes = {row["stratify_key"]: row["available"] for row in counts.toLocalIterator()}
        quota = given_quota(capped_parts(sizes, test_rows))

    drawn = keyed.withColumn("_draw", keyed_hash(seed, F.col("pair_hash")))
    marked = mark_first(drawn, quota, "_test", "_draw", ["stratify_key"])
    split = F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))
    return marked.withColumn("split", split).drop("_test", "_draw")
