"""What is done with a prepared table: length analysis, training rows, evaluation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.text import keyed_hash
from corpusmix.functions.tokens import PatternTokenizer, Tokenizer
from corpusmix.operators.budget import measured_text, rendered_text, total_lengths
from corpusmix.operators.evaluation import require_columns, translation_rows
from corpusmix.operators.packing import packing_plan
from corpusmix.operators.prompts import TRANSLATION_TEMPLATE, render
from corpusmix.operators.reports import length_statistics
from corpusmix.operators.selection import first_rows, fraction_quota, take_exact
from corpusmix.operators.sketches import length_sketches
from corpusmix.session import materialize
from corpusmix.sources.readers import read_prepared, resolve_held_out_split, resolve_split

ROW_SEED = f"{fixed.SEED}/rows"


def in_row_order(df: DataFrame, seed: object = ROW_SEED) -> DataFrame:
    """Give prepared rows their order: a table has none, prefixes need one."""
    return df.withColumn("order_key", keyed_hash(seed, df["pair_hash"]))


def prefix(df: DataFrame, fraction: float) -> DataFrame:
    """The first whole part of the rows in row order; everything from 1 upwards."""
    ordered = in_row_order(df)
    return ordered if fraction >= 1 else take_exact(ordered, fraction_quota(fraction))


def analyse_lengths(
    spark: SparkSession,
    path: str,
    split: str = "train",
    fraction: float = 1.0,
    tokenizer: Tokenizer = PatternTokenizer(),
    rendered: bool = False,
) -> DataFrame:
    """Length statistics of a split or of its first part: of both texts, or ``rendered`` as training reads them."""
    rows = read_prepared(spark, path, split)
    if fraction < 1:
        rows = prefix(rows, fraction)
    return length_statistics(total_lengths(rows, tokenizer, rendered_text() if rendered else None))


def write_length_sketches(
    spark: SparkSession, path: str, folder: str, tokenizer: Tokenizer = PatternTokenizer()
) -> None:
    """Sketches of the lengths of a prepared table, per split, source and task, in ``folder``."""
    rows = read_prepared(spark, path, "all")
    total = tokenizer.count(measured_text()).alias("total_tokens")
    lengths = rows.select("split", "dataset_source", "task", total)
    length_sketches(lengths, ["split", "dataset_source", "task"]).write.mode("overwrite").parquet(folder)


def row_lengths(df: DataFrame, tokenizer: Tokenizer = PatternTokenizer()) -> DataFrame:
    """``pair_hash, order_key, total_tokens`` as a written table, for several passes."""
    ordered = in_row_order(df)
    total = tokenizer.count(measured_text()).alias("total_tokens")
    return materialize(ordered.select("pair_hash", "order_key", total), "row_lengths")


def plan_packing(
    spark: SparkSession,
    path: str,
    block_tokens: int = fixed.MAX_TOKENS,
    tokenizer: Tokenizer = PatternTokenizer(),
) -> DataFrame:
    """The token blocks of the training rows, laid end to end in row order."""
    lengths = row_lengths(read_prepared(spark, path, "train"), tokenizer)
    return packing_plan(lengths, block_tokens=block_tokens)


def training_rows(
    spark: SparkSession,
    path: str,
    fraction: float = 1.0,
    max_rows: int | None = None,
    template: str = TRANSLATION_TEMPLATE,
    bos: str = fixed.BOS,
) -> DataFrame:
    """``prompt`` and ``completion`` of the training split, after checking the table."""
    train = read_prepared(spark, path, "train")
    require_columns(train)
    resolve_held_out_split(read_prepared(spark, path, "all"))
    return render(prefix(train, fraction), template, bos, max_rows)


def evaluation_rows(
    spark: SparkSession, path: str, split: str = "validation", max_rows: int | None = None
) -> DataFrame:
    """The translation rows of the held-out split, with ``row_id`` as their key."""
    name = resolve_split(read_prepared(spark, path, "all"), split)
    rows = in_row_order(translation_rows(read_prepared(spark, path, name)))
    if max_rows is not None:
        rows = first_rows(rows, max_rows)
    return rows.withColumnRenamed("pair_hash", "row_id")
