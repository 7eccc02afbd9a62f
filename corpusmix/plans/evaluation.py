"""Evaluation from the held-out rows to the summary document, in blocks that are done once.

Translating and scoring take long. Rows are done in blocks, each written as a whole below a work folder, and a
row is done when its key is there. A run that was stopped is started again with the same folder and goes on
with the rows that are not.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmix.operators.evaluation import join_scores, metric_input, score_coverage, score_summary
from corpusmix.plans.prepared import evaluation_rows
from corpusmix.session import folder_names, stage_path
from corpusmix.sources.readers import read_prepared, resolve_split
from corpusmix.sources.sinks import write_summary

BLOCK_ROWS = 100_000

Step = Callable[[DataFrame], DataFrame]


def read_blocks(spark: SparkSession, folder: str, like: DataFrame | None = None) -> DataFrame | None:
    """The rows of all blocks that are there; None if no block is."""
    blocks = [name for name in folder_names(spark, folder) if name.startswith("block=")]
    if not blocks:
        return None
    reader = spark.read if like is None else spark.read.schema(like.schema)
    return reader.parquet(folder).drop("block")


def finish_in_blocks(rows: DataFrame, folder: str, step: Step, key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``step`` of all ``rows``, of which it does those whose ``key`` is in no block yet; returns what is in the blocks.

    ``step`` keeps the key. Files appear when their task has written them whole, so what an
    interrupted block has left counts as well. Rows are dealt to blocks by a hash of the key.
    """
    spark = rows.sparkSession
    like = step(rows.limit(0))
    done = read_blocks(spark, folder, like)
    pending = rows if done is None else rows.join(done.select(key), key, "left_anti")
    blocks = -(-pending.count() // block_rows)
    if blocks:
        # Dealt out once, so that a block reads its own rows only.
        dealt = stage_path(spark, "blocks")
        block = F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))
        pending.withColumn("_block", block).repartition("_block").write.partitionBy("_block").parquet(dealt)
        for name in folder_names(spark, dealt):
            part = spark.read.schema(rows.schema).parquet(f"{dealt}/{name}")
            step(part).write.parquet(f"{folder}/block={uuid.uuid4().hex}")
    found = read_blocks(spark, folder, like)
    # Rows that an earlier run did and that are no longer wanted stay out.
    return like if found is None else found.join(rows.select(key), key, "left_semi")


def evaluate(
    spark: SparkSession,
    path: str,
    work: str,
    translate: Step,
    score: Step,
    split: str = "validation",
    max_rows: int | None = None,
    reference_free: bool = False,
    block_rows: int = BLOCK_ROWS,
    metric: str = "score",
) -> DataFrame:
    """The summary of a prepared table's held-out translations, also written to ``work/summary``.

    ``translate`` adds ``hypothesis`` to rows with ``row_id`` and the flat columns; ``score`` gives
    ``row_id, prediction`` for rows with ``row_id, source, hypothesis, reference``. A row without a score is an error.
    """
    name = resolve_split(read_prepared(spark, path, "all"), split)
    rows = evaluation_rows(spark, path, split, max_rows)
    predictions = finish_in_blocks(rows, f"{work}/predictions", translate, "row_id", block_rows)
    inputs = metric_input(predictions, reference_free, key="row_id")
    scores = finish_in_blocks(inputs, f"{work}/scores", score, "row_id", block_rows)
    coverage = score_coverage(predictions, scores).first()
    if coverage["without_score"] or coverage["without_prediction"]:
        raise ValueError(
            f"{coverage['without_score']} translations have no score, "
            f"{coverage['without_prediction']} scores no translation"
        )
    summary = score_summary(join_scores(predictions, scores), name, split, reference_free, metric)
    write_summary(summary, f"{work}/summary")
    return spark.read.schema(summary.schema).json(f"{work}/summary")
