"""Headline queries and throughputs, as one line of JSON.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores. The
``baseline_*`` entries use as many rows as the published readings they are
compared with; those rows are the pool of the same tables, copied often enough.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalog import bindings  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from corpusmix.operators import dedup  # noqa: E402
from corpusmix.operators.bitext import drop_blank  # noqa: E402
from corpusmix.operators.budget import enforce_budget, total_lengths  # noqa: E402
from corpusmix.operators.rebalance import rebalance  # noqa: E402
from corpusmix.operators.reports import length_statistics  # noqa: E402
from corpusmix.operators.split import stratified_split  # noqa: E402
from corpusmix.plans import corpus  # noqa: E402
from corpusmix.session import build_session, materialize, stage_path  # noqa: E402
from corpusmix.sources.sinks import write_prepared  # noqa: E402

HEADLINE = (
    "q05_direction_expansion",
    "q06_usage_slice_union",
    "q08_dictionary_instructions",
    "q10_token_lengths_and_buckets",
    "q10b_batch_tokenizer_lengths",
    "q11_budget_truncation",
    "q12_dedup_keep_first",
    "q12b_dedup_losers",
    "q13_instruction_from_turns",
    "q13b_instruction_from_messages",
    "q16_rebalance_sample",
    "q17b_stratified_split_rows",
    "q18_source_report",
    "q21_length_statistics",
    "q23_prompt_completion",
    "q27_direction_scores",
    "q29_packing_plan",
)

PUBLISHED = {"baseline_blank_filter": 210_931.5, "baseline_save": 127_766.62}
POOL_ROWS = 1_532_911


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def large_pool(spark: SparkSession, tables: str) -> DataFrame:
    """The pool before the budget, copied with distinct texts to the published size."""
    pool = materialize(
        corpus.build_pool(spark, bindings.RECIPE, bindings.load(tables), tokenizer=None), "bench_pool"
    )
    copies = -(-POOL_ROWS // pool.count())
    many = pool.repartition(64).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    numbered = many.select(
        *[name for name in pool.columns if name not in ("source_text", "order_key")],
        F.concat("source_text", F.lit(" "), F.col("_copy")).alias("source_text"),
        F.concat("order_key", F.lit("-"), F.col("_copy")).alias("order_key"),
    )
    return materialize(numbered, "bench_large_pool")


def throughput(spark: SparkSession, tables: str) -> tuple[dict[str, float], dict[str, dict]]:
    recipe = bindings.RECIPE
    pool = large_pool(spark, tables)
    rows = pool.count()
    seconds: dict[str, float] = {}
    counts = dict.fromkeys(
        ("baseline_blank_filter", "large_budget", "large_dedup", "large_length_statistics"), rows
    )
    seconds["baseline_blank_filter"] = timed(lambda: run(drop_blank(pool)))
    fitted = enforce_budget(pool.drop("over_limit"))
    seconds["large_budget"] = timed(lambda: run(fitted))
    seconds["large_length_statistics"] = timed(lambda: run(length_statistics(total_lengths(pool))))
    hashed = materialize(dedup.with_pair_hash(pool), "bench_hashed")  # as a build writes it
    made: list[DataFrame] = []
    seconds["large_dedup"] = timed(
        lambda: made.append(materialize(dedup.keep_first(hashed), "bench_unique"))
    )
    unique = made[0]
    counts["large_mix_and_split"] = unique.count()

    def mix_and_split() -> None:
        mixed = rebalance(unique, recipe.translation_share, recipe.instruction_share)
        made.append(corpus.prepared_rows(stratified_split(mixed, 1000)))
        run(made[1])

    seconds["large_mix_and_split"] = timed(mix_and_split)
    everything = corpus.prepared_rows(stratified_split(unique, 1000))
    counts["baseline_save"] = counts["large_mix_and_split"]
    seconds["baseline_save"] = timed(
        lambda: write_prepared(everything, stage_path(spark, "bench_prepared"))
    )
    rates = {
        name: {"rows": counts[name], "rows_per_sec": round(counts[name] / max(seconds[name], 1e-3), 1)}
        for name in seconds
    }
    for name, published in PUBLISHED.items():
        rates[name]["published_rows_per_sec"] = published
    return seconds, rates


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["q08_dictionary_instructions"](spark, tables))
    seconds = {name: timed(lambda: run(QUERIES[name](spark, tables))) for name in HEADLINE}
    large, rates = throughput(spark, tables)
    seconds.update(large)
    size = re.search(r"sf([\d.]+)$", tables)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(size.group(1)) if size else tables,
                "throughput": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
