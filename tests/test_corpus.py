"""The whole build, on the given tables and on a recipe read from files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from catalog import bindings
from conftest import rows
from corpusmix import parse_recipe
from corpusmix.functions.tokens import PatternTokenizer
from corpusmix.plans import corpus, prepared
from corpusmix.sources.readers import read_prepared


@pytest.fixture(scope="module")
def built(spark, tables):
    return corpus.build_corpus(spark, bindings.RECIPE, bindings.load(tables))


def test_stages_account_for_every_row(built):
    dropped = built.duplicates().agg(F.sum("dropped")).first()[0]
    assert built.unique.count() + dropped == built.pool.count()
    line = built.summary().first()
    assert line["duplicates_removed"] == dropped
    assert line["training_split_rows"] + line["eval_split_rows"] == line["total_rows"]
    assert line["total_rows"] + line["removed_by_rebalancing"] == line["unique_rows"]
    assert built.split.count() == built.split.select("pair_hash").distinct().count()
    assert built.split.join(built.unique, "pair_hash", "left_anti").count() == 0


def test_the_mix_and_the_split_are_exact(built):
    tasks = {r["task"]: r["count"] for r in built.mixed.groupBy("task").count().collect()}
    assert abs(tasks["translation"] * 0.3 - tasks["instruction"] * 0.7) <= 1
    total = sum(tasks.values())
    assert built.split.where("split = 'test'").count() == round(total * 0.05)
    assert sum(r["rows"] for r in built.stratum_counts().collect()) == round(total * 0.05)


def test_every_row_is_within_the_budget(built):
    tokenizer = PatternTokenizer()
    longest = built.pool.agg(
        F.max(tokenizer.count(F.col("source_text"))), F.max(tokenizer.count(F.col("target_text")))
    ).first()
    assert longest[0] <= 1266 and longest[1] <= 2048
    blank = "source_text <> trim(source_text) or source_text = '' or target_text = ''"
    assert built.pool.where(blank).count() == 0


def test_partitioning_does_not_change_the_result(spark, tables, built):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    plain = bindings.load(tables)
    try:
        for partitions in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            again = corpus.build_corpus(
                spark, bindings.RECIPE, lambda s, e: plain(s, e).repartition(int(partitions))
            )
            assert rows(again.split, "pair_hash", "split", "dataset_source") == rows(
                built.split, "pair_hash", "split", "dataset_source"
            )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_write_and_use_the_prepared_table(spark, built, tmp_path):
    path = str(tmp_path / "out")
    built.write(path)
    table = f"{path}/prepared"
    whole = read_prepared(spark, table, "all")
    assert rows(whole, "pair_hash", "split") == rows(built.split, "pair_hash", "split")
    log = spark.read.json(f"{path}/dropped_duplicates")
    assert log.columns == ["hash", "source", "winner"]
    assert log.count() == built.pool.count() - built.unique.count()
    summary = [n for n in os.listdir(f"{path}/summary") if n.endswith(".json")]
    assert len(summary) == 1
    assert json.load(open(f"{path}/summary/{summary[0]}"))["total_rows"] == whole.count()

    train = whole.where("split = 'train'").count()
    assert prepared.training_rows(spark, table).count() == train
    assert prepared.training_rows(spark, table, fraction=0.5).count() == train // 2
    assert prepared.training_rows(spark, table, max_rows=7).count() == 7
    assert prepared.evaluation_rows(spark, table, "validation", 5).count() == 5
    statistics = {r["segment"]: r["samples"] for r in prepared.analyse_lengths(spark, table, "train", 0.25).collect()}
    assert statistics["all"] == train // 4
    blocks = prepared.plan_packing(spark, table).agg(F.count("*"), F.max("last_block")).first()
    assert blocks[0] == train and blocks[1] > 0


def test_recipe_from_files(spark, tmp_path):
    """Sources in several formats without declared ids, the same pair in two of them."""
    pairs = spark.createDataFrame([(f"hello {n}", f"helo {n}") for n in range(40)], "en string, cy string")
    pairs.write.json(str(tmp_path / "pairs" / "main"))
    pairs.unionByName(pairs).write.parquet(str(tmp_path / "more"))
    chat = spark.sql(
        "SELECT array(named_struct('role', 'user', 'content', concat('q', id)), "
        "named_struct('role', 'assistant', 'content', 'a')) AS messages FROM range(30)"
    )
    chat.write.parquet(str(tmp_path / "chat"))
    recipe = parse_recipe(
        {
            "translation_data": {
                "main": {"path": str(tmp_path / "pairs"), "config": "main", "format": "json"},
                "more": {"path": str(tmp_path / "more"), "usage": 0.5, "directions": ["en-cy", "cy-en"]},
            },
            "instruction_data": {"chat": {"path": str(tmp_path / "chat"), "language": "cy"}},
            "meta_strategy": {"target_ratio": "50:50", "eval_size": 6},
        }
    )
    result = corpus.build_corpus(spark, recipe)
    counts = {r["dataset_source"]: r["count"] for r in result.pool.groupBy("dataset_source").count().collect()}
    assert counts == {"main": 40, "more": 80, "chat": 30}
    assert result.split.where("split = 'test'").count() == 6
    assert result.mixed.where("task = 'translation'").count() == 30
    usage = {r["dataset_source"]: tuple(r)[-2:] for r in corpus.source_usage(spark, recipe).collect()}
    assert usage == {"main": (40, 40), "more": (80, 40), "chat": (30, 30)}


def test_a_source_that_is_a_third_copies(spark, tmp_path):
    hot = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("en"),
        F.when(F.col("id") % 3 == 0, "yr un").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("cy"),
    )
    hot.write.parquet(str(tmp_path / "hot"))
    info = {"path": str(tmp_path / "hot"), "usage": 0.8}
    recipe = parse_recipe({"translation_data": {"hot": info}, "meta_strategy": {"eval_size": 5}})
    result = corpus.build_corpus(spark, recipe)
    assert result.pool.count() == 240
    kept = result.pool.where("source_text = 'same'").count()
    dropped = {r["winner"]: r["dropped"] for r in result.duplicates().collect()}
    assert dropped.get("hot", 0) == max(kept - 1, 0)
    assert result.unique.count() == 240 - max(kept - 1, 0)


def test_no_active_source(spark):
    with pytest.raises(ValueError, match="no source"):
        corpus.build_pool(spark, parse_recipe({"translation_data": {"a": {"path": "x", "usage": 0}}}))


def test_even_directions(spark, tables):
    made = corpus.build_corpus(spark, bindings.RECIPE, bindings.load(tables), even_directions=True)
    counts = made.unique.where("task = 'translation'").groupBy("source_lang_code").count().collect()
    even = corpus.balance_directions(made.unique).where("task = 'translation'").groupBy("source_lang_code").count()
    assert {r["count"] for r in even.collect()} == {min(r["count"] for r in counts)}
