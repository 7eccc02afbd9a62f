import json
import os
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import FLAT, rows
from corpusmix.operators import evaluation
from corpusmix.sources import readers, sinks

LINES = [
    ("translation", "a", "b", "en", "cy"),
    ("translation", "b", "a", "cy", "en"),
    ("instruction", "q", "r", "en", "en"),
]


def test_translation_rows(spark):
    df = spark.createDataFrame(LINES, FLAT)
    assert evaluation.translation_rows(df).count() == 2
    with pytest.raises(ValueError, match="no translation rows"):
        evaluation.translation_rows(df.where("task = 'instruction'"))
    with pytest.raises(ValueError, match="task"):
        evaluation.translation_rows(df.drop("task"))


def test_contract(spark):
    df = spark.createDataFrame(LINES, FLAT)
    assert evaluation.checked_tasks(df).count() == 3
    with pytest.raises(ValueError, match="source_text, target_text"):
        evaluation.checked_tasks(df.drop("source_text", "target_text"))
    wrong = spark.createDataFrame([("summary", "a", "b", "en", "cy")], FLAT)
    with pytest.raises(Exception, match="unsupported task summary"):
        evaluation.checked_tasks(wrong).collect()


def test_metric_input(spark):
    df = spark.createDataFrame([("s", "t", "h")], "source_text string, target_text string, hypothesis string")
    assert rows(evaluation.metric_input(df)) == [("s", "h", "t")]
    assert rows(evaluation.metric_input(df, reference_free=True)) == [("s", "h", "")]
    keyed = evaluation.metric_input(df.selectExpr("'k' AS row_id", "*"), key="row_id")
    scores = keyed.selectExpr("row_id", "1.5D AS prediction")
    assert evaluation.join_scores(keyed, scores).first()["prediction"] == 1.5


def scored(spark, scores):
    return spark.createDataFrame(scores, "source_lang_code string, target_lang_code string, prediction double")


def test_scores_are_joined_by_key(spark):
    predictions = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "row_id string, hypothesis string")
    scores = spark.createDataFrame([("3", 0.5), ("1", 1.5), ("9", 2.0)], "row_id string, prediction double")
    assert rows(evaluation.join_scores(predictions, scores)) == [("1", "x", 1.5), ("3", "z", 0.5)]
    assert tuple(evaluation.score_coverage(predictions, scores).first()) == (2, 1, 1)


def test_direction_and_overall_scores(spark):
    data = [("en", "cy", v) for v in (3.0, 1.0, 2.5, 9.0)] + [("cy", "en", v) for v in (4.0, 0.5, 7.0)]
    found = [tuple(r) for r in evaluation.direction_scores(scored(spark, data)).collect()]
    assert found == [("cy->en", 3, pytest.approx(11.5 / 3), 4.0, True), ("en->cy", 4, 3.875, 2.75, True)]
    values = [v for *_, v in data]
    line = evaluation.overall_scores(scored(spark, data), "test", "validation", reference_free=True).first()
    assert (line["samples"], line["mode"], line["split"]) == (7, "qe", "test")
    assert line["average_score"] == pytest.approx(statistics.mean(values))
    assert line["median_score"] == statistics.median(values)


def test_summary_document(spark, tmp_path):
    data = [("en", "cy", v) for v in (3.0, 1.0)] + [("cy", "en", 4.0)]
    path = str(tmp_path / "summary")
    sinks.write_summary(evaluation.score_summary(scored(spark, data), "test", "validation"), path)
    (name,) = [n for n in os.listdir(path) if n.endswith(".json")]
    (line,) = open(os.path.join(path, name), encoding="utf-8").read().splitlines()
    document = json.loads(line)
    assert (document["samples"], document["median_score"], document["mode"]) == (3, 3.0, "reference")
    assert [d["direction"] for d in document["direction_summaries"]] == ["cy->en", "en->cy"]
    assert document["direction_summaries"][1]["average_score"] == 2.0


def test_no_scores(spark):
    line = evaluation.overall_scores(scored(spark, []), "test", "test").first()
    assert (line["samples"], line["average_score"], line["median_score"]) == (0, None, None)
    assert evaluation.direction_scores(scored(spark, [])).count() == 0


class Model:
    loads = 0

    def __init__(self):
        Model.loads += 1


def translate(model, batch):
    return pd.DataFrame({"row_id": batch["row_id"], "hypothesis": batch["text"].str[::-1], "loads": Model.loads})


def test_batches_share_one_model_per_worker(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("row_id"), F.lit("abc").alias("text"))
    found = evaluation.apply_in_batches(
        df.repartition(16), Model, translate, "row_id string, hypothesis string, loads int"
    )
    assert rows(found.groupBy("hypothesis", "loads").count()) == [("cba", 1, 2000)]


def prepared(spark, path, splits):
    for split in splits:
        spark.createDataFrame(LINES, FLAT).write.parquet(f"{path}/split={split}")
    return spark.read.parquet(path)


def test_split_choice(spark, tmp_path):
    both = prepared(spark, str(tmp_path / "a"), ["train", "test"])
    assert readers.available_splits(both) == ["test", "train"]
    assert readers.resolve_split(both, "train") == "train"
    assert readers.resolve_split(both, "validation") == "test"
    assert readers.resolve_held_out_split(both) == "test"
    with pytest.raises(ValueError, match="dev"):
        readers.resolve_split(both, "dev")
    many = spark.range(300).selectExpr("concat('s', id) AS split")
    assert readers.resolve_split(many, "s299") == "s299"
    with pytest.raises(ValueError, match="neither"):
        readers.resolve_held_out_split(many)
    three = prepared(spark, str(tmp_path / "b"), ["train", "test", "validation"])
    assert readers.resolve_held_out_split(three) == "validation"
    train = prepared(spark, str(tmp_path / "c"), ["train"])
    with pytest.raises(ValueError, match="validation"):
        readers.resolve_split(train, "validation")
    with pytest.raises(ValueError, match="neither"):
        readers.resolve_held_out_split(train)


def test_split_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "a")
    prepared(spark, path, ["train", "test"])
    plan = readers.read_prepared(spark, path, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert readers.read_prepared(spark, path, "all").count() == 6


def test_json_lines_keep_text_as_it_is(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([("ŵy \"x\"\n", None), ("b", "日本")], "v string, w string")
    sinks.write_json_lines(df, path)
    assert rows(readers.read_json_lines(spark, path, df.schema)) == rows(df)
    text = "".join(
        open(os.path.join(path, name), encoding="utf-8").read() for name in os.listdir(path) if name.endswith(".json")
    )
    assert "ŵy" in text and "日本" in text
    assert [json.loads(line)["w"] for line in sorted(text.splitlines())] == ["日本", None]
