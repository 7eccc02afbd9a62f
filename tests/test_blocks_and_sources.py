"""Csv records over blocks, evaluation that goes on where it stopped, sketches, and the whole-row budget."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import FLAT, rows
from corpusmix.operators import budget, evaluation, sketches
from corpusmix.plans import evaluation as plan
from corpusmix.sources import csv_records, readers, sinks
from corpusmix.sources.recipe import SourceEntry, parse_recipe

TEXTS = [
    "", "plain", "a,b", 'say "x"', "two\nlines", "\n\n", '"', '""\n"', "é日本\nü", "x" * 300, "line\r\nwin", "end\n", " sp ",
    None, "it's", '"\n",\n"', "\n" * 40,
]


@pytest.fixture
def block_size(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "0")

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", ["37", "100", "1000", "10m"])
def test_csv_records_equal_a_reader_of_whole_files(spark, tmp_path, block_size, size):
    rng = random.Random(1)
    made = [(n, rng.choice(TEXTS), rng.choice(TEXTS), rng.choice(["a", None])) for n in range(150)]
    df = spark.createDataFrame(made, "id bigint, `na me.x` string, b string, c string")
    path = str(tmp_path / "in")
    df.repartition(3).write.option("header", True).option("escape", '"').csv(path)
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(df.schema).csv(path)
    block_size(size)
    got = csv_records.read_csv(spark, path, df.schema)
    assert got.schema == df.schema and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert got.count() == 150


def test_csv_with_other_line_ends_and_bad_records(spark, tmp_path, block_size):
    path = str(tmp_path / "in.csv")
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write('id,t\r\n1,"a\r\nb"\r\n\r\nx,"q"\r\n3\r\n4,"u",7\r\n5,last')
    block_size("5")
    schema = T.StructType.fromDDL("id bigint, t string")
    got = csv_records.read_csv(spark, path, schema, corrupt="bad")
    expected = [(1, "a\r\nb", None), (None, "q", 'x,"q"'), (3, None, "3"), (4, "u", '4,"u",7'), (5, "last", None)]
    assert rows(got) == sorted(expected, key=repr)
    names = csv_records.read_csv(spark, path)
    assert names.columns == ["id", "t"] and names.count() == 5
    info = {"path": path, "format": "csv", "schema": "id bigint, t string", "corrupt_column": "bad"}
    entry = parse_recipe({"translation_data": {"x": info}}).entries[0]
    assert rows(readers.read_source(spark, entry)) == rows(got)


def test_an_empty_csv_and_too_many_blocks(spark, tmp_path, monkeypatch, block_size):
    path = str(tmp_path / "in.csv")
    with open(path, "w", encoding="utf-8") as out:
        out.write("id,t\n")
    assert csv_records.read_csv(spark, path).collect() == []
    monkeypatch.setattr(csv_records, "MOST_BLOCKS", 1)
    with open(path, "a", encoding="utf-8") as out:
        out.write("1,x\n" * 50)
    block_size("20")
    with pytest.raises(ValueError, match="maxPartitionBytes"):
        csv_records.read_csv(spark, path)


def test_json_with_a_column_for_what_does_not_fit(spark, tmp_path):
    path = str(tmp_path / "in.json")
    with open(path, "w", encoding="utf-8") as out:
        out.write('{"id": 1, "t": "a"}\n{"id": oops\n')
    entry = SourceEntry("translation", "x", path, 0, format="json", schema="id bigint, t string", corrupt_column="bad")
    assert rows(readers.read_source(spark, entry)) == [(1, "a", None), (None, None, '{"id": oops')]


# --- evaluation ---------------------------------------------------------------------------------


def published_table(spark, path, count):
    made = [("translation" if n % 5 else "instruction", f"source {n}", f"target {n}", "en", "cy" if n % 2 else "de", f"h{n}") for n in range(count)]
    df = spark.createDataFrame(made, f"{FLAT}, pair_hash string").withColumn("split", F.lit("test"))
    train = df.limit(3).withColumn("split", F.lit("train"))
    sinks.write_prepared(df.unionByName(train), path)


def translate(rows):
    return rows.withColumn("hypothesis", F.upper("target_text"))


def score(rows):
    return rows.select("row_id", (F.length("source") * 1.0).alias("prediction"))


def test_a_stopped_evaluation_goes_on_where_it_stopped(spark, tmp_path):
    path, work = str(tmp_path / "table"), str(tmp_path / "work")
    published_table(spark, path, 200)
    seen = []

    def stopping(rows):
        if rows.isEmpty():  # the look at the columns
            return score(rows)
        if len(seen) == 2:
            raise KeyboardInterrupt
        seen.append(rows.count())
        return score(rows)

    with pytest.raises(KeyboardInterrupt):
        plan.evaluate(spark, path, work, translate, stopping, block_rows=40)
    done = plan.read_blocks(spark, f"{work}/scores")
    assert done.count() == sum(seen) < 160 and plan.read_blocks(spark, f"{work}/predictions").count() == 160
    later = []

    def counting(rows):
        if not rows.isEmpty():
            later.append(rows.count())
        return score(rows)

    def nothing_left(rows):
        assert rows.isEmpty()
        return translate(rows)

    summary = plan.evaluate(spark, path, work, nothing_left, counting, block_rows=30).first()
    assert sum(later) == 160 - sum(seen) and max(later) < 80
    whole = plan.evaluate(spark, path, str(tmp_path / "other"), translate, score).first()
    assert summary == whole and summary["samples"] == 160
    assert [d["direction"] for d in summary["direction_summaries"]] == ["en->cy", "en->de"]
    assert plan.evaluate(spark, path, work, nothing_left, nothing_scored).first() == whole


def nothing_scored(rows):
    assert rows.isEmpty()
    return score(rows)


def test_rows_without_a_score_are_an_error_and_the_metric_has_a_name(spark, tmp_path):
    path = str(tmp_path / "table")
    published_table(spark, path, 20)
    with pytest.raises(ValueError, match="16 translations have no score"):
        plan.evaluate(spark, path, str(tmp_path / "a"), translate, lambda rows: score(rows).where("false"))
    named = plan.evaluate(spark, path, str(tmp_path / "b"), translate, score, max_rows=7, metric="quality")
    assert {"average_quality", "median_quality"} <= set(named.columns) and named.first()["samples"] == 7
    assert "average_quality" in named.schema["direction_summaries"].dataType.elementType.names


def test_metric_names_of_a_summary(spark):
    scored = spark.createDataFrame([("en", "cy", 1.0)], "source_lang_code string, target_lang_code string, prediction double")
    assert "average_score" in evaluation.score_summary(scored, "test", "test").columns


# --- sketches and budgets --------------------------------------------------------------------------


def test_merged_sketches_keep_their_error(spark):
    rng = random.Random(9)
    values = [(f"s{n % 7}", int(rng.lognormvariate(5, 1))) for n in range(40_000)]
    lengths = spark.createDataFrame(values, "source string, total_tokens int").repartition(16)
    stored = sketches.length_sketches(lengths, ["source"])
    merged = sketches.sketched_statistics(stored, []).first()
    exact = sorted(v for _, v in values)
    assert merged["samples"] == 40_000 and merged["max_tokens"] == exact[-1]
    assert merged["mean_tokens"] == pytest.approx(sum(exact) / 40_000)
    for name, point in zip(("median_tokens", "p95_tokens", "p99_tokens", "p99_9_tokens"), (0.5, 0.95, 0.99, 0.999)):
        below, upto = sum(v < merged[name] for v in exact) / 40_000, sum(v <= merged[name] for v in exact) / 40_000
        assert below - sketches.rank_error() <= point <= upto + sketches.rank_error()
    assert sketches.rank_error() < 0.006
    assert sketches.sketched_statistics(stored, ["source"]).count() == 7


def test_the_whole_row_budget_cuts_what_the_sides_alone_allow(spark):
    made = [("translation", "one two three", " ".join(["word"] * n), "en", "cy") for n in (5, 20, 60, 200)]
    df = spark.createDataFrame(made, FLAT)
    sides = budget.enforce_budget(df, max_tokens=100)
    total = budget.enforce_budget(df, max_tokens=100, budget="total")
    assert [r["over_limit"] for r in sides.collect()] == [False, False, False, True]
    lengths = budget.total_lengths(total, text=budget.rendered_text())
    assert max(r["total_tokens"] for r in lengths.collect()) <= 100
    assert sum(r["over_limit"] for r in total.collect()) >= 1 and total.count() == 4
    with pytest.raises(ValueError, match="total"):
        budget.enforce_budget(df, budget="both")
