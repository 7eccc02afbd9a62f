import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import FLAT, rows
from corpusmix.operators import packing, prompts, reports


def flat(spark, *lines):
    return spark.createDataFrame(list(lines), FLAT)


def test_prompt_and_completion(spark):
    df = flat(
        spark,
        ("translation", " hi", " helo ", "en", "cy"),
        ("instruction", " ask ", "answer\n", "en", "en"),
    )
    template = "<bos>[{source_lang_code}>{target_lang_code}] {text}<end_of_turn>\n<start_of_turn>model\n"
    assert rows(prompts.render(df, template)) == [
        (
            "<bos><start_of_turn>user\nask<end_of_turn>\n<start_of_turn>model\n",
            "answer<end_of_turn>\n",
        ),
        ("<bos>[en>cy]  hi<end_of_turn>\n<start_of_turn>model\n", "helo<end_of_turn>\n"),
    ]
    assert prompts.render(df, template, bos="").where("prompt like '<start%'").count() == 1
    assert tuple(prompts.boundary_violations(prompts.render(df)).first()) == (0, 2)


def test_unknown_task_fails(spark):
    df = flat(spark, ("summary", "a", "b", "en", "en"))
    with pytest.raises(Exception, match="no prompt for task summary"):
        prompts.render(df).collect()


def test_template_is_checked():
    with pytest.raises(ValueError, match="must end"):
        prompts.translation_prompt("{text}")
    with pytest.raises(ValueError, match="slot"):
        prompts.translation_prompt("<start_of_turn>model\n")


def test_render_caps_rows_in_key_order(spark):
    df = flat(spark, *[("instruction", f"q{n}", "a", "en", "en") for n in range(9)])
    keyed = df.withColumn("order_key", F.reverse("source_text"))
    first = [row[0].split("\n")[1] for row in rows(prompts.render(keyed, max_rows=2), "prompt")]
    assert first == ["q0<end_of_turn>", "q1<end_of_turn>"]
    assert prompts.render(keyed, max_rows=50).count() == 9


def pool(spark):
    lines = (
        [("translation", "a", "b", "en", "cy", "translation", "one")] * 3
        + [("translation", "a", "b", "cy", "en", "dictionary", "two")] * 2
        + [("instruction", "a", "b", "cy", "en", "dictionary", "two")]
        + [("instruction", "a", "b", "en", "en", "instruction", "three")] * 5
    )
    return spark.createDataFrame(lines, FLAT + ", section string, dataset_source string")


def test_source_report(spark):
    assert rows(reports.source_report(pool(spark))) == [
        ("TOTAL", "TOTAL", 11, 5, 6),
        ("dictionary", "TOTAL", 3, 2, 1),
        ("dictionary", "two", 3, 2, 1),
        ("instruction", "TOTAL", 5, 0, 5),
        ("instruction", "three", 5, 0, 5),
        ("translation", "TOTAL", 3, 3, 0),
        ("translation", "one", 3, 3, 0),
    ]


def test_totals_and_directions(spark):
    assert tuple(reports.task_totals(pool(spark)).first()) == (5, 6, 11, 45.5, 54.5)
    assert rows(reports.direction_counts(pool(spark))) == [("cy->en", 2), ("en->cy", 3)]
    empty = reports.task_totals(pool(spark).where("false")).first()
    assert tuple(empty) == (0, 0, 0, None, None)


def test_published_totals_and_percentages(spark):
    assert 1_120_776 + 412_135 == 1_532_911
    line = spark.range(1).select(
        reports.percent(F.lit(1_106_716), F.lit(1_514_253)).alias("t"),
        reports.percent(F.lit(407_537), F.lit(1_514_253)).alias("i"),
    )
    assert tuple(line.first()) == (73.1, 26.9)


def test_length_statistics_equal_numpy(spark):
    rng = random.Random(5)
    data = [("translation" if rng.random() < 0.6 else "instruction", int(rng.expovariate(0.01))) for _ in range(999)]
    df = spark.createDataFrame(data, "task string, total_tokens int")
    for row in reports.length_statistics(df).collect():
        values = [n for task, n in data if row["segment"] in ("all", task)]
        points = np.percentile(values, [50, 95, 99, 99.9])
        assert row["samples"] == len(values)
        assert row["max_tokens"] == max(values)
        assert row["mean_tokens"] == pytest.approx(np.mean(values))
        found = [row[f"{name}_tokens"] for name in ("median", "p95", "p99", "p99_9")]
        assert found == pytest.approx(list(points))


def test_length_statistics_without_rows(spark):
    df = spark.createDataFrame([("translation", 5)], "task string, total_tokens int")
    found = {r["segment"]: (r["samples"], r["max_tokens"]) for r in reports.length_statistics(df).collect()}
    assert found == {"all": (1, 5), "translation": (1, 5), "instruction": (0, None)}


@pytest.mark.parametrize("block", [1, 7, 50])
def test_packing_equals_a_running_sum(spark, block):
    rng = random.Random(6)
    data = [(f"{rng.getrandbits(64):016x}", rng.randint(0, 20)) for _ in range(400)]
    df = spark.createDataFrame(data, "order_key string, total_tokens int").repartition(5)
    start, expected, fills = 0, [], {}
    for key, length in sorted(data):
        if length:
            expected.append((key, length, start, start // block, (start + length - 1) // block))
            for token in range(start, start + length):
                fills.setdefault(token // block, []).append(key)
            start += length
    plan = packing.packing_plan(df, block_tokens=block)
    assert rows(plan) == sorted(expected, key=repr)
    found = {r["block"]: (r["rows"], r["tokens"]) for r in packing.block_fill(plan, block_tokens=block).collect()}
    assert found == {at: (len(set(keys)), len(keys)) for at, keys in fills.items()}
    assert {r["fill"] for r in packing.block_fill(plan, block_tokens=block).where(F.col("block") < start // block).collect()} == {1.0}
