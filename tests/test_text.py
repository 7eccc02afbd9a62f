import hashlib
import sys

import pytest
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions import text
from corpusmix.sources.readers import with_order_key
from corpusmix.sources.recipe import SourceEntry


def test_white_space_is_all_of_it():
    expected = {chr(code) for code in range(sys.maxunicode + 1) if chr(code).isspace()}
    assert set(fixed.WHITESPACE) == expected
    assert len(fixed.WHITESPACE) == len(expected) == 29


def test_strip_equals_python(spark):
    values = [fixed.WHITESPACE + "a b" + fixed.WHITESPACE, "​x​", "", " ", "\x1f é\n\ny　"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for row in df.select("v", text.strip(F.col("v")).alias("s")).collect():
        assert row["s"] == row["v"].strip()


def test_missing_words(spark):
    values = ["None", "NULL", "", None, "none ", "nothing"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = [row["m"] for row in df.select(text.is_missing(F.col("v")).alias("m")).collect()]
    assert found == [True, True, True, True, False, False]


def test_first_usable_tests_before_stripping(spark):
    df = spark.createDataFrame(
        [("", None, "c"), (None, " ", "c"), ("a", "b", "c"), (None, None, None)], "a string, b string, c string"
    )
    found = [r["v"] for r in df.select(text.first_usable(df, ["x", "a", "b", "c"]).alias("v")).collect()]
    assert found == ["c", " ", "a", ""]
    numbers = spark.createDataFrame([(0, "z"), (5, "z")], "a int, b string")
    found = [r["v"] for r in numbers.select(text.first_usable(numbers, ["a", "b"]).alias("v")).collect()]
    assert found == ["z", "5"]


@pytest.mark.parametrize("template", ["'{a}' \\ {b}\n{a}{c}", "{a}", "plain", "it's {b}", "{a}{b}"])
def test_fill(spark, template):
    df = spark.createDataFrame([("{b}'", "x\ny")], "a string, b string")
    found = df.select(text.fill(template, a="a", b="b").alias("v")).first()["v"]
    parts = template.replace("{a}", "\0").replace("{b}", "\1")
    assert found == parts.replace("\0", "{b}'").replace("\1", "x\ny")


def test_pair_hash_equals_hashlib(spark):
    pairs = [("a", "b"), ("", None), ("ŵy", "egg"), ("a\0b", "c"), (None, "x")]
    df = spark.createDataFrame(pairs, "s string, t string")
    hashes = df.select("s", "t", text.pair_hash(F.col("s"), F.col("t")).alias("h")).collect()
    for row in hashes:
        plain = (row["s"] or "") + "\0" + (row["t"] or "")
        assert row["h"] == hashlib.sha1(plain.encode()).hexdigest()


def test_keyed_hash_and_pick(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("key"))
    hashed = df.select("key", text.keyed_hash(42, F.col("key")).alias("h"))
    for row in hashed.select("*", text.pick(F.col("h"), 3).alias("p")).collect():
        digest = hashlib.md5(("42\0" + row["key"]).encode()).hexdigest()
        assert (row["h"], row["p"]) == (digest, int(digest[:4], 16) % 3)


def test_order_key_uses_the_id_or_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a")], "id int, v string")
    by_id = SourceEntry("translation", "x", "p", 0, id_columns=("id",))
    by_row = SourceEntry("translation", "x", "p", 0)
    assert with_order_key(df, by_id).select("order_key").distinct().count() == 2
    assert with_order_key(df, by_row).select("order_key").distinct().count() == 3
    assert with_order_key(df.repartition(3), by_row).select("order_key").distinct().count() == 3
