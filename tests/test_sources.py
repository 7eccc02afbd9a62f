"""Bitext, dictionary and conversation sources on small tables."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.tokens import PatternTokenizer
from corpusmix.operators import bitext, conversations, dictionary
from corpusmix.sources.readers import read_source
from corpusmix.sources.recipe import SourceEntry


def keyed(df):
    return df.withColumn("order_key", F.lit("k"))


def sides(df):
    return [tuple(r) for r in bitext.map_bitext(df).select("en_text", "cy_text").collect()]


def test_plain_columns(spark):
    df = spark.createDataFrame(
        [(" a ", "x", "b", "y"), ("", "x", None, "y"), (" ", "x", "b", "y"), (None, None, "b", "")],
        "text_en string, en string, text_cy string, target string",
    )
    assert sides(df) == [("a", "b"), ("x", "y"), ("", "b"), ("", "b")]


def test_struct_map_and_json(spark):
    df = spark.sql("SELECT named_struct('en', ' a', 'cy', cast(null as string)) AS translation")
    assert sides(df) == [("a", "")]
    df = spark.sql("SELECT named_struct('en', 'a') AS translation")
    assert sides(df) == [("a", "")]
    df = spark.sql("SELECT map('en', 'a', 'cy', ' b ') AS translation")
    assert sides(df) == [("a", "b")]
    df = spark.createDataFrame([('{"en": "a\\n", "cy": "b"}',), ('{"en": "a"}',)], "translation string")
    assert sides(df) == [("a", "b"), ("a", "")]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_costly_columns_are_evaluated_once(spark):
    pairs = keyed(spark.createDataFrame([('{"en": "a", "cy": "b"}',)], "translation string"))
    assert optimized(bitext.translation_records(pairs, fixed.DIRECTIONS)).count("from_json") == 1
    chats = keyed(spark.createDataFrame([([("user", "q")],)], TURNS))
    records = bitext.drop_blank(conversations.instruction_records(chats))
    assert optimized(records).count("transform(") == 2
    two = keyed(spark.createDataFrame([("a", "b")], "en string, cy string"))
    records = bitext.translation_records(two, fixed.DIRECTIONS, PatternTokenizer()).where("src_len < 9")
    assert optimized(records).count("regexp_extract_all") == 2


def test_malformed_json_fails(spark):
    df = spark.createDataFrame([("{not json",)], "translation string")
    with pytest.raises(Exception, match="FAILFAST|Malformed"):
        sides(df)


def test_directions_and_blank_pairs(spark):
    df = keyed(spark.createDataFrame([("hi", "helo"), ("x", " "), (None, "y")], "en string, cy string"))
    both = bitext.translation_records(df, ["cy-en", "en-cy"])
    assert rows(both, "source_text", "target_text", "source_lang_code", "target_lang_code", "emit_ord") == [
        ("helo", "hi", "cy", "en", 0),
        ("hi", "helo", "en", "cy", 1),
    ]
    assert bitext.translation_records(df, ["en-cy"]).count() == 1


def test_expansion_carries_lengths(spark):
    df = keyed(spark.createDataFrame([("one two", "tri")], "en string, cy string"))
    records = bitext.translation_records(df, fixed.DIRECTIONS, PatternTokenizer())
    assert rows(records, "source_lang_code", "src_len", "tgt_len") == [("cy", 1, 2), ("en", 2, 1)]


DICTIONARY = (
    "order_key string, Saesneg string, Cymraeg string, `Diffiniad Saesneg` string, "
    "`Diffiniad Cymraeg` string, `Cyd-destun Saesneg` string, `Cyd-destun Cymraeg` string"
)


def test_dictionary_fan_out(spark):
    df = spark.createDataFrame(
        [
            ("1", "egg", "wy", "from a hen", "gan iâr", " food ", None),
            ("2", "sea", "môr", "", "None", "geo", "daear"),
            ("3", "null", "dim", "d", "d", None, None),
            ("4", "radio", "radio", None, "peth", "null", "cyfrwng"),
        ],
        DICTIONARY,
    )
    found = dictionary.dictionary_records(df, fixed.DIRECTIONS)
    kinds = rows(found, "order_key", "emit_ord", "task", "source_lang_code", "target_lang_code")
    assert kinds == [
        ("1", 0, "translation", "en", "cy"),
        ("1", 1, "translation", "cy", "en"),
        ("1", 2, "instruction", "en", "cy"),
        ("1", 3, "instruction", "cy", "en"),
        ("2", 0, "translation", "en", "cy"),
        ("2", 1, "translation", "cy", "en"),
        ("4", 0, "translation", "en", "cy"),
        ("4", 1, "translation", "cy", "en"),
        ("4", 2, "instruction", "en", "cy"),
    ]
    answers = {
        (r["order_key"], r["emit_ord"]): (r["source_text"], r["target_text"])
        for r in found.where("task = 'instruction'").collect()
    }

    def expected(templates, **slots):
        return [(q.format(**slots), a.format(**slots)) for q, a in templates]

    assert answers[("1", 2)] in expected(
        fixed.EN_TO_CY_TEMPLATES, en="egg", cy="wy", definition="gan iâr"
    )
    assert answers[("1", 3)] in expected(
        fixed.CY_TO_EN_TEMPLATES, en="egg", cy="wy", definition="from a hen\nContext: food"
    )
    assert answers[("4", 2)] in expected(
        fixed.EN_TO_CY_TEMPLATES, en="radio", cy="radio", definition="peth\nCyd-destun: cyfrwng"
    )
    breakdown = dictionary.dictionary_breakdown(found)
    assert sum(r["rows"] for r in breakdown.collect()) == 9


def test_dictionary_questions_ignore_directions(spark):
    df = spark.createDataFrame([("1", "egg", "wy", "d", "e", None, None)], DICTIONARY)
    found = dictionary.dictionary_records(df, ["en-cy"])
    assert [r[0] for r in rows(found, "emit_ord")] == [0, 1, 2]


def test_template_choice_is_repeatable_and_uses_all(spark):
    df = spark.range(300).select(
        F.md5(F.col("id").cast("string")).alias("order_key"),
        F.lit("egg").alias("Saesneg"),
        F.lit("wy").alias("Cymraeg"),
        F.lit("d").alias("Diffiniad Saesneg"),
        F.lit("e").alias("Diffiniad Cymraeg"),
    )
    found = dictionary.dictionary_records(df, ["en-cy"])
    assert rows(found) == rows(dictionary.dictionary_records(df.repartition(7), ["en-cy"]))
    asked = found.where("task = 'instruction'").groupBy("source_text").count().collect()
    assert len(asked) == 5
    assert min(r["count"] for r in asked) > 50


def said(df, language="en"):
    return [tuple(r) for r in conversations.instruction_records(keyed(df), language).select("source_text", "target_text").collect()]


TURNS = "messages array<struct<role:string, content:string>>"


def test_messages(spark):
    df = spark.createDataFrame(
        [
            ([("system", "s"), ("User", " q "), ("assistant", "a"), ("user", "q2")],),
            ([("assistant", "early"), ("HUMAN", "  "), ("human", "late")],),
            ([("user", "q")],),
            ([],),
        ],
        TURNS,
    )
    assert said(df) == [("q", "a"), ("late", "early"), ("q", ""), ("", "")]


def test_message_parts(spark):
    df = spark.sql(
        "SELECT array(named_struct('role', 'user', 'content', "
        "array(named_struct('text', 'a'), named_struct('text', 'b')))) AS messages"
    )
    assert said(df) == [("a b", "")]


def test_precedence(spark):
    df = spark.sql(
        """
        SELECT * FROM VALUES
          (array(named_struct('role', 'x', 'content', 'm')), array(named_struct('role', 'user', 'content', 'c')), 'f', 'g'),
          (null, array(named_struct('role', 'user', 'content', 'c')), 'f', 'g'),
          (null, null, 'f', 'g')
        AS t(messages, conversations, prompt, response)
        """
    )
    assert said(df) == [("", ""), ("c", ""), ("f", "g")]


def test_lists_without_roles_give_nothing(spark):
    df = spark.sql("SELECT array('a', 'b') AS conversations, 'x' AS input")
    assert said(df) == [("", "")]
    df = spark.sql("SELECT array(named_struct('from', 'human', 'value', 'q')) AS conversations")
    assert said(df) == [("", "")]


def test_flat_columns_and_language(spark):
    df = spark.createDataFrame([("", "p", " i ", "o"), (None, None, "i", "")], "instruction string, prompt string, input string, output string")
    assert said(df) == [("p", "o"), ("i", "")]
    codes = conversations.instruction_records(keyed(df), "da-DK").select("source_lang_code", "target_lang_code").first()
    assert tuple(codes) == ("da-DK", "da-DK")


def test_turn_table_equals_lists(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 2, "user", "q"), (1, 1, "Assistant", " a "), (2, 0, "user", " "), (2, 1, "human", "h")],
        "conv int, turn int, role string, text string",
    )
    found = conversations.turn_table_records(turns, "conv", "turn", "role", "text")
    assert rows(found) == [(1, "q", "a"), (2, "h", "")]


def test_turn_table_with_one_huge_conversation(spark):
    turns = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("conv"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id")).alias("text"),
    )
    found = conversations.turn_table_records(turns, "conv", "turn", "role", "text")
    assert tuple(found.where("conv = -1").first()) == (-1, "t0", "t3")
    assert "collect" not in found._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", ["parquet", "json", "csv"])
def test_read_source(spark, tmp_path, kind):
    path = str(tmp_path / "src")
    df = spark.createDataFrame([("a\nb", 'say "x"')], "en string, cy string")
    writer = df.write.option("header", True).option("escape", '"')
    writer.format(kind).save(f"{path}/part-a")
    entry = SourceEntry("translation", "x", path, 0, config="part-a", format=kind)
    assert rows(read_source(spark, entry, df.schema if kind == "json" else None), "en", "cy") == rows(df)


def test_source_options_of_a_recipe(spark, tmp_path):
    from corpusmix.sources.recipe import parse_recipe

    path = str(tmp_path / "texts.csv")
    with open(path, "w", encoding="utf-8") as out:
        out.write('en,n\n"two\nlines",1\nplain,2\n')
    info = {"path": path, "format": "csv", "schema": "en string, n bigint", "multi_line": True}
    entry = parse_recipe({"translation_data": {"texts": info}}).entries[0]
    assert rows(read_source(spark, entry), "en", "n") == [("plain", 2), ("two\nlines", 1)]
    split = parse_recipe({"translation_data": {"texts": info | {"multi_line": False}}}).entries[0]
    assert read_source(spark, split).count() == 3
