import random

import regex
from pyspark.sql import functions as F

from conftest import FLAT, rows
from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.frames import compute_once
from corpusmix.functions.tokens import BATCH_CHARS, TOKEN, BatchTokenizer, PatternTokenizer
from corpusmix.operators import budget
from corpusmix.operators.prompts import TRANSLATION_TEMPLATE

PATTERN = regex.compile(TOKEN)


class Words:
    """A tokenizer object for the Arrow slot; its token ids are the tokens themselves."""

    loads = 0

    def __init__(self):
        Words.loads += 1
        assert Words.loads == 1

    def encode_batch(self, texts):
        return [PATTERN.findall(text) for text in texts]

    def decode(self, ids):
        return "".join(token for token in ids if not regex.search("<(?:bos|eos|start_of_turn|end_of_turn)>", token))


def texts(count, seed):
    rng = random.Random(seed)
    words = ["ab", "ŵy", "7", "42", "<bos>", "-", "\n", "  ", "日本", " ", "<end_of_turn>", "x<y"]
    return ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(0, 30))) for _ in range(count)]


def test_counts_equal_a_plain_regular_expression(spark):
    values = texts(200, 1) + ["", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for tokenizer in (PatternTokenizer(), BatchTokenizer(Words)):
        for row in df.select("v", tokenizer.count(F.col("v")).alias("n")).collect():
            assert row["n"] == len(PATTERN.findall(row["v"] or ""))


def test_cut_keeps_a_prefix(spark):
    df = spark.createDataFrame([(v, at % 9) for at, v in enumerate(texts(100, 2))], "v string, n int")
    for tokenizer in (PatternTokenizer(), BatchTokenizer(Words)):
        for row in df.select("*", tokenizer.cut(F.col("v"), F.col("n")).alias("c")).collect():
            assert row["c"] == Words.decode(None, PATTERN.findall(row["v"])[: row["n"]]).strip()


def by_hand(row, max_tokens, max_source):
    """The budget rule for one row, spelled out."""
    source, target = row["source_text"], row["target_text"]
    count = lambda text: len(PATTERN.findall(text))
    if count(source) > max_source:
        return None
    if count(source) <= max_tokens and count(target) <= max_tokens:
        return target, False
    if row["task"] == "translation":
        prompt = TRANSLATION_TEMPLATE.format(
            source_lang_code=row["source_lang_code"], target_lang_code=row["target_lang_code"], text=source
        )
    else:
        prompt = "<bos><start_of_turn>user\n" + source.strip() + "<end_of_turn>\n<start_of_turn>model\n"
    allowed = max(0, max_tokens - 1 - count(prompt) - count("<end_of_turn>\n"))
    tokens = PATTERN.findall(target)
    if len(tokens) > allowed:
        target = Words.decode(None, tokens[:allowed]).strip()
    return (target, True) if target.strip() else None


def test_budget_equals_the_rule(spark):
    rng = random.Random(3)
    sources, targets = texts(300, 4), texts(300, 5)
    data = [
        (rng.choice(["translation", "instruction"]), s, t, "en", "cy", at)
        for at, (s, t) in enumerate(zip(sources, targets))
        if s.strip() and t.strip()
    ]
    df = spark.createDataFrame(data, FLAT + ", id int")
    for tokenizer in (PatternTokenizer(), BatchTokenizer(Words)):
        for max_tokens, max_source in ((25, 18), (15, 30), (2048, 1266)):
            expected = []
            for row in df.collect():
                kept = by_hand(row, max_tokens, max_source)
                if kept:
                    expected.append((row["id"], *kept))
            found = budget.enforce_budget(df, tokenizer, max_tokens, max_source)
            assert rows(found, "id", "target_text", "over_limit") == sorted(expected, key=repr)


def test_lengths_are_counted_once(spark):
    df = spark.createDataFrame([("translation", "a b", "c", "en", "cy")], FLAT)
    measured = budget.measure(df).where("src_len <= 3 and tgt_len <= 3")
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2
    fitted = budget.enforce_budget(df)._jdf.queryExecution().optimizedPlan().toString()
    assert fitted.count("Generate inline") == 3
    assert "Python" not in fitted


def test_compute_once_replaces_and_keeps_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tuple(compute_once(df, a=F.col("a") + F.col("b"), c=F.lit(5)).first()) == (2, 3, 5)


def test_measured_text(spark):
    df = spark.createDataFrame([("instruction", "q {target}", None, "en", "en")], FLAT)
    text = df.select(budget.measured_text().alias("t")).first()["t"]
    assert text == fixed.MEASURED_TEXT.replace("{source}", "q {target}", 1).replace(
        "model\n{target}", "model\n"
    )
    assert budget.total_lengths(df).first()["total_tokens"] == len(PATTERN.findall(text))


class Bounded(Words):
    """A tokenizer that is given no more than a part of a large Arrow batch at once."""

    def __init__(self):
        pass

    def encode_batch(self, texts):
        assert len(texts) <= 1_000 and sum(map(len, texts)) < 2 * BATCH_CHARS
        return super().encode_batch(texts)


def test_a_large_batch_reaches_the_tokenizer_in_parts(spark):
    df = spark.range(0, 3_000, 1, 1).select(
        F.when(F.col("id") % 11 > 0, F.expr("repeat('ab 7 ', cast(id % 200 as int))")).alias("v"), (F.col("id") % 9).cast("int").alias("n")
    )
    found = df.select("*", BatchTokenizer(Bounded).count(F.col("v")).alias("c"), BatchTokenizer(Bounded).cut(F.col("v"), F.col("n")).alias("t"))
    for row in found.collect():
        tokens = PATTERN.findall(row["v"] or "")
        assert (row["c"], row["t"]) == (len(tokens), "".join(tokens[: row["n"]]).strip())


def test_native_counts_and_cuts_of_odd_texts(spark):
    odd = ["<", "<<bos>", "<bos", " <bos>x", "a<eos>\n", "4ab", "  ", " \t ", "x \x0b", "ª1²é", "\x1c\x85", "𝒳y😀", "<start_of_turn<eos>>", "<bos> <eos> b", ""]
    values = odd + [" ".join(pair) for pair in zip(odd, odd[1:])]
    df = spark.createDataFrame([(v, n) for v in values for n in range(6)], "v string, n int")
    native = PatternTokenizer()
    for row in df.select("*", native.count(F.col("v")).alias("c"), native.cut(F.col("v"), F.col("n")).alias("t")).collect():
        tokens = PATTERN.findall(row["v"])
        assert (row["c"], row["t"]) == (len(tokens), Words.decode(None, tokens[: row["n"]]).strip())


def test_tokens_are_neither_kept_nor_looked_at_one_by_one(spark):
    df, native = spark.createDataFrame([("a b", 1)], "v string, n int"), PatternTokenizer()
    plan = df.select(native.count(F.col("v")), native.cut(F.col("v"), F.col("n")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array_join" not in plan and "), 1)" in plan
