"""One selection for many sources, groups without a value, and narrow deduplication."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from corpusmix.operators import dedup, rebalance, selection, split
from corpusmix.plans import corpus
from corpusmix.sources.recipe import SourceEntry


def jobs_of(spark, name, action):
    """How many jobs an action runs."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_shares_of_frames_with_other_columns(spark):
    one = spark.range(1001).select(F.md5(F.col("id").cast("string")).alias("order_key"), "id")
    two = spark.range(77).select(F.lit("x").alias("text"), F.md5(F.concat(F.lit("a"), F.col("id").cast("string"))).alias("order_key"))
    empty = one.limit(0)
    taken = selection.take_shares([(one, 0.35), (two, 0.5), (empty, 0.5), (one, 0.0), (two, 1.0)])
    assert [df.count() for df in taken] == [350, 38, 0, 0, 77]
    assert [df.columns for df in taken] == [one.columns, two.columns, one.columns, one.columns, two.columns]
    first = sorted(r["order_key"] for r in one.collect())[:350]
    assert sorted(r["order_key"] for r in taken[0].collect()) == first
    assert selection.take_shares([]) == []


def test_shares_end_among_equal_keys(spark):
    """Every row has one key, or is a copy of another: still exactly as many, and none more often than it was there."""
    same = spark.range(1000).select(F.lit("k").alias("order_key"), "id")
    copies = spark.range(1000).select(F.lit("k").alias("order_key"), (F.col("id") % 3).alias("v"))
    mixed = spark.range(90).select((F.col("id") % 9).cast("string").alias("order_key"), (F.col("id") % 2).alias("v"))
    taken = selection.take_shares([(same, 0.5), (copies, 0.7), (mixed, 0.35)])
    assert [df.count() for df in taken] == [500, 700, 31]
    assert taken[0].distinct().count() == 500
    for df, kept in ((copies, taken[1]), (mixed, taken[2])):
        there, got = Counter(rows(df)), Counter(rows(kept))
        assert all(got[row] <= there[row] for row in got)
    assert max(r["order_key"] for r in taken[2].collect()) == "3"


def test_jobs_do_not_grow_with_the_number_of_sliced_sources(spark, tmp_path):
    spark.range(300).selectExpr("id", "concat('a', id) AS en", "concat('b', id) AS cy").write.parquet(str(tmp_path / "s"))

    frames = [spark.read.parquet(str(tmp_path / "s")) for _ in range(7)]

    def slices(count):
        entries = tuple(
            SourceEntry("translation", f"s{k}", str(tmp_path / "s"), k, usage=0.1 * (k + 1), id_columns=("id",))
            for k in range(count)
        )
        return corpus.usage_slices(frames[:count], entries)

    sizes = [df.count() for df in slices(7)]
    assert sizes == [30, 60, 90, 120, 150, 180, 210]
    assert jobs_of(spark, "one", lambda: slices(1)) == jobs_of(spark, "seven", lambda: slices(7))


def test_null_groups_are_groups(spark):
    df = spark.range(1000).select(
        "id", F.md5(F.col("id").cast("string")).alias("order_key"), F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("g")
    )
    assert selection.take_exact(df, selection.fraction_quota(1.0), groups=["g"]).count() == 1000
    half = selection.take_exact(df, selection.fixed_quota(40), groups=["g"]).groupBy("g").count()
    assert rows(half) == sorted([(None, 40), (0, 40), (1, 40), (2, 40)], key=repr)
    marked = selection.mark_first(df, selection.fixed_quota(5), "m", "order_key", ["g"])
    assert marked.where("m AND g IS NULL").count() == 5 and marked.count() == 1000


def test_directions_without_codes_are_balanced_and_no_row_without_a_task_is_lost(spark):
    kinds = [("translation", "en", "cy", 50), ("translation", None, "cy", 20), ("translation", None, None, 30)]
    kinds += [("instruction", "en", "en", 9), (None, "en", "cy", 8)]
    made = [(t, a, b, f"{k}-{n}") for k, (t, a, b, count) in enumerate(kinds) for n in range(count)]
    unique = spark.createDataFrame(made, "task string, source_lang_code string, target_lang_code string, pair_hash string")
    counted = rebalance.balance_directions(unique).groupBy("task", "source_lang_code", "target_lang_code").count()
    expected = [("translation", "en", "cy", 20), ("translation", None, "cy", 20), ("translation", None, None, 20)]
    assert rows(counted) == sorted(expected + [("instruction", "en", "en", 9), (None, "en", "cy", 8)], key=repr)


@pytest.mark.parametrize("rule", ["error", "train_only"])
def test_a_stratum_without_a_key_gets_its_part(spark, rule):
    made = [("translation", "en" if n % 4 else None, "cy", f"h{n}") for n in range(400)]
    df = spark.createDataFrame(made, "task string, source_lang_code string, target_lang_code string, pair_hash string")
    counts = split.stratified_split(df, 40, rule).groupBy("stratify_key", "split").count()
    name = "translation:en->cy"
    assert rows(counts) == sorted([(name, "test", 30), (name, "train", 270), (None, "test", 10), (None, "train", 90)], key=repr)


# --- deduplication ---------------------------------------------------------------------------------


def pool_of(spark, pairs):
    rng = random.Random(2)
    made = [
        (s, t, "translation", "en", "cy", rng.randrange(3), rng.random() < 0.3, f"k{n}", rng.randrange(2), f"s{n % 4}")
        for n, (s, t) in enumerate(pairs)
    ]
    names = "source_text string, target_text string, task string, source_lang_code string, target_lang_code string"
    pool = spark.createDataFrame(made, f"{names}, source_ord int, over_limit boolean, order_key string, emit_ord int, dataset_source string")
    return dedup.with_pair_hash(pool.repartition(5))


def plain_first(pool):
    groups = {}
    for row in pool.collect():
        groups.setdefault(row["pair_hash"], []).append(row)
    place = lambda r: tuple(r[name] for name in dedup.PLACE)
    return sorted((*[min(g, key=place)[n] for n in ("pair_hash", *dedup.PLACE, "source_text")], len(g)) for g in groups.values())


@pytest.mark.parametrize("share", [0.11, 0.9])
def test_keep_first_equals_plain_python(spark, share):
    rng = random.Random(int(share * 100))
    pairs = []
    for n in range(600):
        again = pairs and rng.random() < share
        pairs.append(rng.choice(pairs) if again else (f"text {n}", rng.choice(["", "x", None])))
    pairs += [("hot", "pair")] * 300  # a third of all rows
    pool = pool_of(spark, pairs)
    kept = dedup.keep_first(pool)
    assert rows(kept, "pair_hash", *dedup.PLACE, "source_text", "copies") == plain_first(pool)


@pytest.mark.parametrize("bits", [64, 256])
def test_shared_bits_change_nothing(spark, monkeypatch, bits):
    """With so few bits that pairs that are there once share theirs with others."""
    monkeypatch.setattr(dedup, "REPEAT_BITS", bits)
    pool = pool_of(spark, [(f"t{n % 150}" if n < 200 else f"u{n}", "x") for n in range(400)])
    flagged = dedup.may_repeat(pool)
    assert flagged.where("NOT _again").count() < 300 and flagged.count() == 400
    assert rows(dedup.keep_first(pool), "pair_hash", *dedup.PLACE, "source_text", "copies") == plain_first(pool)


def test_pairs_that_are_there_once_do_not_move(spark):
    pool = pool_of(spark, [(f"t{n}", "x") for n in range(100)] + [("t1", "x")])
    flagged = dedup.may_repeat(pool)
    assert flagged.where("_again").count() in (2, 3) and "_again" in flagged.columns
    assert dedup.keep_first(pool).count() == 100 and dedup.keep_first(pool.limit(0)).count() == 0
