import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import FLAT, rows
from corpusmix.operators import dedup, rebalance, split
from corpusmix.operators.selection import take_exact

POOL = FLAT + ", dataset_source string, source_ord int, over_limit boolean, order_key string, emit_ord int"


def random_pool(count, seed, hot=0):
    rng = random.Random(seed)
    data = []
    for at in range(count):
        ord_ = rng.randint(0, 3)
        pair = rng.choice([("hot", "pair")] * hot + [(f"s{rng.randint(0, 60)}", f"t{rng.randint(0, 3)}")])
        task = rng.choice(["translation", "instruction"])
        data.append((task, *pair, "en", "cy", f"src{ord_}", ord_, rng.random() < 0.2, f"{rng.getrandbits(64):016x}", at))
    return data


def test_languages_can_be_part_of_the_key(spark):
    line = ("translation", "a", "b", "en", "cy", "s", 0, False, "0", 0)
    data = [line, line, (*line[:3], "cy", "en", *line[5:]), (*line[:4], None, *line[5:])]
    pool = spark.createDataFrame(data, POOL)
    for key, copies in (("pair", [4]), ("pair+lang", [1, 1, 2])):
        unique = dedup.keep_first(dedup.with_pair_hash(pool, key))
        assert sorted(row["copies"] for row in unique.collect()) == copies
    with pytest.raises(ValueError, match="pair"):
        dedup.with_pair_hash(pool, "texts")


def test_keep_first_and_log_equal_one_pass_over_the_list(spark):
    data = random_pool(700, 1, hot=2)
    pool = dedup.with_pair_hash(spark.createDataFrame(data, POOL).repartition(5))
    ordered = sorted(pool.collect(), key=lambda r: (r["source_ord"], r["over_limit"], r["order_key"], r["emit_ord"]))
    seen, kept, log = {}, [], []
    for row in ordered:
        if row["pair_hash"] in seen:
            log.append((row["dataset_source"], seen[row["pair_hash"]], row["pair_hash"]))
        else:
            seen[row["pair_hash"]] = row["dataset_source"]
            kept.append((row["pair_hash"], row["order_key"], row["task"], row["source_text"], row["target_text"]))
    unique = dedup.keep_first(pool)
    assert rows(unique, "pair_hash", "order_key", "task", "source_text", "target_text") == sorted(kept, key=repr)
    assert unique.agg(F.sum("copies")).first()[0] == 700
    groups = dedup.duplicate_groups(pool)
    assert Counter(tuple(r) for r in dedup.duplicate_log(groups).collect()) == Counter(log)
    counts = {(r["source"], r["winner"]): r["dropped"] for r in dedup.duplicate_counts(groups).collect()}
    assert counts == Counter((source, winner) for source, winner, _ in log)
    assert unique.count() + len(log) == 700


def test_dedup_shuffles_only_rows_that_may_repeat_and_combines_them_before(spark):
    pool = dedup.with_pair_hash(spark.createDataFrame(random_pool(50, 2), POOL))
    plan = dedup.keep_first(pool)._jdf.queryExecution().executedPlan().toString()
    single, again = plan.split("partial_min")[0], plan.split("partial_min")[-1]
    # Whole rows meet in one aggregate, after being combined; the other exchanges are those of counts and bits.
    assert plan.count("partial_min(struct") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in again
    texts = [line for line in single.splitlines() if "Exchange" in line and "source_text" in line]
    assert texts == []


def test_cognates_lose_their_second_direction(spark):
    data = [
        ("translation", "radio", "radio", "en", "cy", "s", 0, False, "k", 0),
        ("translation", "radio", "radio", "cy", "en", "s", 0, False, "k", 1),
    ]
    unique = dedup.keep_first(dedup.with_pair_hash(spark.createDataFrame(data, POOL)))
    assert rows(unique, "source_lang_code", "copies") == [("en", 2)]


def quota_of(spark, t, i, shares=(0.7, 0.3)):
    counts = spark.createDataFrame([("translation", t), ("instruction", i)], "task string, available bigint")
    quota = rebalance.ratio_quota(*shares)(counts.where("available > 0"))
    return {r["task"]: r["k"] for r in quota.collect()}


def test_quotas_match_the_published_numbers(spark):
    assert quota_of(spark, 948_257, 409_804) == {"translation": 948_257, "instruction": 406_396}
    assert quota_of(spark, 733_196, 400_000) == {"translation": 733_196, "instruction": 314_227}


def test_quota_cases(spark):
    assert quota_of(spark, 100, 3) == {"translation": 7, "instruction": 3}
    assert quota_of(spark, 3, 100, (0.5, 0.5)) == {"translation": 3, "instruction": 3}
    assert quota_of(spark, 5, 100, (2 / 3, 1 / 3)) == {"translation": 5, "instruction": 2}  # 2.5, half to even
    assert quota_of(spark, 10, 0) == {"translation": 10}
    with pytest.raises(ValueError):
        rebalance.ratio_quota(1.0, 0.0)


def unique_rows(spark, sizes):
    """``sizes`` maps (task, source code, target code) to a number of rows."""
    parts = [
        spark.range(count).select(
            F.lit(task).alias("task"),
            F.lit(source).alias("source_lang_code"),
            F.lit(target).alias("target_lang_code"),
            F.sha1(F.concat(F.lit(f"{task}{source}{target}"), F.col("id"))).alias("pair_hash"),
        )
        for (task, source, target), count in sizes.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


SIZES = {
    ("translation", "en", "cy"): 400,
    ("translation", "cy", "en"): 300,
    ("instruction", "en", "en"): 250,
    ("instruction", "fr", "fr"): 51,
    ("instruction", "cy", "cy"): 7,
}


def test_rebalance_and_direction_balance(spark):
    unique = unique_rows(spark, SIZES)
    mixed = rebalance.rebalance(unique, 0.5, 0.5)
    tasks = Counter(r["task"] for r in mixed.collect())
    assert tasks == {"translation": 308, "instruction": 308}
    assert rows(mixed) == rows(rebalance.rebalance(unique.repartition(9), 0.5, 0.5))
    assert mixed.select("pair_hash").distinct().count() == 616
    even = rebalance.balance_directions(unique)
    assert Counter((r["task"], r["source_lang_code"]) for r in even.collect()) == {
        ("translation", "en"): 300,
        ("translation", "cy"): 300,
        ("instruction", "en"): 250,
        ("instruction", "fr"): 51,
        ("instruction", "cy"): 7,
    }


def test_rebalance_leaves_a_single_task_alone(spark):
    unique = unique_rows(spark, {("translation", "en", "cy"): 20})
    assert rebalance.rebalance(unique, 0.7, 0.3).count() == 20


def largest_remainder(sizes, wanted):
    total = sum(sizes.values())
    floors = {key: n * wanted // total for key, n in sizes.items()}
    order = sorted(sizes, key=lambda key: (-(sizes[key] * wanted % total), key))
    for key in order[: wanted - sum(floors.values())]:
        floors[key] += 1
    return floors


def test_split_is_exact_and_proportional(spark):
    whole = split.stratified_split(unique_rows(spark, SIZES), 100)
    counts = defaultdict(Counter)
    for row in whole.collect():
        counts[row["split"]][row["stratify_key"]] += 1
    sizes = {f"{task}:{s}->{t}": n for (task, s, t), n in SIZES.items()}
    assert {k: v for k, v in largest_remainder(sizes, 100).items() if v} == counts["test"]
    assert sum(counts["test"].values()) == 100
    assert whole.count() == sum(SIZES.values()) == whole.select("pair_hash").distinct().count()
    again = split.stratified_split(unique_rows(spark, SIZES).repartition(7), 100)
    assert rows(whole) == rows(again)


def test_split_moves_no_rows(spark):
    plan = split.stratified_split(unique_rows(spark, SIZES), 100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_published_strata_add_up(spark):
    """Shares of 366,598 in 1,047,423 rows give 350 of 1,000 test rows to each direction."""
    counts = spark.createDataFrame(
        [("translation:cy->en", 366_598), ("translation:en->cy", 366_598), ("instruction:x", 314_227)],
        "stratify_key string, available bigint",
    )
    found = {r["stratify_key"]: r["k"] for r in split.proportional_quota(1000)(counts).collect()}
    assert found == {"translation:cy->en": 350, "translation:en->cy": 350, "instruction:x": 300}


def test_small_strata(spark):
    unique = unique_rows(spark, {("translation", "en", "cy"): 50, ("instruction", "en", "en"): 1})
    with pytest.raises(ValueError, match="single row"):
        split.stratified_split(unique, 10)
    kept = split.stratified_split(unique, 10, on_small_stratum="train_only")
    assert kept.where("split = 'test'").count() == 10
    assert kept.where("task = 'instruction'").first()["split"] == "train"
    with pytest.raises(ValueError, match="cannot cover"):
        split.stratified_split(unique_rows(spark, SIZES), 3)
    with pytest.raises(ValueError, match="on_small_stratum"):
        split.stratified_split(unique, 10, on_small_stratum="drop")


def test_train_only_gives_the_exact_size_or_an_error(spark):
    sizes = {("translation", "en", "cy"): 2, ("instruction", "l", "l"): 9}
    sizes |= {("instruction", f"l{n}", "x"): 1 for n in range(8)}
    unique = unique_rows(spark, sizes)
    whole = split.stratified_split(unique, 5, on_small_stratum="train_only")
    counts = Counter((r["stratify_key"], r["split"]) for r in whole.collect())
    assert sum(n for (_, part), n in counts.items() if part == "test") == 5
    assert {key for key, part in counts if part == "train"} == {key for key, _ in counts}
    with pytest.raises(ValueError, match="without training rows"):
        split.stratified_split(unique, 10, on_small_stratum="train_only")
    assert split.capped_parts({"a": 2, "b": 2, "c": 96}, 90) == {"a": 1, "b": 1, "c": 88}
    assert split.capped_parts({"a": 3, "b": 3}, 4) == {"a": 2, "b": 2}


def test_stratum_codes_are_dense_and_sorted(spark):
    coded = split.with_stratum_code(split.with_stratify_key(unique_rows(spark, SIZES)))
    pairs = sorted({(r["stratum_code"], r["stratify_key"]) for r in coded.collect()})
    assert [code for code, _ in pairs] == list(range(5))
    assert [key for _, key in pairs] == sorted(key for _, key in pairs)


def test_shuffled_is_a_seeded_order(spark):
    unique = unique_rows(spark, SIZES)
    first = [r["pair_hash"] for r in rebalance.shuffled(unique, 1).collect()]
    assert first == [r["pair_hash"] for r in rebalance.shuffled(unique.repartition(8), 1).collect()]
    assert first != [r["pair_hash"] for r in rebalance.shuffled(unique, 2).collect()]
    assert sorted(first) == sorted(r["pair_hash"] for r in unique.collect())


def test_smallest_quota_needs_every_group(spark):
    unique = unique_rows(spark, SIZES).where("task = 'translation'")
    codes = ["source_lang_code", "target_lang_code"]
    assert take_exact(unique, rebalance.smallest_quota, "pair_hash", codes).count() == 600
