"""One query per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import catalog
import corpusmix
from catalog import bindings
from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.text import strip
from corpusmix.functions.tokens import TOKEN, BatchTokenizer, PatternTokenizer
from corpusmix.operators import (
    budget,
    conversations,
    dedup,
    dictionary,
    evaluation,
    packing,
    prompts,
    rebalance,
    reports,
    selection,
    sketches,
    split,
)
from corpusmix.operators.bitext import drop_blank, map_bitext, translation_records
from corpusmix.plans import corpus, prepared
from corpusmix.plans.evaluation import evaluate
from corpusmix.session import STAGE_CODEC, materialize, ship_packages, stage_path
from corpusmix.sources.published import current_version, read_in_order
from corpusmix.sources.readers import read_json_lines, read_prepared, read_source, with_order_key
from corpusmix.sources.recipe import parse_recipe
from corpusmix.sources.sinks import write_json_lines, write_prepared, write_summary

Query = Callable[[SparkSession, str], DataFrame]

TOTAL_BUDGET = 600
CAPPED_ROWS = 1_200
ENTRIES = {entry.name: entry for entry in bindings.RECIPE.entries}


# --- shared inputs -----------------------------------------------------------


def _source(spark: SparkSession, tables: str, name: str) -> DataFrame:
    entry = ENTRIES[name]
    return with_order_key(bindings.load(tables)(spark, entry), entry)


def _pool(spark: SparkSession, tables: str) -> DataFrame:
    return corpus.build_pool(spark, bindings.RECIPE, bindings.load(tables))


def _hashed_pool(spark: SparkSession, tables: str, key: str = "pair") -> DataFrame:
    """The pool with its hashes as a written table, as deduplication looks at it more than once."""
    return materialize(dedup.with_pair_hash(_pool(spark, tables), key), "pool", STAGE_CODEC)


def _unique(spark: SparkSession, tables: str) -> DataFrame:
    """The deduplicated pool as a written table, for queries that read it repeatedly."""
    return materialize(dedup.keep_first(_hashed_pool(spark, tables)), "unique", STAGE_CODEC)


def _mixed(spark: SparkSession, tables: str) -> DataFrame:
    recipe = bindings.RECIPE
    unique = _unique(spark, tables)
    return rebalance.rebalance(unique, recipe.translation_share, recipe.instruction_share)


def _split(spark: SparkSession, tables: str) -> DataFrame:
    return split.stratified_split(_mixed(spark, tables), bindings.RECIPE.eval_size)


def _prepared(spark: SparkSession, tables: str) -> str:
    path = stage_path(spark, "prepared")
    write_prepared(corpus.prepared_rows(_split(spark, tables)), path)
    return path


def _predictions(spark: SparkSession, tables: str) -> DataFrame:
    """Pairs within the budget, with the reversed target as their translation."""
    records = translation_records(
        _source(spark, tables, "document_pairs"), fixed.DIRECTIONS, PatternTokenizer()
    )
    fitted = dedup.with_pair_hash(budget.enforce_budget(records).withColumn("source_ord", F.lit(0)))
    return dedup.keep_first(materialize(fitted, "fitted")).select(
        F.col("pair_hash").alias("row_id"),
        *fixed.FLAT_COLUMNS,
        F.reverse("target_text").alias("hypothesis"),
    )


def _scores(spark: SparkSession, tables: str) -> DataFrame:
    """A score for every pair before the budget, so that some rows match on neither side."""
    records = translation_records(_source(spark, tables, "document_pairs"), fixed.DIRECTIONS)
    source, target = F.length("source_text"), F.length("target_text")
    unique = dedup.with_pair_hash(records).groupBy("pair_hash").agg(
        F.max(F.abs(source - target) * 25.0 / F.greatest(source, target)).alias("prediction")
    )
    return unique.select(F.col("pair_hash").alias("row_id"), F.round("prediction", 6).alias("prediction"))


def _flat(records: DataFrame, *extra: str) -> DataFrame:
    return records.select(*extra, *fixed.FLAT_COLUMNS)


# --- sources and normalisation -----------------------------------------------


def recipe_active_sources(spark: SparkSession, tables: str) -> DataFrame:
    usage = corpus.source_usage(spark, bindings.RECIPE, bindings.load(tables))
    return usage.select(
        F.col("source_ord").cast("bigint").alias("source_ord"),
        "section",
        "dataset_source",
        "usage",
        "rows_available",
        "source_rows_used",
    )


def sources_of_each_format(spark: SparkSession, tables: str) -> DataFrame:
    """All documents, written in every format a recipe can name and read through its entries."""
    documents = bindings.table(spark, tables, "documents").select("doc_id", "text", "lang", "source")
    top = stage_path(spark, "formats")
    kinds = ", ".join(f"{name} {kind}" for name, kind in documents.dtypes)
    entries = {}
    for name in ("parquet", "json", "csv"):
        documents.write.option("header", True).option("escape", '"').format(name).save(f"{top}/{name}")
        entries[name] = {"path": top, "config": name, "format": name, "schema": kinds}
    recipe = parse_recipe({"translation_data": entries})
    read = [read_source(spark, entry).withColumn("format", F.lit(entry.name)) for entry in recipe.entries]
    return reduce(DataFrame.unionByName, read)


def strip_and_blank_filter(spark: SparkSession, tables: str) -> DataFrame:
    """All texts wrapped in several kinds of white space, and rows that are only that."""
    documents = bindings.table(spark, tables, "documents")
    blank = documents.where(F.col("lang") == "fr").withColumn("text", F.lit(""))
    wrapped = documents.unionByName(blank).select(
        "doc_id",
        strip(F.concat(F.lit(" \t　"), F.col("text"), F.lit("  \x1f\n"))).alias("source_text"),
        strip(F.concat(F.lit(" \x85"), F.col("source"))).alias("target_text"),
    )
    return drop_blank(wrapped)


def bitext_column_mapping(spark: SparkSession, tables: str) -> DataFrame:
    """Alternative column names: empty and null ones are passed over, blank ones are taken.

    Every text is there under its second name; further rows have a first name that is taken.
    """
    lang = F.col("lang")
    documents = bindings.table(spark, tables, "documents")
    whole = documents.select(
        "doc_id",
        F.when(lang == "de", F.lit("")).alias("text_en"),
        F.col("text").alias("english"),
        F.lit("").alias("text_cy"),
        F.col("source").alias("welsh"),
    )
    taken = documents.where(lang.isin("en", "es")).select(
        "doc_id",
        F.when(lang == "en", F.lit(" kept ")).alias("text_en"),
        F.col("text").alias("english"),
        F.when(lang == "es", F.lit(" \t ")).otherwise(F.lit("")).alias("text_cy"),
        F.col("source").alias("welsh"),
    )
    candidates = whole.unionByName(taken)
    return drop_blank(map_bitext(candidates), "en_text", "cy_text").select(
        "doc_id", "en_text", "cy_text"
    )


def bitext_json_extract(spark: SparkSession, tables: str) -> DataFrame:
    sides = F.struct(F.col("text").alias("en"), F.col("source").alias("cy"))
    documents = bindings.table(spark, tables, "documents")
    pairs = documents.select("doc_id", F.to_json(sides).alias("translation"))
    return map_bitext(pairs).select("doc_id", "en_text", "cy_text")


def bitext_struct_extract(spark: SparkSession, tables: str) -> DataFrame:
    """All texts, and rows with a null side, which are blank."""
    documents = bindings.table(spark, tables, "documents")
    null = documents.where(F.col("lang") == "de").withColumn("text", F.lit(None).cast("string"))
    documents = documents.unionByName(null)
    sides = F.struct(F.col("text").alias("en"), F.col("source").alias("cy"))
    pairs = map_bitext(documents.select("doc_id", sides.alias("translation")))
    return drop_blank(pairs, "en_text", "cy_text").select("doc_id", "en_text", "cy_text")


def direction_expansion(spark: SparkSession, tables: str) -> DataFrame:
    records = translation_records(_source(spark, tables, "document_pairs"), fixed.DIRECTIONS)
    return _flat(records, "order_key")


def usage_slice_union(spark: SparkSession, tables: str) -> DataFrame:
    """All sources, sliced and normalised, before any length is looked at."""
    pool = corpus.build_pool(spark, bindings.RECIPE, bindings.load(tables), tokenizer=None)
    return _flat(pool, "section", "dataset_source", "order_key")


# --- dictionary ----------------------------------------------------------------


def _dictionary(spark: SparkSession, tables: str) -> DataFrame:
    return dictionary.dictionary_records(_source(spark, tables, "part_terms"), fixed.DIRECTIONS)


def dictionary_translations(spark: SparkSession, tables: str) -> DataFrame:
    records = _dictionary(spark, tables)
    return _flat(records.where(F.col("task") == fixed.TASK_TRANSLATION), "order_key")


def dictionary_instructions(spark: SparkSession, tables: str) -> DataFrame:
    records = _dictionary(spark, tables)
    return _flat(records.where(F.col("task") == fixed.TASK_INSTRUCTION), "order_key")


def dictionary_breakdown(spark: SparkSession, tables: str) -> DataFrame:
    return dictionary.dictionary_breakdown(_dictionary(spark, tables))


# --- conversations ---------------------------------------------------------------


def instruction_from_turns(spark: SparkSession, tables: str) -> DataFrame:
    """One row per turn, as in the given table."""
    turns = bindings.table(spark, tables, "conversations")
    return conversations.turn_table_records(turns, "conv_id", "turn", "role", "text")


def _from_lists(spark: SparkSession, tables: str, column: str, name: str) -> DataFrame:
    chats = bindings.line_turns(spark, tables)
    keyed = chats.withColumn("order_key", F.col("doc_id").cast("string"))
    listed = keyed.withColumnRenamed(column, name)
    records = conversations.instruction_records(listed, "cy")
    return _flat(records, "order_key")


def instruction_from_messages(spark: SparkSession, tables: str) -> DataFrame:
    return _from_lists(spark, tables, "plain", "messages")


def instruction_from_message_parts(spark: SparkSession, tables: str) -> DataFrame:
    return _from_lists(spark, tables, "parts", "messages")


def instruction_from_conversations(spark: SparkSession, tables: str) -> DataFrame:
    return _from_lists(spark, tables, "plain", "conversations")


def instruction_from_flat(spark: SparkSession, tables: str) -> DataFrame:
    entry = ENTRIES["web_pages"]
    records = conversations.instruction_records(
        _source(spark, tables, "web_pages"), entry.language
    )
    return _flat(drop_blank(records), "order_key")


# --- lengths and budget ------------------------------------------------------------


def _bucketed(lengths: DataFrame) -> DataFrame:
    bucket = (
        F.when(F.col("src_len") > fixed.MAX_SOURCE_TOKENS, F.lit("source too long"))
        .when(budget.is_over_limit(), F.lit("over"))
        .otherwise(F.lit("under"))
    )
    return lengths.select(
        "order_key",
        "source_lang_code",
        F.col("src_len").cast("bigint").alias("src_len"),
        F.col("tgt_len").cast("bigint").alias("tgt_len"),
        bucket.alias("bucket"),
    )


def token_lengths_and_buckets(spark: SparkSession, tables: str) -> DataFrame:
    pairs = _source(spark, tables, "document_pairs")
    return _bucketed(translation_records(pairs, fixed.DIRECTIONS, PatternTokenizer()))


class WordTokenizer:
    """A tokenizer object as a caller would bring it, for the Arrow slot."""

    def __init__(self) -> None:
        self.token = regex.compile(TOKEN)

    def encode_batch(self, texts: list[str]) -> list[list[str]]:
        return [self.token.findall(text) for text in texts]

    def decode(self, tokens: list[str]) -> str:
        return "".join(tokens)


def batch_tokenizer_lengths(spark: SparkSession, tables: str) -> DataFrame:
    """The same lengths from a tokenizer object that runs on Arrow batches."""
    ship_packages(spark, corpusmix, catalog)
    pairs = _source(spark, tables, "document_pairs")
    tokenizer = BatchTokenizer(WordTokenizer)
    return _bucketed(translation_records(pairs, fixed.DIRECTIONS, tokenizer))


def budget_truncation(spark: SparkSession, tables: str) -> DataFrame:
    return _flat(_pool(spark, tables), "dataset_source", "over_limit", "order_key")


# --- duplicates ----------------------------------------------------------------------


def budget_of_whole_rows(spark: SparkSession, tables: str) -> DataFrame:
    """The budget for prompt, target and closing together."""
    pool = corpus.build_pool(spark, bindings.RECIPE, bindings.load(tables), tokenizer=None).drop("over_limit")
    fitted = budget.enforce_budget(pool, max_tokens=TOTAL_BUDGET, budget="total")
    return _flat(fitted, "dataset_source", "over_limit", "order_key")


def dedup_keep_first(spark: SparkSession, tables: str) -> DataFrame:
    unique = dedup.keep_first(_hashed_pool(spark, tables))
    return unique.select(
        "pair_hash", "dataset_source", "task", "source_lang_code", "over_limit", "order_key", "copies"
    )


def dedup_pair_and_languages(spark: SparkSession, tables: str) -> DataFrame:
    unique = dedup.keep_first(_hashed_pool(spark, tables, "pair+lang"))
    return unique.select(
        "pair_hash", "dataset_source", "source_lang_code", "target_lang_code", "order_key", "copies"
    )


def dedup_losers(spark: SparkSession, tables: str) -> DataFrame:
    return dedup.duplicate_log(dedup.duplicate_groups(_hashed_pool(spark, tables)))


def duplicates_by_source(spark: SparkSession, tables: str) -> DataFrame:
    groups = dedup.duplicate_groups(_hashed_pool(spark, tables))
    return dedup.duplicate_counts(groups)


# --- mix and split -------------------------------------------------------------------


def rebalance_quotas(spark: SparkSession, tables: str) -> DataFrame:
    recipe = bindings.RECIPE
    counts = rebalance.task_counts(dedup.keep_first(_hashed_pool(spark, tables)))
    quota = rebalance.ratio_quota(recipe.translation_share, recipe.instruction_share)
    return quota(counts)


def rebalance_sample(spark: SparkSession, tables: str) -> DataFrame:
    return _mixed(spark, tables).select("pair_hash", "task", "dataset_source")


def balance_directions(spark: SparkSession, tables: str) -> DataFrame:
    even = rebalance.balance_directions(_unique(spark, tables))
    return even.select("pair_hash", "task", "source_lang_code", "target_lang_code")


def balance_directions_missing_codes(spark: SparkSession, tables: str) -> DataFrame:
    """One source without language codes, and one without a task: codes that are missing are a direction too."""
    unique = _unique(spark, tables)
    again = F.col("dataset_source") == "document_pairs_again"
    code = F.when(~again, F.col("source_lang_code"))
    task = F.when(F.col("dataset_source") != "chats", F.col("task"))
    balanced = rebalance.balance_directions(unique.withColumn("source_lang_code", code).withColumn("task", task))
    return balanced.select("pair_hash", "task", "source_lang_code", "target_lang_code")


def stratified_split_counts(spark: SparkSession, tables: str) -> DataFrame:
    rows = _split(spark, tables)
    return rows.groupBy("stratify_key", "split").agg(F.count("*").alias("rows"))


def stratified_split_rows(spark: SparkSession, tables: str) -> DataFrame:
    return _split(spark, tables).select("pair_hash", "stratify_key", "split")


def stratum_codes(spark: SparkSession, tables: str) -> DataFrame:
    coded = split.with_stratum_code(split.with_stratify_key(_unique(spark, tables)))
    return coded.select("pair_hash", "stratify_key", F.col("stratum_code").cast("bigint").alias("stratum_code"))


# --- reports ---------------------------------------------------------------------------


def source_report(spark: SparkSession, tables: str) -> DataFrame:
    return reports.source_report(_pool(spark, tables))


def recipe_report(spark: SparkSession, tables: str) -> DataFrame:
    usage = corpus.source_usage(spark, bindings.RECIPE, bindings.load(tables))
    return reports.recipe_report(usage, _pool(spark, tables))


def task_totals_and_percentages(spark: SparkSession, tables: str) -> DataFrame:
    return reports.task_totals(_pool(spark, tables))


def direction_counts(spark: SparkSession, tables: str) -> DataFrame:
    return reports.direction_counts(_mixed(spark, tables))


def removed_counts(spark: SparkSession, tables: str) -> DataFrame:
    built = corpus.build_corpus(spark, bindings.RECIPE, bindings.load(tables))
    return built.summary().select(
        "pool_rows",
        "unique_rows",
        "total_rows",
        "duplicates_removed",
        "removed_by_rebalancing",
        "training_split_rows",
        "eval_split_rows",
    )


def _rounded(statistics: DataFrame) -> DataFrame:
    """Floating-point results to six places, so that both engines agree on them."""
    return statistics.select(
        *[
            F.round(name, 6).alias(name) if kind == "double" else F.col(name)
            for name, kind in statistics.dtypes
        ]
    )


def length_statistics(spark: SparkSession, tables: str) -> DataFrame:
    return _rounded(prepared.analyse_lengths(spark, _prepared(spark, tables), "all"))


def length_statistics_train(spark: SparkSession, tables: str) -> DataFrame:
    return _rounded(prepared.analyse_lengths(spark, _prepared(spark, tables), "train"))


def length_statistics_rendered(spark: SparkSession, tables: str) -> DataFrame:
    """Lengths of prompts with their completions."""
    return _rounded(prepared.analyse_lengths(spark, _prepared(spark, tables), "all", rendered=True))


def length_sketches(spark: SparkSession, tables: str) -> DataFrame:
    """Stored sketches per split, source and task, merged, with their quantiles' ranks among the exact lengths.

    ``within`` says that every quantile has a rank within the stated error, and ``exact`` columns need no sketch.
    """
    path, folder = _prepared(spark, tables), stage_path(spark, "length_sketches")
    prepared.write_length_sketches(spark, path, folder)
    stored = spark.read.parquet(folder)
    both = sketches.sketched_statistics(stored, ["task"]).unionByName(
        sketches.sketched_statistics(stored, []).withColumn("task", F.lit("all"))
    )
    points = dict(zip(("median_tokens", "p95_tokens", "p99_tokens", "p99_9_tokens"), fixed.PERCENTILES))
    found = both.select(
        F.col("task").alias("segment"), "samples", F.round("mean_tokens", 6).alias("mean_tokens"), "max_tokens", *points
    )
    lengths = budget.total_lengths(read_prepared(spark, path, "all"))
    tallies = lengths.select(F.explode(F.array("task", F.lit("all"))).alias("segment"), "total_tokens")
    counted = tallies.groupBy("segment", "total_tokens").agg(F.count("*").alias("n"))
    keys = [name for name in found.columns if name not in points]
    below = [F.sum(F.when(F.col("total_tokens") < F.col(p), F.col("n")).otherwise(0)).alias(f"below_{p}") for p in points]
    upto = [F.sum(F.when(F.col("total_tokens") <= F.col(p), F.col("n")).otherwise(0)).alias(f"upto_{p}") for p in points]
    ranked = found.join(counted, "segment").groupBy(*keys).agg(*below, *upto)
    error = sketches.rank_error()
    is_near = [
        (F.col(f"below_{name}") / F.col("samples") - error <= point) & (F.col(f"upto_{name}") / F.col("samples") + error >= point)
        for name, point in points.items()
    ]
    return ranked.select(*keys, reduce(Column.__and__, is_near).alias("within"))


# --- training rows -----------------------------------------------------------------------


def fraction_prefix(spark: SparkSession, tables: str) -> DataFrame:
    rows = read_prepared(spark, _prepared(spark, tables), "train")
    return prepared.prefix(rows, 0.25).select("pair_hash", "order_key")


def prompt_completion(spark: SparkSession, tables: str) -> DataFrame:
    return prepared.training_rows(spark, _prepared(spark, tables))


def prompt_row_cap(spark: SparkSession, tables: str) -> DataFrame:
    """The feature is a row cap: the first rows of the training split."""
    return prepared.training_rows(spark, _prepared(spark, tables), max_rows=CAPPED_ROWS)


def prompt_boundary_check(spark: SparkSession, tables: str) -> DataFrame:
    return prompts.boundary_violations(prompts.render(_pool(spark, tables)))


def checked_pool(spark: SparkSession, tables: str) -> DataFrame:
    return _flat(evaluation.checked_tasks(_pool(spark, tables))).groupBy("task").agg(
        F.count("*").alias("rows")
    )


def packing_plan(spark: SparkSession, tables: str) -> DataFrame:
    return _packed(spark, tables).select(
        "pair_hash",
        F.col("total_tokens").cast("bigint").alias("total_tokens"),
        "start_token",
        "first_block",
        "last_block",
    )


def _packed(spark: SparkSession, tables: str) -> DataFrame:
    lengths = prepared.row_lengths(dedup.keep_first(_hashed_pool(spark, tables)))
    return packing.packing_plan(lengths)


def packing_fill(spark: SparkSession, tables: str) -> DataFrame:
    return packing.block_fill(_packed(spark, tables))


# --- evaluation -------------------------------------------------------------------------


def eval_rows(spark: SparkSession, tables: str) -> DataFrame:
    """The feature is a row cap: the first 20 held-out translation rows."""
    rows = prepared.evaluation_rows(spark, _prepared(spark, tables), "validation", 20)
    return _flat(rows, "row_id")


def metric_input(spark: SparkSession, tables: str) -> DataFrame:
    return evaluation.metric_input(_predictions(spark, tables))


def metric_input_reference_free(spark: SparkSession, tables: str) -> DataFrame:
    return evaluation.metric_input(_predictions(spark, tables), reference_free=True)


def score_join(spark: SparkSession, tables: str) -> DataFrame:
    joined = evaluation.join_scores(_predictions(spark, tables), _scores(spark, tables))
    return joined.select("row_id", "source_lang_code", "target_lang_code", "prediction")


def score_join_unmatched(spark: SparkSession, tables: str) -> DataFrame:
    return evaluation.score_coverage(_predictions(spark, tables), _scores(spark, tables))


def _scored(spark: SparkSession, tables: str) -> DataFrame:
    joined = evaluation.join_scores(_predictions(spark, tables), _scores(spark, tables))
    return materialize(joined.select("source_lang_code", "target_lang_code", "prediction"), "scored")


def direction_scores(spark: SparkSession, tables: str) -> DataFrame:
    return _rounded(evaluation.direction_scores(_scored(spark, tables)))


def overall_scores(spark: SparkSession, tables: str) -> DataFrame:
    return _rounded(evaluation.overall_scores(_scored(spark, tables), "test", "validation"))


def _exploded(summary: DataFrame) -> DataFrame:
    """A summary document as one line per direction, each with the overall figures."""
    names = ("samples", "average_score", "median_score")
    nested = summary.select("*", F.explode("direction_summaries").alias("of")).drop("direction_summaries")
    return _rounded(
        nested.select(
            "split", "requested_split", "evaluated_task", "mode", *names, "of.direction",
            *[F.col(f"of.{name}").alias(f"direction_{name}") for name in names],
        )
    )


def score_summary(spark: SparkSession, tables: str) -> DataFrame:
    """The document of all scores, written and read back."""
    summary = evaluation.score_summary(_scored(spark, tables), "test", "validation")
    path = stage_path(spark, "score_summary")
    write_summary(summary, path)
    return _exploded(spark.read.schema(summary.schema).json(path))


def whole_evaluation(spark: SparkSession, tables: str) -> DataFrame:
    """From the prepared table to the summary of its held-out translations, in blocks of at most 500 rows."""
    ship_packages(spark, corpusmix, catalog)

    def score(rows: DataFrame) -> DataFrame:
        return evaluation.apply_in_batches(rows, LengthGap, _score_batch, "row_id string, prediction bigint")

    summary = evaluate(
        spark,
        _prepared(spark, tables),
        stage_path(spark, "evaluation"),
        lambda rows: rows.withColumn("hypothesis", F.reverse("target_text")),
        score,
        block_rows=500,
    )
    return _exploded(summary)


class LengthGap:
    """A stand-in for a scoring model."""

    def score(self, batch: pd.DataFrame) -> pd.Series:
        return (batch["source"].str.len() - batch["hypothesis"].str.len()).abs().astype("int64")


def _score_batch(model: LengthGap, batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"row_id": batch["row_id"], "prediction": model.score(batch)})


def batch_scorer(spark: SparkSession, tables: str) -> DataFrame:
    """A caller's scoring object over all rows, in Arrow batches."""
    ship_packages(spark, corpusmix, catalog)
    rows = _predictions(spark, tables).select(
        "row_id", F.col("source_text").alias("source"), "hypothesis"
    )
    return evaluation.apply_in_batches(
        rows, LengthGap, _score_batch, "row_id string, prediction bigint"
    )


# --- sinks -----------------------------------------------------------------------------


def json_lines_round_trip(spark: SparkSession, tables: str) -> DataFrame:
    """Pool rows written as JSON lines and read back with their schema."""
    rows = _flat(_source_records(spark, tables))
    path = stage_path(spark, "rows")
    write_json_lines(rows, path)
    return read_json_lines(spark, path, rows.schema)


def shuffled_write(spark: SparkSession, tables: str) -> DataFrame:
    """The prepared table written in seeded random order: the place of every row, from the list of files."""
    path = stage_path(spark, "shuffled")
    write_prepared(corpus.prepared_rows(_split(spark, tables)), path, shuffled=True, rows_per_file=1_000)
    both = [read_in_order(spark, path, name) for name in current_version(spark, path).splits]
    return reduce(DataFrame.unionByName, both).select("split", "row_at", "pair_hash")


def _source_records(spark: SparkSession, tables: str) -> DataFrame:
    return translation_records(_source(spark, tables, "document_pairs"), fixed.DIRECTIONS)


def prepared_round_trip(spark: SparkSession, tables: str) -> DataFrame:
    """The prepared table written by split and read back whole."""
    rows = read_prepared(spark, _prepared(spark, tables), "all")
    return rows.select("pair_hash", "dataset_source", "stratify_key", F.col("split").cast("string").alias("split"))


QUERIES: dict[str, Query] = {
    "q01_recipe_active_sources": recipe_active_sources,
    "q01b_sources_of_each_format": sources_of_each_format,
    "q02_strip_and_blank_filter": strip_and_blank_filter,
    "q03_bitext_column_mapping": bitext_column_mapping,
    "q04_bitext_json_extract": bitext_json_extract,
    "q04b_bitext_struct_extract": bitext_struct_extract,
    "q05_direction_expansion": direction_expansion,
    "q06_usage_slice_union": usage_slice_union,
    "q07_dictionary_translations": dictionary_translations,
    "q08_dictionary_instructions": dictionary_instructions,
    "q09_dictionary_breakdown": dictionary_breakdown,
    "q10_token_lengths_and_buckets": token_lengths_and_buckets,
    "q10b_batch_tokenizer_lengths": batch_tokenizer_lengths,
    "q11_budget_truncation": budget_truncation,
    "q11b_budget_of_whole_rows": budget_of_whole_rows,
    "q12_dedup_keep_first": dedup_keep_first,
    "q12b_dedup_losers": dedup_losers,
    "q12c_duplicates_by_source": duplicates_by_source,
    "q12d_dedup_pair_and_languages": dedup_pair_and_languages,
    "q13_instruction_from_turns": instruction_from_turns,
    "q13b_instruction_from_messages": instruction_from_messages,
    "q13c_instruction_from_message_parts": instruction_from_message_parts,
    "q13d_instruction_from_conversations": instruction_from_conversations,
    "q14_instruction_from_flat": instruction_from_flat,
    "q15_rebalance_quotas": rebalance_quotas,
    "q16_rebalance_sample": rebalance_sample,
    "q16b_balance_directions": balance_directions,
    "q16c_balance_directions_missing_codes": balance_directions_missing_codes,
    "q17_stratified_split_counts": stratified_split_counts,
    "q17b_stratified_split_rows": stratified_split_rows,
    "q17c_stratum_codes": stratum_codes,
    "q18_source_report": source_report,
    "q18b_recipe_report": recipe_report,
    "q19_task_totals_and_percentages": task_totals_and_percentages,
    "q20_direction_counts": direction_counts,
    "q20b_removed_counts": removed_counts,
    "q21_length_statistics": length_statistics,
    "q21b_length_statistics_train": length_statistics_train,
    "q21c_length_statistics_rendered": length_statistics_rendered,
    "q21d_length_sketches": length_sketches,
    "q22_fraction_prefix": fraction_prefix,
    "q23_prompt_completion": prompt_completion,
    "q23b_prompt_boundary_check": prompt_boundary_check,
    "q23c_prompt_row_cap": prompt_row_cap,
    "q24_eval_rows": eval_rows,
    "q25_metric_input": metric_input,
    "q25b_metric_input_reference_free": metric_input_reference_free,
    "q26_score_join": score_join,
    "q26b_score_join_unmatched": score_join_unmatched,
    "q27_direction_scores": direction_scores,
    "q28_overall_scores": overall_scores,
    "q28b_score_summary": score_summary,
    "q28c_whole_evaluation": whole_evaluation,
    "q29_packing_plan": packing_plan,
    "q29b_packing_fill": packing_fill,
    "q30_json_lines_round_trip": json_lines_round_trip,
    "q31_prepared_round_trip": prepared_round_trip,
    "q31b_shuffled_write": shuffled_write,
    "q32_batch_scorer": batch_scorer,
    "q33_checked_tasks": checked_pool,
}
