"""The registered queries of this subpackage. Each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmix.llm import (
    bpe,
    chat,
    collocations,
    decontaminate,
    language,
    licences,
    minhash,
    pii,
    quality,
    repeats,
    spelling,
    token_files,
    url_rules,
)
from corpusmix.llm.common import table
from corpusmix.llm.oracle import ORACLE  # noqa: F401
from corpusmix.session import materialize, stage_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# The rules and the added conversation of the queries' contracts.
URL_RULES = (
    url_rules.Rule("allow", "org", "/"),
    url_rules.Rule("block", "example.org", "/es/"),
    url_rules.Rule("block", "example.org", "/en/1"),
    url_rules.Rule("allow", "com", "/fr/"),
    url_rules.Rule("block", "com", "/de/"),
)
# For test tables only: whoever has the key of real ones can turn their numbers back.
TEST_KEY = "corpusmix"
ADDED_CONVERSATION = -7
ADDED_TEXT = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token_files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(), END_ID)
    return token_files.read_documents(spark, path)


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(ADDED_CONVERSATION).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(materialize(chat.format_conversations(turns), "chats"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    ruled = quality.with_rules(docs).drop("text")
    return quality.judge_ruled(ruled).select("doc_id", "_verdict.*")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_pages(table(spark, sf_dir, "pages"), URL_RULES)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, TEST_KEY, counts="_found_kinds").select("doc_id", "text", "_found_kinds.*")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_digest(licences.find_licences(table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_files": op2_token_files,
    "op3_repeated_strings": op3_repeated_strings,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filters": op7_url_filters,
    "op8_pii": op8_pii,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language_id": op10_language_id,
    "op11_license_scans": op11_license_scans,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_collocations": op13_collocations,
}
