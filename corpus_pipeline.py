"""Five stages from raw documents to token ids, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmix.llm import bpe, decontaminate, minhash, pii, quality
from corpusmix.llm.common import table
from corpusmix.llm.queries import TEST_KEY, tokenizer_path
from corpusmix.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and come from a host that does."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the least id; every row is judged by its own text."""
    return minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data under pseudonyms; ``n_chars`` follows the new text.

    The key comes from the setting ``spark.corpusmix.pii.key``; without one, as in tests, it is that of the queries.
    """
    made = pii.pseudonymise(docs, spark.conf.get("spark.corpusmix.pii.key", TEST_KEY))
    length = F.length("text").cast(made.schema["n_chars"].dataType)
    return made.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each text's ids and of the text decoded from them."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pseudonyms),
    ("bpe", bpe_round_trip),
]

# Byte-pair encoding and alignment with edits are not for SQL; tests hold run() against plain Python of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
