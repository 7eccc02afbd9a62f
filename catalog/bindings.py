"""How the given tables stand in for bilingual sources.

Every view covers its whole table. The language codes are roles here: the two
sides of a pair are called English and Welsh whatever they hold.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmix.operators.conversations import turn_table_records
from corpusmix.sources.recipe import SourceEntry, parse_recipe

RECIPE = parse_recipe(
    {
        "translation_data": {
            "document_pairs": {
                "path": "bitext",
                "usage": 1.0,
                "directions": ["en-cy", "cy-en"],
                "id_columns": ["pair_id"],
            },
            "document_pairs_again": {
                "path": "bitext",
                "usage": 0.35,
                "directions": ["cy_en"],
                "id_columns": ["pair_id"],
            },
            "left_out": {"path": "bitext", "usage": 0, "id_columns": ["pair_id"]},
        },
        "dictionary_data": {
            "part_terms": {
                "path": "dictionary",
                "usage": 1.0,
                "directions": ["en-cy", "cy-en"],
                "id_columns": ["p_partkey"],
            }
        },
        "instruction_data": {
            "chats": {"path": "chats", "language": "en", "id_columns": ["conv_id"]},
            "web_pages": {"path": "pages", "language": "cy", "usage": 1.0, "id_columns": ["page_id"]},
            "texts_en": {"path": "texts", "config": "en", "language": "en", "id_columns": ["doc_id"]},
            "texts_fr": {"path": "texts", "config": "fr", "language": "fr", "id_columns": ["doc_id"]},
            "texts_de": {"path": "texts", "config": "de", "language": "de", "id_columns": ["doc_id"]},
            "texts_es": {"path": "texts", "config": "es", "language": "es", "id_columns": ["doc_id"]},
            "texts_other": {"path": "texts", "config": "other", "language": "und", "id_columns": ["doc_id"]},
        },
        "meta_strategy": {"target_ratio": "70:30", "eval_size": 0.05, "max_seq_len": 2048},
    }
)


NAMED = ("en", "fr", "de", "es")


@lru_cache(maxsize=64)
def table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per session."""
    return spark.read.parquet(f"{tables}/{name}.parquet")


def bitext(spark: SparkSession, tables: str) -> DataFrame:
    """Documents 2p and 2p+1 are the two sides of pair p."""
    documents = table(spark, tables, "documents")
    side = F.expr("doc_id % 2")
    return documents.groupBy(F.expr("doc_id div 2").alias("pair_id")).agg(
        F.max(F.when(side == 0, F.col("text"))).alias("text_en"),
        F.max(F.when(side == 1, F.col("text"))).alias("text_cy"),
    )


def dictionary(spark: SparkSession, tables: str) -> DataFrame:
    """Parts as a term dictionary with missing definitions and contexts of each kind."""
    size = F.col("p_size")
    return table(spark, tables, "part").select(
        "p_partkey",
        F.col("p_name").alias("Saesneg"),
        F.when(size == 7, F.lit("None")).otherwise(F.col("p_brand")).alias("Cymraeg"),
        F.when(size > 40, F.lit(" null ")).otherwise(F.col("p_type")).alias("Diffiniad Saesneg"),
        F.when(size < 10, F.lit("None"))
        .when(size < 20, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("maint "), size))
        .alias("Diffiniad Cymraeg"),
        F.when(size > 25, F.concat(F.lit(" size "), size)).alias("Cyd-destun Saesneg"),
        F.when(F.col("p_type") != "SMALL", F.lower("p_type")).alias("Cyd-destun Cymraeg"),
    )


def chats(spark: SparkSession, tables: str) -> DataFrame:
    """Conversations, one row per turn in the table, as questions and answers."""
    turns = table(spark, tables, "conversations")
    return turn_table_records(turns, "conv_id", "turn", "role", "text").select(
        "conv_id",
        F.col("source_text").alias("instruction"),
        F.col("target_text").alias("output"),
    )


def pages(spark: SparkSession, tables: str) -> DataFrame:
    return table(spark, tables, "pages").select(
        "page_id", F.col("url").alias("prompt"), F.col("html").alias("completion")
    )


def texts(spark: SparkSession, tables: str, language: str) -> DataFrame:
    """Documents of one language, or of no named one: the first line asks for the whole text."""
    named = F.coalesce(F.col("lang").isin(*NAMED), F.lit(False))
    wanted = ~named if language == "other" else F.col("lang") == language
    documents = table(spark, tables, "documents").where(wanted)
    return documents.select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("instruction"),
        F.col("text").alias("response"),
    )


def line_turns(spark: SparkSession, tables: str) -> DataFrame:
    """Documents as chats: each line is a turn, and roles follow the line's length.

    ``messages`` has plain contents, ``parts`` has each content as two parts.
    A document in French has no list at all, so its flat columns are used.
    """
    documents = table(spark, tables, "documents")
    lines = F.split("text", "\n")

    def role(line):
        kind = F.length(line) % 4
        return (
            F.when(kind == 0, F.lit("Assistant"))
            .when(kind == 1, F.lit("human"))
            .when(kind == 2, F.lit("User"))
            .otherwise(F.lit("system"))
        )

    listed = F.col("lang") != "fr"
    plain = F.transform(
        lines, lambda line: F.struct(role(line).alias("role"), line.alias("content"))
    )
    parts = F.transform(
        lines,
        lambda line: F.struct(
            role(line).alias("role"),
            F.array(
                F.struct(F.substring(line, 1, 10).alias("text")),
                F.struct(F.substr(line, F.lit(11)).alias("text")),
            ).alias("content"),
        ),
    )
    return documents.select(
        "doc_id",
        F.when(listed, plain).alias("plain"),
        F.when(listed, parts).alias("parts"),
        F.col("source").alias("input"),
        F.col("text").alias("output"),
    )


def load(tables: str):
    """A loader for the recipe above: its paths are the views of this module."""

    def loader(spark: SparkSession, entry: SourceEntry) -> DataFrame:
        if entry.path == "texts":
            return texts(spark, tables, entry.config)
        view = {"bitext": bitext, "dictionary": dictionary, "chats": chats, "pages": pages}
        return view[entry.path](spark, tables)

    return loader
