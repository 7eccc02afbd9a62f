"""Duplicate pairs: the earliest copy stays, every dropped one is logged with its winner."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.functions.frames import emit_copies
from corpusmix.functions.text import pair_hash

# The place of a row in the pool: source, then cut rows last, then the seeded
# order of input rows, then the order of the records one input row gave.
PLACE = ("source_ord", "over_limit", "order_key", "emit_ord")
REPEAT_BITS = 2**27
KEYS = {
    "pair": ("source_text", "target_text"),
    "pair+lang": ("source_text", "target_text", "source_lang_code", "target_lang_code"),
}


def with_pair_hash(pool: DataFrame, key: str = "pair") -> DataFrame:
    """Add the key of duplicates: the texts (``pair``), or these with their languages (``pair+lang``)."""
    if key not in KEYS:
        raise ValueError(f"key must be one of {', '.join(KEYS)}, not {key!r}")
    return pool.withColumn("pair_hash", pair_hash(*map(F.col, KEYS[key])))


def may_repeat(pool: DataFrame) -> DataFrame:
    """Add ``_again``: false only for rows whose pair is surely there once.

    Pairs are counted by their hash alone, which sorts nothing. Those that are there twice or more set
    one of 2 ** 27 bits each, kept as at most 2 ** 21 words of 64 bits, which is what is sent to every task whatever
    the size of the pool. A pair that shares its bit with another one just goes the longer way.
    """
    counts = pool.groupBy("pair_hash").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    bit = F.pmod(F.xxhash64("pair_hash"), F.lit(REPEAT_BITS).cast("bigint"))
    one = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    words = (
        counts.select(bit.alias("_bit"))
        .select(F.expr("shiftright(_bit, 6)").alias("_word"), one.alias("_one"))
        .groupBy("_word")
        .agg(F.bit_or("_one").alias("_bits"))
    )
    placed = pool.withColumn("_bit", bit).withColumn("_at", F.expr("shiftright(_bit, 6)"))
    joined = placed.join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    again = F.coalesce(F.col("_bits").bitwiseAND(one) != 0, F.lit(False))
    return joined.withColumn("_again", again).drop("_bit", "_at", "_word", "_bits")


def keep_first(pool: DataFrame) -> DataFrame:
    """One row per pair, the one that comes first in the pool, with ``copies``.

    Rows whose pair is there once, most of them, stay where they are. The others take a
    minimum that carries the row itself, so there is no join back, and copies meet before the
    shuffle, so a pair that makes up a large part of the pool sends one row per task.
    """
    flagged = may_repeat(pool)
    carried = [name for name in pool.columns if name not in (*PLACE, "pair_hash")]
    single = flagged.where(~F.col("_again")).select(
        "pair_hash", *PLACE, *carried, F.lit(1).cast("bigint").alias("copies")
    )
    first = F.min(F.struct(*PLACE, *carried)).alias("first")
    chosen = (
        flagged.where("_again")
        .groupBy("pair_hash")
        .agg(first, F.count("*").alias("copies"))
        .select("pair_hash", "first.*", "copies")
    )
    return single.unionByName(chosen)


def duplicate_groups(pool: DataFrame) -> DataFrame:
    """``hash, source, winner, dropped`` for every pair of which a source lost copies.

    Copies are counted per pair and source first. The window then sees one line
    per source of a pair, never the copies.
    """
    place = F.min(F.struct(*PLACE)).alias("place")
    counted = pool.groupBy("pair_hash", "dataset_source").agg(place, F.count("*").alias("n"))
    same_pair = Window.partitionBy("pair_hash")
    winner = F.min(F.struct("place", "dataset_source")).over(same_pair)["dataset_source"]
    judged = counted.withColumn("winner", winner)
    kept = F.when(F.col("dataset_source") == F.col("winner"), 1).otherwise(0)
    return judged.select(
        F.col("pair_hash").alias("hash"),
        F.col("dataset_source").alias("source"),
        "winner",
        (F.col("n") - kept).alias("dropped"),
    ).where(F.col("dropped") > 0)


def duplicate_log(groups: DataFrame) -> DataFrame:
    """One ``source, winner, hash`` line per dropped row."""
    return emit_copies(groups, "dropped").select("source", "winner", "hash")


def duplicate_counts(groups: DataFrame) -> DataFrame:
    """Dropped rows per losing and winning source."""
    return groups.groupBy("source", "winner").agg(F.sum("dropped").alias("dropped"))
