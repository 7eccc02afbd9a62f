"""Frequent phrases by set-oriented mining: relations of occurrences, joined, counted and thinned level by level.

An occurrence relation holds where each frequent phrase of one length starts. Its rows are chunks of
neighbouring texts: one number per place, in the order of the places, 0 where no frequent phrase starts, with
breaks between pieces. Merging a relation with itself at the next place of the same piece gives the occurrences of
phrases one word longer. These are counted per chunk before anything is shuffled, so even the most frequent
phrase is one row per chunk; then counted over all chunks; and only occurrences of frequent ones go
into the next relation. Relations are written tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import corpusmix
from corpusmix.llm.common import map_batches
from corpusmix.session import materialize, ship_packages

# Marks between pieces and blanks between words, by the query's contract.
PIECE_MARKS = r"[.,;:!?\n\x0b\x0c\r]"
NO_LANG = "und"
BREAK = " \n "  # between pieces; no word holds a line break
CHUNK_CHARS = 16_000_000  # in all languages of a task together
CHUNKS = "chunk bigint, lang string, words array<string>, counts array<int>, codes binary"
OCCURRENCES = "chunk bigint, codes binary, ids array<bigint>"
PAIRS = "chunk bigint, `left` bigint, rest bigint, n bigint"
SCORE_ONE = 1_000_000


def _packed(codes: np.ndarray) -> bytes:
    """The numbers of a chunk's places, compressed, with their count in front."""
    return len(codes).to_bytes(8, "little") + pa.compress(codes.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _places(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little") * 4
    return np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), dtype="<u4")


def chunk_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different words of texts, their counts, and the places: 0 for a break, else the word's number from 1."""
    whole = pc.ascii_lower(pa.array([BREAK.join(texts)], pa.large_string()))
    broken = pc.replace_substring(pc.replace_substring_regex(whole, PIECE_MARKS, BREAK), "\t", " ")
    listed = pc.split_pattern(broken, " ").flatten().dictionary_encode()
    found, at = listed.dictionary.to_pylist(), listed.indices.to_numpy()
    is_word = np.array([word not in ("", "\n") for word in found], dtype=bool)
    number = np.where(is_word, np.cumsum(is_word), 0)
    filled = np.array([word != "" for word in found], dtype=bool)
    codes = number[at[filled[at]]]
    return [w for w in found if w not in ("", "\n")], np.bincount(codes, minlength=int(is_word.sum()) + 1)[1:], codes


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of one language each, of about so many characters."""
    chunk = TaskContext.get().partitionId() << 32
    waiting: dict[str, list[str]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal chunk, size
        for lang, texts in sorted(waiting.items()):
            words, counts, codes = chunk_words(texts)
            if words:
                values = [[chunk], [lang], [words], [counts.tolist()], [_packed(codes)]]
                kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary())
                names = ["chunk", "lang", "words", "counts", "codes"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)
                chunk += 1
        waiting.clear()
        size = 0

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            waiting.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHUNK_CHARS:
                yield from flush()
    yield from flush()


def adjacent_pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of phrases at a place and at the next one, as one number each, and where they are."""
    at = np.flatnonzero((codes[:-1] != 0) & (codes[1:] != 0))
    return (codes[at].astype(np.uint64) << np.uint64(32)) | codes[at + 1].astype(np.uint64), at


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The relation merged with itself at adjacent places, counted per chunk."""
    for batch in batches:
        for chunk, data, ids in zip(*[batch.column(k) for k in range(3)]):
            number = ids.values.to_numpy()
            pairs, times = np.unique(adjacent_pairs(_places(data.as_py()))[0], return_counts=True)
            left = number[(pairs >> np.uint64(32)).astype(np.int64) - 1]
            rest = number[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1]
            columns = [np.full(len(pairs), chunk.as_py(), np.int64), left, rest, times.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chunk", "left", "rest", "n"])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy()


def _occurrences(chunk: int, codes: np.ndarray, ids: np.ndarray) -> pa.Table:
    kinds = pa.schema([("chunk", pa.int64()), ("codes", pa.binary()), ("ids", pa.list_(pa.int64()))])
    return pa.table([pa.array(v, k) for v, k in zip(([chunk], [_packed(codes)], [ids]), kinds.types)], schema=kinds)


def _renumbered(chunk: pa.Table, known: pa.Table) -> pa.Table:
    """A chunk's places of frequent words (``at``, their number in the chunk, and ``id``)."""
    codes, at, ids = _places(chunk["codes"][0].as_py()), _column(known, "at"), _column(known, "id")
    number = np.zeros(max(int(codes.max()), int(at.max(initial=0)) + 1) + 1, np.uint32)
    number[at + 1] = np.arange(1, len(at) + 1)
    return _occurrences(chunk["chunk"][0].as_py(), number[codes], ids)


def _extended(chunk: pa.Table, found: pa.Table) -> pa.Table:
    """A chunk's places of frequent longer phrases: those of its adjacent pairs that are among the frequent ones."""
    codes, ids = _places(chunk["codes"][0].as_py()), chunk["ids"][0].values.to_numpy()
    order = np.argsort(ids)
    sides = [order[np.searchsorted(ids[order], _column(found, name))].astype(np.uint64) + 1 for name in ("left", "rest")]
    frequent = (sides[0] << np.uint64(32)) | sides[1]
    by_pair = np.argsort(frequent)
    pairs, at = adjacent_pairs(codes)
    slot = np.searchsorted(frequent[by_pair], pairs)
    slot[slot == len(frequent)] = 0
    longer = np.zeros(len(codes), np.uint32)
    if len(frequent):
        hit = frequent[by_pair][slot] == pairs
        longer[at[hit]] = slot[hit] + 1
    return _occurrences(chunk["chunk"][0].as_py(), longer, _column(found, "id")[by_pair])


def _with_each_chunk(
    chunks: DataFrame, rows: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table]
) -> DataFrame:
    """``function`` of each chunk and its rows; a chunk without rows is left out, as it holds nothing frequent."""
    ship_packages(chunks.sparkSession, corpusmix)

    def run(chunk: pa.Table, own: pa.Table) -> pa.Table:
        return function(chunk, own) if own.num_rows else _occurrences(0, np.zeros(0), np.zeros(0)).slice(1)

    # Both come from one table, so the key of the second gets another name.
    own = rows.withColumnRenamed("chunk", "of_chunk").groupBy("of_chunk")
    return chunks.groupBy("chunk").cogroup(own).applyInArrow(run, OCCURRENCES)


def _word_occurrences(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """The first relation, of frequent words; all others become 0."""
    local = chunks.select("chunk", "lang", F.posexplode("words").alias("at", "phrase"))
    known = local.join(words.select("lang", "phrase", "id"), ["lang", "phrase"]).select("chunk", "at", "id")
    return _with_each_chunk(chunks.select("chunk", "codes"), known, _renumbered)


def _thinned(places: DataFrame, least: int) -> DataFrame:
    """``chunk, left, rest, a, id``: where phrases one word longer are frequent, dealt and sorted by phrase.

    A phrase is one row per chunk here. So its rows are few beside all others, and counting them and leaving out
    the infrequent ones take one pass; ``id`` is the number of the phrase's first row.
    """
    dealt = map_batches(places, _joined, PAIRS).repartition("left", "rest")
    phrase = Window.partitionBy("left", "rest")
    counted = dealt.withColumn("at", F.monotonically_increasing_id()).select(
        "chunk", "left", "rest", F.sum("n").over(phrase).alias("a"), F.min("at").over(phrase).alias("id")
    )
    return counted.where(F.col("a") >= least)


def frequent_phrases(docs: DataFrame, most_words: int = 3, least: int = 10) -> tuple[list[DataFrame], DataFrame]:
    """Per length the frequent phrases, and ``lang, n``: how many words each language has.

    Phrases have ``id, lang, phrase, last, a, heads, tails``, and from two words on ``left`` and ``rest``, the
    phrases without the last and without the first word: ``a`` counts the phrase, ``heads`` its
    beginnings from one word on, ``tails`` its ends from the whole phrase on.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = materialize(map_batches(texts, _cut, CHUNKS), "phrase_chunks")
    sizes = chunks.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (x, y) -> x + y)")).alias("n"))
    local = chunks.select("lang", F.inline(F.arrays_zip("words", "counts")))
    counted = local.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("a"))
    words = counted.where(F.col("a") >= least).withColumn("id", F.monotonically_increasing_id())
    one = F.array("a")
    words = words.select("id", "lang", "phrase", F.col("phrase").alias("last"), "a", one.alias("heads"), one.alias("tails"))
    levels = [materialize(words, "phrases_1")]
    places = materialize(_word_occurrences(chunks, levels[0]), "places_1")
    for length in range(2, most_words + 1):
        if length == most_words:
            pairs = map_batches(places, _joined, PAIRS)
            totals = pairs.groupBy("left", "rest").agg(F.sum("n").alias("a"))
            frequent = totals.where(F.col("a") >= least).withColumn("id", F.monotonically_increasing_id())
        else:
            kept = materialize(_thinned(places, least), f"occurrences_{length}")
            found = kept.select("chunk", "left", "rest", "id")
            places = materialize(_with_each_chunk(places, found, _extended), f"places_{length}")
            frequent = kept.groupBy("left", "rest").agg(F.min("a").alias("a"), F.min("id").alias("id"))
        levels.append(materialize(_spelt(frequent, levels[-1]), f"phrases_{length}"))
    return levels, sizes


def _spelt(frequent: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases made of two shorter ones that overlap, with their words and the counts of their parts."""
    left = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), "heads")
    rest = shorter.select(F.col("id").alias("rest"), "last", "tails")
    return frequent.join(left, "left").join(rest, "rest").select(
        "id",
        "lang",
        F.concat_ws(" ", "begin", "last").alias("phrase"),
        "last",
        "a",
        F.concat("heads", F.array("a")).alias("heads"),
        F.concat(F.array("a"), "tails").alias("tails"),
        "left",
        "rest",
    )


def _lowest_cut(words: int) -> Column:
    """``score, k, l, r`` of the cut with the lowest score; products are exact decimals of up to 38 digits."""

    def cut(k: int) -> str:
        head, tail = f"heads[{k - 1}]", f"tails[{k}]"
        x, y, a = (f"cast({name} as decimal(15, 0))" for name in (head, tail, "a"))
        score = f"(cast({SCORE_ONE} as decimal(7, 0)) * ({a} * {a})) div ({x} * {y})"
        return f"named_struct('score', {score}, 'k', {k}, 'l', {head}, 'r', {tail})"

    cuts = [cut(k) for k in range(1, words)]
    return F.expr(cuts[0] if len(cuts) == 1 else f"least({', '.join(cuts)})")


def _within_reach(scored: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The rows of each language that can be among its first ``top`` by ``keys``, the largest first.

    Rows are counted per key first, so no task ranks all phrases of a language: there are a million
    scores, and counts are looked at only among the rows of the score at which the list ends.
    """
    counts = scored.groupBy("lang", *keys).agg(F.count("*").alias("rows"))
    order = Window.partitionBy("lang").orderBy(*[F.desc(key) for key in keys])
    reached = counts.withColumn("before", F.sum("rows").over(order) - F.col("rows")).where(F.col("before") < top)
    least = reached.groupBy("lang").agg(F.min(F.struct(*keys)).alias("least"))
    return scored.join(least, "lang").where(F.struct(*keys) >= F.col("least")).drop("least")


def collocations(
    docs: DataFrame, most_words: int = 3, least: int = 10, covering: int = 50, top: int = 2000
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two words or more of each language.

    ``docs`` has ``text`` and ``lang``; a null lang is ``und``, a null or empty text has no words, and
    repeated rows count as often as they are there. A phrase has at least ``least`` occurrences. It is left out if a longer
    one that holds it has at least ``covering`` percent of them. The score is the lowest over all cuts of a million
    times a * a / (l * r), rounded down, where the two parts occur l and r times; of equal cuts the first counts.
    Ties in score go to the more frequent phrase, then to the first in the order of UTF-8 bytes.
    """
    if most_words < 2:
        raise ValueError("a phrase has two words at least")
    levels, sizes = frequent_phrases(docs, most_words, least)
    parts = []
    for words, level in enumerate(levels[1:], start=2):
        if words < most_words:
            longer = levels[words]
            holders = longer.select(F.col("left").alias("id"), F.col("a").alias("held")).unionByName(
                longer.select(F.col("rest").alias("id"), F.col("a").alias("held"))
            )
            most = holders.groupBy("id").agg(F.max("held").alias("held"))
            covered = F.coalesce(F.col("held"), F.lit(0)) * 100 >= F.col("a") * covering
            level = level.join(most, "id", "left").where(~covered)
        parts.append(level.select("lang", "phrase", "a", _lowest_cut(words).alias("cut")))
    scored = reduce(DataFrame.unionByName, parts).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    scored = materialize(scored, "phrase_scores")
    for keys in (["score"], ["score", "a"]):
        scored = _within_reach(scored, keys, top)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
