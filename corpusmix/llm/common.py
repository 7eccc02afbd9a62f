"""What several operators of this subpackage share."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import corpusmix
from corpusmix.session import ship_packages

# The characters that separate words, as the contracts of the queries state them.
WORD_BREAKS = "\t\n\x0b\x0c\r "
WORD_BREAK_CLASS = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many further underscores in front as it takes to be no column of ``df``, in either case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` with this package at hand in the Python workers."""
    ship_packages(df.sparkSession, corpusmix)
    return df.mapInArrow(function, schema)


class Memo:
    """Values of words that come again, in two generations of at most ``limit`` words each.

    When the younger is full it becomes the older one, whose words move up as they are
    met, so frequent words stay and memory is bounded. ``make`` gives the values of many
    words at once. Words above ``longest`` characters are not kept.
    """

    def __init__(self, make: Callable[[list[str]], list], limit: int = 400_000, longest: int = 64):
        self.make, self.limit, self.longest = make, limit, longest
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def values(self, words: list[str]) -> list:
        got = list(map(self.young.get, words))
        if None not in got:
            return got
        missing = {word for word, value in zip(words, got) if value is None}
        found = {word: self.old[word] for word in missing if word in self.old}
        rest = [word for word in missing if word not in found]
        found.update(zip(rest, self.make(rest)))
        self.young.update((w, v) for w, v in found.items() if len(w) <= self.longest)
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        return [found[w] if v is None else v for w, v in zip(words, got)]


def lowered(text: str) -> str | None:
    """``text`` in lower case where that changes nothing for a tokenizer that composes
    characters and lower-cases them one by one, as it does itself; else None."""
    if "<|" in text:
        return None
    low = text.replace("Σ", "σ").lower()
    composed = unicodedata.is_normalized
    return low if composed("NFC", text) and composed("NFC", low) else None


class WordIds:
    """Ids of whole texts, put together from those of their words.

    ``make`` gives the little-endian 32-bit ids of new words. The words of many texts are
    told apart by a dictionary of Arrow first, so each different word is looked up once.
    Marks at the end of a word become a word of their own, as tokenizers cut there
    anyway; texts that may hold added tokens stay as they are.
    """

    ENDING = r"([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~]+) "

    def __init__(self, make: Callable[[list[str]], list[bytes]]):
        self.memo = Memo(make)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ready, plain = [], []
        for text in texts:
            low = lowered(text)
            plain.append(low is not None)
            safe = text if low is None else low
            ready.append(safe.replace("\n", " ").replace("\t", " ").replace("\r", " "))
        whole = pa.array(ready, pa.large_string())
        apart = pc.replace_substring_regex(whole, self.ENDING, r"\1 \2 ")
        split = pc.split_pattern(pc.if_else(pa.array(plain), apart, whole), " ")
        words = split.flatten().dictionary_encode()
        known = pa.array(self.memo.values(words.dictionary.to_pylist()), pa.large_binary())
        taken = known.take(words.indices)
        ends, data = taken.buffers()[1:]
        ids = np.frombuffer(data or b"", dtype="<u4")
        bounds = np.frombuffer(ends, dtype=np.int64)[split.offsets.to_numpy()] // 4
        return np.split(ids[: bounds[-1]], bounds[1:-1])


def slices(texts: list[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """Neighbouring texts together, of about so many characters."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part
