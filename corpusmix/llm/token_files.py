"""Token ids as Simple-8b words in a table of blocks, in ascending order of documents.

A 64-bit word has a 4-bit selector at the top. Selectors 1 to 14 say how many ids
the other 60 bits hold and how wide they are; selector 0 is an escape: the next
word is one id as it is, of any width. Ids are packed in runs of ``RUN_IDS``, and
the word at which each run starts is stored, so any run is decoded alone and all
words of one selector are decoded by the same few array operations.

The file format is a Parquet table with one row per block of whole documents
(``shard, block, doc_ids, lengths, offset, words, run_starts``), next to a small
table with the number of ids before each shard. Spark's commit protocol makes the
files complete when a task is repeated or an executor is lost.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmix.llm.common import WordIds, map_batches, slices

# (ids in a word, bits of each), by selector from 1.
LAYOUTS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 0
RUN_IDS = 2048
BLOCK_IDS = 65_536

BLOCK_SCHEMA = (
    "shard int, block long, offset long, doc_ids array<bigint>, lengths array<bigint>, "
    "words binary, run_starts array<int>"
)
DOC_SCHEMA = "shard int, doc_id bigint, inside long, n_tokens long, ids_crc32 long"

_COUNTS = np.array([1] + [n for n, _ in LAYOUTS], dtype=np.int64)
_SELECTOR_OF = {n: s for s, (n, _) in enumerate(LAYOUTS, 1)}
_MOST_WITHIN = np.array([max([n for n, _ in LAYOUTS if n <= left], default=1) for left in range(61)], np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, 1 at least and 64 at most."""
    widths = np.maximum(np.frexp(ids.astype(np.float64))[1], 1).astype(np.uint8)
    for at in np.flatnonzero(ids >= np.uint64(1 << 53)).tolist():  # beyond exact doubles
        widths[at] = int(ids[at]).bit_length()
    return widths


def _packed_counts(widths: np.ndarray) -> np.ndarray:
    """How many ids the word that starts at each position takes; 0 is an escape."""
    size = len(widths)
    best = np.ones(size, dtype=np.uint8)
    padded = np.concatenate([widths, np.zeros(64, np.uint8)])
    windows = {1: padded}  # the widest of so many ids from each position on
    for n, bits in reversed(LAYOUTS[:-1]):
        window, filled = padded, 1
        while filled < n:
            step = max(k for k in windows if k <= n - filled)
            further = windows[step][filled:]
            window = np.maximum(window[: len(further)], further)
            filled += step
        fits = window[:size] <= bits
        if not fits.any():
            break
        best[fits] = n
        windows[n] = window
    best[widths > 60] = 0
    # A run ends a word; with fewer ids left, a layout of fewer and wider ids fits too.
    left = RUN_IDS - np.arange(size) % RUN_IDS
    left = np.minimum(left, size - np.arange(size))
    return np.minimum(best, _MOST_WITHIN[np.minimum(left, 60)])


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``ids`` (unsigned 64-bit), and the word at which each run of ids starts."""
    ids = np.asarray(ids, dtype=np.uint64)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    counts = _packed_counts(_bits(ids))
    chain, position, steps, end = [], 0, np.maximum(counts, 1).tolist(), len(ids)
    append = chain.append
    while position < end:
        append(position)
        position += steps[position]
    first = np.array(chain, dtype=np.int64)
    taken = counts[first]
    size = np.where(taken == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), dtype=np.uint64)
    for n in np.unique(taken).tolist():
        here = np.flatnonzero(taken == n)
        source, target = first[here], place[here]
        if n == 0:
            words[target] = np.uint64(ESCAPE)
            words[target + 1] = ids[source]
            continue
        selector = _SELECTOR_OF[n]
        bits = LAYOUTS[selector - 1][1]
        word = np.full(len(here), selector << 60, dtype=np.uint64)
        for k in range(n):
            word |= ids[source + k] << np.uint64(k * bits)
        words[target] = word
    return words, place[first % RUN_IDS == 0].astype(np.int32)


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids of whole words, of one run or of many in a row."""
    words = np.asarray(words, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    escapes = np.flatnonzero(selectors == ESCAPE)
    raw = np.zeros(len(words), dtype=bool)
    if len(escapes):
        for at in escapes.tolist():
            if not raw[at]:
                raw[at + 1] = True
        selectors[raw] = 1
    counts = _COUNTS[selectors]
    counts[raw] = 0
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for selector in np.unique(selectors[~raw]).tolist():
        here = np.flatnonzero((selectors == selector) & ~raw)
        if selector == ESCAPE:
            out[place[here]] = words[here + 1]
            continue
        n, bits = LAYOUTS[selector - 1]
        shifts = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        values = (words[here, None] >> shifts) & np.uint64((1 << bits) - 1)
        out[place[here, None] + np.arange(n)] = values
    return out


def unpack_range(words: np.ndarray, run_starts: np.ndarray, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (excluded), decoding only the runs that hold them."""
    if first >= last:
        return np.zeros(0, np.uint64)
    low, high = first // RUN_IDS, (last - 1) // RUN_IDS + 1
    end = run_starts[high] if high < len(run_starts) else len(words)
    ids = unpack(words[run_starts[low] : end])
    return ids[first - low * RUN_IDS : last - low * RUN_IDS]


class LibraryEncoder:
    """Ids of a text by the ``tokenizers`` library, each distinct word encoded once.

    Only for tokenizers that drop white space and end words, as the one of the query
    does, and part words from marks: there a text's ids are those of its words, one after another.
    Words of letters only are encoded many at a time, as one text, and told apart by
    their end tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, token_id in vocabulary.items():
            self.ends[token_id] = token.endswith("</w>")
        self.encode = WordIds(self._encode_words).encode

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4") for one in encoded]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        plain = [w for w in words if w.isalpha() and unicodedata.is_normalized("NFC", w)]
        made: dict[str, bytes] = {}
        if plain:
            ids = self._ids([" ".join(plain)])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain):
                data = ids.tobytes()
                ends = (cuts * 4).tolist()
                made = {w: data[a:b] for w, a, b in zip(plain, [0, *ends], ends)}
        rest = [w for w in words if w not in made]
        if rest:
            made.update(zip(rest, (one.tobytes() for one in self._ids(rest))))
        return [made[w] for w in words]


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> Callable[[list[str]], list[np.ndarray]]:
    """The encoder of a worker process, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path].encode


def _blocks(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4")
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        size = block = offset = 0

        def closed() -> pa.RecordBatch:
            nonlocal size, block, offset
            ids = np.concatenate(parts)
            words, starts = pack(ids)
            batch = pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([block], pa.int64()),
                    "offset": pa.array([offset], pa.int64()),
                    "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                    "lengths": pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                    "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    "run_starts": pa.array([starts], pa.list_(pa.int32())),
                }
            )
            block, offset, size = block + 1, offset + len(ids), 0
            doc_ids.clear()
            parts.clear()
            return batch

        for batch in batches:
            ids = chain.from_iterable(map(encode, slices(batch.column(1).to_pylist())))
            for doc_id, encoded in zip(batch.column(0).to_pylist(), ids):
                part = np.concatenate([encoded, end])
                doc_ids.append(doc_id)
                parts.append(part)
                size += len(part)
                if size >= BLOCK_IDS:
                    yield closed()
        if parts:
            yield closed()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole text and write the ids under ``path`` in ascending doc_id order.

    ``docs`` has ``doc_id`` and ``text``; other columns are left aside. A null text counts
    as empty and has only the end id. Null doc_ids come first; rows of one doc_id are
    ordered by their texts, and each is written. One shuffle deals the texts out by
    ranges of doc_id; they are encoded after it, so no text is encoded twice.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = plain.repartitionByRange(
        shards, F.col("doc_id"), F.xxhash64("text")
    ).sortWithinPartitions("doc_id", "text")
    map_batches(ordered, _blocks(tokenizer, end_id), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    written = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    totals = written.groupBy("shard").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("ids")
    )
    # One line per shard, of which there are as many as partitions.
    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")
    totals.select("shard", before.alias("base")).coalesce(1).write.parquet(f"{path}/shards")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.array(row["lengths"], dtype=np.int64)
            ids = unpack(np.frombuffer(row["words"], dtype="<u8")).astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([row["shard"]] * len(lengths), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "inside": pa.array(starts + row["offset"], pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files under ``path``."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    shards = spark.read.schema("shard int, base long").parquet(f"{path}/shards")
    decoded = map_batches(blocks, _documents, DOC_SCHEMA)
    return decoded.join(shards, "shard").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
