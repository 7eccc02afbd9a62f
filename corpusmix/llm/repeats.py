"""Removal of byte strings that occur earlier, exactly, with suffix arrays of bounded parts.

A string of ``LENGTH`` bytes is found by its anchor: the least of its ``GRAM``-byte
substrings by hash, the leftmost of equal ones. Equal strings have equal anchors at equal places,
so only strings of one anchor need comparing. Neighbouring strings of one anchor are one
segment; segments whose anchor occurs nowhere else are left after one shuffle of narrow rows.

A string holds half of its other bytes on the left of its anchor or on the right, so a segment
is two pieces, each keyed by the bytes that all its strings share: the anchor and one side. These bytes
are the piece's core. Equal pieces are settled by their first occurrence. Pieces of a core that is still in
too many different ones are split by the next bytes in the same way, until
groups are bounded; a core of ``LENGTH`` bytes is one string, so that ends after seven rounds.
Pieces are equal if 128-bit digests of their bytes are.

Different pieces of one core meet in buckets of bounded size, and a suffix array with common prefixes is built over
each bucket column by column: every round puts one more symbol in front of one suffix of each piece, and the
order and the common prefixes of all suffixes follow from those of the round before
and the symbols in front of them (the Burrows-Wheeler transform of the bucket). A round
reads and writes whole arrays in sequence. The bytes that pieces share as their core are one symbol, as equal
strings have equal cores at equal places, so a piece of a bucket has at most 35 symbols, and there are as few
rounds, however long the documents are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import blake2b, sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.llm.common import map_batches
from corpusmix.session import materialize

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1  # substrings in a string
CHUNK = 1 << 20
PARTS = 5_000  # that are cut at once
BUCKET = 2_000  # different pieces that are compared at once
SPREAD = 1 << 16
NO_ID = -(1 << 63)
ROW = "doc_id bigint, digest bigint"  # a row is known by its doc_id and its text
ROW_KEYS = ("doc_id", "digest", "start")
SEGMENT_SCHEMA = f"anchor bigint, content bigint, {ROW}, start bigint, shape int"
PIECE_SCHEMA = f"core bigint, content binary, {ROW}, start bigint, size int, at int, bytes binary"
SPAN_SCHEMA = f"{ROW}, first bigint, past bigint"
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two random numbers per byte, powers of an odd base and of its inverse."""
    rng = np.random.default_rng(2024)
    first, second = rng.integers(0, 1 << 63, (2, 256), dtype=np.int64).astype(_U) * _U(2) + _U(1)
    base = 0x9E3779B97F4A7C15
    size = CHUNK + LENGTH + 1

    def powers(of: int) -> np.ndarray:
        out = np.full(size, _U(of))
        out[0] = 1
        return np.multiply.accumulate(out)

    return first, second, powers(base), powers(pow(base, -1, 1 << 64)), np.arange(size, dtype=np.int64)


def _prefixes(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * powers[: len(values)], out=out[1:])
    return out


def _hash(prefixes: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit numbers of substrings, the same wherever they lie."""
    return _mixed((prefixes[end] - prefixes[start]) * inverse[start])


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content, first string and shape (see below) of each segment of at most a chunk."""
    first, second, powers, inverse, index = _tables()
    grams = len(data) - GRAM + 1
    windows = len(data) - LENGTH + 1
    sums = _prefixes(first[data], powers)
    gram = _mixed((sums[GRAM:] - sums[:grams]) * inverse[:grams])
    # The place in the low bits makes the leftmost of equal grams the least.
    packed = (gram & ~_U((1 << 24) - 1)) | index[:grams].astype(_U)
    least, reach = packed, 1
    while 2 * reach <= WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = WINDOW - reach
    least = np.minimum(least[:windows], least[rest : rest + windows])
    anchor = (least & _U((1 << 24) - 1)).astype(np.int64)
    start = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
    count = np.diff(np.concatenate([start, [windows]]))
    contents = _hash(_prefixes(second[data], powers), inverse, start, start + count + LENGTH - 1)
    # Strings in the low byte, the anchor's place in the segment above it.
    shape = (anchor[start] - start) << 8 | count
    return gram[anchor[start]].view(np.int64), contents.view(np.int64), start, shape


def _find_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
        size = 0
        for doc_id, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = np.frombuffer((text.as_py() or "").encode("utf-8"), np.uint8)
            for at in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
                anchor, content, start, shape = segments(data[at : at + CHUNK + LENGTH - 1])
                ids = (np.full(len(start), one) for one in (doc_id, digest))
                for column, values in zip(columns, (anchor, content, *ids, start + at, shape.astype(np.int32))):
                    column.append(values)
                size += len(start)
            if size >= 50_000:
                yield _segment_batch(columns)
                columns, size = [[], [], [], [], [], []], 0
        if size:
            yield _segment_batch(columns)


def _segment_batch(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Segments with ``met``: 0 for an anchor that is here once; of others -1 for one, which stands for
    them where anchors meet, and numbers above 0 for the rest, by which they are spread."""
    joined = [np.concatenate(column) for column in columns]
    _, first, back, times = np.unique(joined[0], return_index=True, return_inverse=True, return_counts=True)
    met = 1 + np.arange(len(back)) % SPREAD
    met[first] = -1
    met[times[back] == 1] = 0
    names = ["anchor", "content", "doc_id", "digest", "start", "shape", "met"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (*joined, met.astype(np.int32))], names)


def _met_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor, those that are marked or whose anchor the row before or after has."""
    held: pa.RecordBatch | None = None  # the last row seen
    held_met = False
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column(0).to_numpy()
        same = anchor[1:] == anchor[:-1]
        met = batch.column(6).to_numpy() != 0
        batch = batch.select(range(6))
        met[1:] |= same
        met[:-1] |= same
        if held is not None:
            again = held.column(0)[0].as_py() == int(anchor[0])
            if again or held_met:
                yield held
            met[0] |= again
        held, held_met = batch.slice(batch.num_rows - 1, 1), bool(met[-1])
        body = batch.slice(0, batch.num_rows - 1).filter(pa.array(met[:-1]))
        if body.num_rows:
            yield body
    if held is not None and held_met:
        yield held


def _pieces(part: bytes, at: int, core: int) -> Iterator[tuple[int, int, int]]:
    """First byte, past byte and place of the core of the two pieces of ``part``, whose core is at ``at``.

    The core grows by half of what a string has beside it: to the left in strings that have as much
    there, else to the right.
    """
    half = (LENGTH - core + 1) // 2
    count = len(part) - LENGTH + 1
    if at >= half:
        yield 0, min(at - half, count - 1) + LENGTH, at - half
    low = max(0, at - half + 1)
    if low < count:
        yield low, len(part), at


Part = tuple[int, int, int, int, bytes]  # doc_id, digest, start, place of the core, bytes


def _piece_batches(found: Iterator[Part], core: int) -> Iterator[pa.RecordBatch]:
    while parts := list(islice(found, PARTS)):
        yield _piece_batch(parts, core)


def _piece_batch(found: list[Part], core: int) -> pa.RecordBatch:
    """The pieces of parts."""
    grown = core + (LENGTH - core + 1) // 2
    out = []
    for doc_id, digest, start, at, part in found:
        for low, past, place in _pieces(part, at, core):
            piece = part[low:past]
            key = int.from_bytes(blake2b(part[place : place + grown], digest_size=8).digest(), "little", signed=True)
            content = blake2b(piece, digest_size=16).digest()
            out.append((key, content, doc_id, digest, start + low, past - low, place - low, piece))
    columns = list(zip(*out)) if out else [[]] * 8
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        ["core", "content", *ROW_KEYS, "size", "at", "bytes"],
    )


def _wanted_parts(batch: pa.RecordBatch) -> Iterator[Part]:
    wanted = batch.column(3)
    rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), wanted.value_lengths().to_pylist())
    starts, shapes = (iter(column.to_pylist()) for column in wanted.flatten().flatten())
    for doc_id, digest, text, count in rows:
        data = (text.as_py() or "").encode("utf-8")
        for start, shape in islice(zip(starts, shapes), count):
            yield doc_id, digest, start, shape >> 8, data[start : start + (shape & 255) + LENGTH - 1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of wanted segments."""
    yield from _piece_batches((part for batch in batches for part in _wanted_parts(batch)), GRAM)


def _split(batches: Iterator[pa.RecordBatch], core: int) -> Iterator[pa.RecordBatch]:
    """Pieces, given as doc_id, digest, start, at, bytes, with the core that is next."""
    parts = (part for batch in batches for part in zip(*(column.to_pylist() for column in batch.columns)))
    yield from _piece_batches(parts, core)


def suffix_array(
    parts: list[bytes], at: list[int] | None = None, cores: list[int] | None = None, size: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, length and common prefix (255 at most) with the one before, of all suffixes in order.

    Built column by column: at the start there is an empty suffix of each part, in order. A round
    puts in front of every suffix the symbol that stands there; suffixes with one symbol in
    front keep their order, and their common prefix is one more than the least between them.

    ``cores`` numbers the ``size`` bytes that lie in each part at ``at``, equal bytes with equal numbers. They are
    one symbol then, which stands behind all bytes and is ``size`` long, so there are as many rounds
    as bytes beside them; suffixes that start inside them are left out.
    """
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    symbols = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + 1
    past = np.cumsum(lengths)
    behind = lengths.copy()  # symbols after the core
    if cores is not None:
        first = past - lengths + np.array(at, np.int64)
        behind = past - first - size
        symbols[first] = np.array(cores, np.int64) + 257
        inside = np.zeros(len(symbols) + 1, np.int64)
        inside[first + 1] += 1
        inside[first + size] -= 1
        symbols = symbols[np.cumsum(inside[:-1]) == 0]
        lengths = lengths - (size - 1)
        past = np.cumsum(lengths)
    used, small = np.unique(symbols, return_inverse=True)
    weights = np.concatenate([[0], np.where(used > 256, size, 1)]).astype(np.uint8)
    stride = int(lengths.max(initial=0)) + 1
    kind = np.uint8 if len(used) < 256 else np.uint16 if len(used) < 1 << 16 else np.int64  # the first two are sorted by counting
    codes = np.zeros(len(parts) * stride, kind)  # right-aligned, column 0 is the last symbol
    owner = np.repeat(np.arange(len(parts)), lengths)
    codes[owner * stride + past[owner] - 1 - np.arange(len(symbols))] = small.reshape(-1) + 1
    ends = (np.arange(len(parts)) * stride).astype(np.int32)
    nothing = np.zeros(len(parts), np.uint8)
    place, common = ends, nothing  # where the symbol in front of each suffix is
    for _ in range(stride - 1):
        front = codes[place]
        order = np.argsort(front, kind="stable")
        order = order[int(np.count_nonzero(front == 0)) :]
        symbols = front[order]
        # From after the one before to the suffix itself; between symbols the value is not used.
        edges = np.empty(2 * len(order), np.int64)
        edges[0], edges[2::2] = 0, order[:-1] + 1
        edges[1::2] = order + 1
        starts_symbol = np.concatenate([[True], symbols[1:] != symbols[:-1]])
        edges[0::2][starts_symbol] = order[starts_symbol]
        least = np.minimum.reduceat(np.append(common, np.uint8(0)), edges)[0::2]
        weight = weights[symbols]
        shared = np.where(starts_symbol, 0, np.minimum(least, 255 - weight) + weight).astype(np.uint8)
        place = np.concatenate([ends, place[order] + 1])
        common = np.concatenate([nothing, shared])
    owner, length = place // stride, place % stride
    return owner, np.where(length > behind[owner], length + max(0, size - 1), length), common


Piece = tuple[int, int, int, int, bytes]  # core, doc_id, digest, start, bytes


def _met_pieces(bucket: list[Piece], at: list[int], core: int) -> tuple[list[Piece], list[int], list[int]]:
    """The pieces of those in the bucket, one split further, whose core another one has; place and number of their cores."""
    grown = core + (LENGTH - core + 1) // 2
    first: dict[bytes, int] = {}
    split: list[tuple[Piece, int, int]] = []
    met: list[bool] = []
    for (key, doc_id, digest, start, part), here in zip(bucket, at):
        for low, past, place in _pieces(part, here, core):
            other = first.setdefault(part[place : place + grown], len(split))
            met.append(other != len(split))
            met[other] |= met[-1]
            split.append(((key, doc_id, digest, start + low, part[low:past]), place - low, other))
    kept = [one for one, again in zip(split, met) if again]
    return [one[0] for one in kept], [one[1] for one in kept], [one[2] for one in kept]


def _earlier(bucket: list[Piece], at: list[int], core: int) -> list[tuple[int, int, int, int]]:
    """Spans of bytes whose strings lie earlier in another piece of the bucket."""
    bucket, places, cores = _met_pieces(bucket, at, core)
    if not bucket:
        return []
    # Equal strings have equal cores at equal places, so those can be one symbol.
    owner, length, common = suffix_array([piece[4] for piece in bucket], places, cores, core + (LENGTH - core + 1) // 2)
    group = np.cumsum(common < LENGTH)
    sizes = np.bincount(group)
    many = sizes[group] > 1
    owner, length, group = owner[many], length[many], group[many]
    rows = sorted({piece[1:3] for piece in bucket})
    number = {row: k for k, row in enumerate(rows)}
    row = np.array([number[piece[1:3]] for piece in bucket], np.int64)[owner]
    past = np.array([piece[3] + len(piece[4]) for piece in bucket], np.int64)
    place = past[owner] - length
    order = np.lexsort((place, row, group))
    row, place, group = row[order], place[order], group[order]
    later = np.flatnonzero(group[1:] == group[:-1]) + 1  # all but the first of each group
    row, place = row[later], place[later]
    if not len(row):
        return []
    # Strings at neighbouring places become one span.
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    breaks = np.flatnonzero((np.diff(row) != 0) | (np.diff(place) > 1)) + 1
    lows = np.concatenate([[0], breaks])
    highs = np.concatenate([breaks, [len(row)]]) - 1
    return [
        (*rows[k], first, last + LENGTH)
        for k, first, last in zip(row[lows].tolist(), place[lows].tolist(), place[highs].tolist())
    ]


def _span_batch(spans: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*spans)) if spans else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["doc_id", "digest", "first", "past"]
    )


def _compare(batches: Iterator[pa.RecordBatch], core: int) -> Iterator[pa.RecordBatch]:
    """Different pieces sorted by core, in buckets of whole cores."""
    bucket: list[Piece] = []
    at: list[int] = []
    for batch in batches:
        places = batch.column(4).to_pylist()
        columns = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))
        for piece, place in zip(zip(*columns), places):
            if len(bucket) >= BUCKET and piece[0] != bucket[-1][0]:
                yield _span_batch(_earlier(bucket, at, core))
                bucket, at = [], []
            bucket.append(piece)
            at.append(place)
    if bucket:
        yield _span_batch(_earlier(bucket, at, core))


def _copied(rows: DataFrame, alike: DataFrame, keys: list[str]) -> DataFrame:
    """The spans of ``rows`` (``past`` included) that are alike by ``keys``, but for the first of each kind."""
    met = rows.join(alike.where(F.col("times") > 1).select(*keys, "first_at"), keys)
    here = F.struct(*ROW_KEYS)
    return met.where(here != F.col("first_at")).select("doc_id", "digest", F.col("start").alias("first"), "past")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, first, past``: bytes covered by strings that also start earlier; they may overlap.

    ``docs`` has ``doc_id, digest, text``, without nulls in the first two.
    """
    spark = docs.sparkSession
    found = map_batches(docs, _find_segments, f"{SEGMENT_SCHEMA}, met int")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(shards, "anchor", F.greatest("met", F.lit(0))).sortWithinPartitions("anchor")
    again = materialize(map_batches(dealt, _met_again, SEGMENT_SCHEMA), "repeats_segments", "zstd")

    place = F.min(F.struct(*ROW_KEYS)).alias("first_at")
    times = F.count("*").alias("times")
    different = materialize(
        again.groupBy("anchor", "content", "shape").agg(place, times), "repeats_different", "zstd"
    )
    past = F.col("start") + F.col("shape").bitwiseAND(255) + (LENGTH - 1)
    spans = _copied(again.withColumn("past", past), different, ["anchor", "content", "shape"])
    kinds = F.count("*").alias("kinds")
    more = different.groupBy("anchor").agg(kinds).where(F.col("kinds") > 1).select("anchor")
    wanted = (
        different.join(more, "anchor")
        .select("first_at.*", "shape")
        .groupBy("doc_id", "digest")
        .agg(F.collect_list(F.struct("start", "shape")).alias("wanted"))
    )
    with_text = docs.join(wanted, ["doc_id", "digest"]).select("doc_id", "digest", "text", "wanted")
    pieces = map_batches(with_text, _cut, PIECE_SCHEMA)
    core = GRAM
    while core < LENGTH:
        core += (LENGTH - core + 1) // 2
        pieces = materialize(pieces, "repeats_pieces", "zstd")
        alike = materialize(
            pieces.groupBy("core", "content").agg(
                place, times, F.first("at").alias("at"), F.first("bytes").alias("bytes")
            ),
            "repeats_alike", "zstd",
        )
        copies = pieces.select("core", "content", *ROW_KEYS, (F.col("start") + F.col("size")).alias("past"))
        spans = spans.unionByName(_copied(copies, alike, ["core", "content"]))
        groups = materialize(alike.groupBy("core").agg(kinds).where(F.col("kinds") > 1), "repeats_groups")
        usual = alike.join(groups.where(F.col("kinds") <= BUCKET), "core", "left_semi")
        sorted_pieces = (
            usual.select("core", "first_at.*", "at", "bytes").repartition(shards, "core").sortWithinPartitions("core")
        )
        spans = spans.unionByName(map_batches(sorted_pieces, partial(_compare, core=core), SPAN_SCHEMA))
        hot = groups.where(F.col("kinds") > BUCKET)
        if hot.isEmpty():
            break
        split = alike.join(hot, "core", "left_semi").select("first_at.*", "at", "bytes")
        pieces = map_batches(split, partial(_split, core=core), PIECE_SCHEMA)
    return spans


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = np.frombuffer((text.as_py() or "").encode("utf-8"), np.uint8)
            edges = np.zeros(len(data) + 1, np.int64)
            if spans.is_valid and len(spans):
                first = np.minimum(spans.values.field(0).to_numpy(), len(data))
                past = np.minimum(spans.values.field(1).to_numpy(), len(data))
                np.add.at(edges, first, 1)
                np.add.at(edges, past, -1)
            removed = np.cumsum(edges[:-1]) > 0
            starts = removed & ~np.concatenate([[False], removed[:-1]])
            digest = sha256(data[~removed].tobytes()).hexdigest()
            rows.append((len(data), int(removed.sum()), int(starts.sum()), digest))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs`` (``doc_id, text``).

    Null text counts as empty; texts of fewer than 100 bytes keep everything. Earlier
    means a smaller doc_id (null before all), then an earlier start. Rows of one doc_id, or of
    none, that differ in their texts are documents of their own, in the order of a 64-bit hash of the text;
    rows equal in both are one document, and what is removed goes from each of them. So the first
    occurrence of every string stays. Other columns are left aside.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    repeated = rows.groupBy("doc_id").count().where("count > 1")
    # Where each doc_id is there once, nothing has to be carried beside it.
    digest = F.lit(0).cast("bigint") if repeated.isEmpty() else F.xxhash64("text")
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("_row"), digest.alias("digest"), "text")
    keyed = rows.select(F.col("_row").alias("doc_id"), "digest", "text")
    spans = repeated_spans(keyed).groupBy(F.col("doc_id").alias("_row"), "digest").agg(
        F.collect_list(F.struct("first", "past")).alias("spans")
    )
    return map_batches(
        rows.join(spans, ["_row", "digest"], "left").select("doc_id", "text", "spans"),
        _kept,
        "doc_id bigint, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )
