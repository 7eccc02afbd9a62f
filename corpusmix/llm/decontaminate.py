"""Passages of benchmark items in documents, found with few edits by the q-gram lemma.

A window of ``w`` characters and its copy with ``k`` edits share ``w - q + 1 - k * q``
q-grams or more, and all of them lie within ``k`` diagonals (position in the document minus
position in the item). So hits of item q-grams are counted in overlapping diagonal bands,
only places in a band with enough hits near each other are kept, and these are
confirmed by an alignment inside the band. A document is read once, as an array.

Neighbouring hits of one diagonal are held as one stretch, of which only the ends are looked up, so a line of
thousands of equal characters costs one stretch per diagonal and not every pair of its places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmix.llm.common import map_batches

Q = 10
WINDOWS = (100, 50)
EDIT_SHARE = 0.06
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
HIT_SCHEMA = (
    "doc_id bigint, item_id bigint, region_start long, region_end long, "
    "item_start long, item_end long, shared_qgrams long, edits long"
)
# Bits of a code point plus one; no character, in an item or in a document, differs from all and from each other.
_CODE_BITS = 22
_NO_ITEM, _NO_DOC = 0, (1 << _CODE_BITS) - 1
_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)
_POWERS = {k: _U(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in (1, 2, 4, 8)}


def normal(text: str | None) -> str:
    """Lower case, with single blanks between words."""
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit number per q-gram, put together from those of halves."""
    size = len(codes) - Q + 1
    if size <= 0:
        return np.zeros(0, _U)
    # Grams of a power of two in length from two of half the length, then those of Q.
    grams, length = {1: codes.astype(_U)}, 1
    while 2 * length <= Q:
        half = grams[length]
        grams[2 * length] = half[:-length] * _POWERS[length] + half[length:]
        length *= 2
    out, done = grams[length][:size], length
    while done < Q:
        more = max(k for k in grams if k <= Q - done)
        out = out * _POWERS[more] + grams[more][done : done + size]
        done += more
    return out


def budgets(length: int) -> list[tuple[int, int, int]]:
    """Windows, edits allowed in each and q-grams then shared, for an item of some length.

    Short items allow fewer edits, so that two q-grams at least must be shared. Items above
    50 characters have two: a few edits may lie close together, so that each part of 50 characters
    has too many while the whole has not, and the other way round an excerpt may hold only a part.
    """
    out = []
    for window in sorted({min(length, w) for w in WINDOWS}, reverse=True):
        edits = max(0, min(int(window * EDIT_SHARE), (window - Q + 1 - 2) // Q))
        out.append((window, edits, max(1, window - Q + 1 - edits * Q)))
    return out


@dataclass
class Index:
    """The q-grams of a block of items with the characters beside them, sorted, and where they lie."""

    item_ids: list[int | None]
    codes: list[np.ndarray]
    needed: np.ndarray
    short: dict[str, list[int]]
    whole: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    before: tuple[np.ndarray, np.ndarray]
    after: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def build(items: list[tuple[int | None, str]]) -> Index:
        ids, codes, short, grams, places, marks = [], [], {}, [], [], ([], [])
        offset = 0
        for item_id, text in sorted(items, key=lambda i: (i[0] is not None, i[0] or 0, i[1])):
            plain = normal(text)
            if not plain:
                continue
            one = _codes(plain)
            found = _grams(one)
            if len(found):
                grams.append(found)
                places.append(np.arange(offset, offset + len(found), dtype=np.int32))
                for out, beside in zip(marks, _beside(one, np.arange(len(found)), _NO_ITEM)):
                    out.append(beside)
            else:
                short.setdefault(plain, []).append(len(ids))
            ids.append(item_id)
            codes.append(one)
            offset += len(one)
        lengths = [len(one) for one in codes]
        known, number = np.unique(np.concatenate(grams) if grams else np.zeros(0, _U), return_inverse=True)
        first = np.zeros(1 << FILTER_BITS, dtype=bool)
        first[Index.slot(known)] = True
        place = np.concatenate(places) if places else np.zeros(0, np.int32)
        ordered = []
        for side in marks:
            keys = (number << _CODE_BITS) | (np.concatenate(side) if side else np.zeros(0, np.int64))
            order = np.argsort(keys, kind="stable")
            ordered.append((keys[order], place[order]))
        return Index(
            ids,
            codes,
            np.array([min(b[2] for b in budgets(size)) for size in lengths], np.int64),
            short,
            np.concatenate(codes) if codes else np.zeros(0, "<u4"),
            np.repeat(np.arange(len(codes), dtype=np.int32), lengths),
            np.cumsum([0, *lengths])[:-1],
            known,
            first,
            *ordered,
        )

    @staticmethod
    def slot(grams: np.ndarray) -> np.ndarray:
        return ((grams * _FACTOR) >> _U(64 - FILTER_BITS)).astype(np.int64)

    def stretches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All equal q-grams, neighbours of a diagonal together: item, diagonal, first and last place in the document.

        They are sorted by these. A hit begins a stretch if the characters before it differ, and ends one if those
        behind it do, so beginnings and ends of a diagonal take turns.
        """
        grams = _grams(codes)
        at = np.flatnonzero(self.first[self.slot(grams)])
        number = np.searchsorted(self.grams, grams[at])
        if len(at):
            is_one = self.grams[np.minimum(number, len(self.grams) - 1)] == grams[at]
            at, number = at[is_one], number[is_one]
        if not len(at):
            return (np.zeros(0, np.int64),) * 4
        ends = []
        for entries, beside in zip((self.before, self.after), _beside(codes, at, _NO_DOC)):
            place, here = self._unlike(entries, number, beside, at, codes)
            item = self.owner[place].astype(np.int64)
            diagonal = here - (place - self.offset[item])
            order = np.lexsort((here, diagonal, item))
            ends.append((item[order], diagonal[order], here[order]))
        (item, diagonal, start), (_, _, end) = ends
        return item, diagonal, start, end

    def _unlike(
        self, entries: tuple[np.ndarray, np.ndarray], number: np.ndarray, beside: np.ndarray, at: np.ndarray, codes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places in the items and in the document of equal q-grams with unequal characters beside them."""
        keys, places = entries
        own = (number << _CODE_BITS) | beside
        low = np.concatenate([np.searchsorted(keys, number << _CODE_BITS), np.searchsorted(keys, own, "right")])
        high = np.concatenate([np.searchsorted(keys, own), np.searchsorted(keys, (number + 1) << _CODE_BITS)])
        count = high - low
        begin = np.cumsum(count) - count
        place = places[np.arange(int(count.sum())) - np.repeat(begin, count) + np.repeat(low, count)].astype(np.int64)
        here = np.repeat(np.concatenate([at, at]), count)
        same = np.ones(len(place), bool)
        for k in range(Q):  # equal numbers of different q-grams are very rare, but would part beginnings from ends
            same &= self.whole[place + k] == codes[here + k]
        return place[same], here[same]


def _beside(codes: np.ndarray, at: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The characters before and behind the q-grams at some places, counted from 1, or ``none``."""
    before = np.where(at > 0, codes[np.maximum(at - 1, 0)].astype(np.int64) + 1, none)
    after = np.where(at + Q < len(codes), codes[np.minimum(at + Q, len(codes) - 1)].astype(np.int64) + 1, none)
    return before, after


def aligned_edits(item: np.ndarray, doc: np.ndarray, low: int, high: int) -> int:
    """Fewest edits between all of ``item`` and some part of ``doc`` inside a band.

    Row i of the band holds the ends i + low to i + high in the document; a part may
    start and end anywhere in it.
    """
    for start in range(max(low, 0), min(high, len(doc) - len(item)) + 1):
        if np.array_equal(item, doc[start : start + len(item)]):
            return 0
    width = high - low + 1
    steps = np.arange(width)
    worst = len(item) + width + 1
    costs = np.where((steps + low >= 0) & (steps + low <= len(doc)), 0, worst)
    for i in range(len(item)):
        at = i + low + steps  # the character that a diagonal step takes
        inside = (at >= 0) & (at < len(doc))
        same = np.zeros(width, bool)
        same[inside] = doc[at[inside]] == item[i]
        new = np.where(inside, costs + ~same, worst)
        new[:-1] = np.minimum(new[:-1], costs[1:] + 1)
        new = np.minimum.accumulate(new - steps) + steps
        ends = at + 1
        costs = np.where((ends >= 0) & (ends <= len(doc)), new, worst)
    return int(costs.min())


def _confirmed_window(
    item: np.ndarray, doc: np.ndarray, places: np.ndarray, low: int, high: int, allowed: tuple[int, int, int]
) -> tuple[int, int, int] | None:
    """A part of the item that meets the budget, from the sorted places of its hits: start, end, edits."""
    window, edits, needed = allowed
    start, end = int(places[0]), int(places[-1]) + Q
    if end - start >= window:
        found = aligned_edits(item[start:end], doc, low + start, high + start)
        if found <= edits * (end - start) // window:
            return start, end, found
    # Windows with enough q-grams, the one with the most first.
    starts = np.arange(max(0, start - window + Q), min(len(item) - window, end - Q) + 1)
    inside = np.searchsorted(places, starts + window - Q, "right") - np.searchsorted(places, starts, "left")
    for k in np.argsort(-inside, kind="stable").tolist():
        if inside[k] < needed:
            break
        at = int(starts[k])
        found = aligned_edits(item[at : at + window], doc, low + at, high + at)
        if found <= edits:
            return at, at + window, found
    return None


def _dense_runs(first: np.ndarray, last: np.ndarray, needed: int, span: int) -> Iterator[tuple[int, int, int]]:
    """Maximal runs of hits in which every ``needed`` neighbours lie within ``span``: hits, first and last place.

    The hits are those of stretches from ``first`` to ``last``; several may have one place.
    """
    sizes = last - first + 1
    total, low = int(sizes.sum()), int(first.min())
    if total <= int(last.max()) - low:
        begin = np.cumsum(sizes) - sizes
        places, times = np.unique(np.arange(total) - np.repeat(begin, sizes) + np.repeat(first, sizes), return_counts=True)
    else:
        change = np.bincount(first - low, minlength=int(last.max()) - low + 2)
        change[: int(last.max()) - low + 2] -= np.bincount(last - low + 1, minlength=len(change))
        every = np.cumsum(change)
        places = np.flatnonzero(every)
        times = every[places]
        places = places + low
    # Hits by their number in order of place: those of one place, and the last that begins a dense part there.
    done = np.cumsum(times)
    start = done - times
    within = done[np.searchsorted(places, places + span, "right") - 1]
    stop = np.minimum(done - 1, within - needed)
    dense = np.flatnonzero(stop >= start)
    if len(dense):
        for run in np.split(dense, np.flatnonzero(start[dense[1:]] - stop[dense[:-1]] > needed) + 1):
            lo, hi = int(start[run[0]]), int(stop[run[-1]]) + needed
            yield hi - lo, int(places[run[0]]), int(places[np.searchsorted(done, hi - 1, "right")])


def passages(index: Index, text: str) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """Confirmed regions of one text in normal form: item, its region, the item's part, q-grams, edits.

    Items too short for a q-gram are found where they stand as they are, with no letter or digit right beside a
    letter or digit of theirs.
    """
    yield from leaks(index, _codes(text))
    if not index.short:
        return
    sizes = sorted({len(phrase) for phrase in index.short})
    apart = [k for k in range(len(text) + 1) if k in (0, len(text)) or not (text[k - 1].isalnum() and text[k].isalnum())]
    edges = set(apart)
    for start in apart:
        for size in sizes:
            if start + size in edges:
                for which in index.short.get(text[start : start + size], ()):
                    yield which, start, start + size, 0, size, 0, 0


def leaks(index: Index, codes: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """The regions that q-grams find.

    Overlapping bands see a region twice, so the places with most hits are confirmed first
    and others that overlap a confirmed one are left. Longer windows come before shorter ones.
    """
    item, diagonal, first, last = index.stretches(codes)
    if not len(item):
        return
    counts = np.bincount(item, last - first + 1, len(index.codes))
    for which in np.flatnonzero(counts >= np.maximum(index.needed, 1)).tolist():
        lo, hi = np.searchsorted(item, [which, which + 1])
        taken = np.zeros(len(codes), bool)
        for allowed in budgets(len(index.codes[which])):
            found = _found(index.codes[which], codes, diagonal[lo:hi], first[lo:hi], last[lo:hi], allowed, taken)
            for region, sure, shared in found:
                yield which, *region, sure[0], sure[1], shared, sure[2]


def _found(
    item: np.ndarray,
    doc: np.ndarray,
    d: np.ndarray,
    first: np.ndarray,
    last: np.ndarray,
    allowed: tuple[int, int, int],
    taken: np.ndarray,
) -> Iterator[tuple[tuple[int, int], tuple[int, int, int], int]]:
    """Regions that meet one budget and overlap no place marked in ``taken``, where they are marked.

    ``d, first, last`` are the stretches of one item: diagonal, first and last place in the document.
    """
    window, edits, needed = allowed
    width = 2 * edits + 1
    band = d // width
    # Bands overlap by the edits: a hit near the lower end also counts for the band below.
    near = (d - band * width) < edits
    band = np.concatenate([band, band[near] - 1])
    d, first, last = (np.concatenate([x, x[near]]) for x in (d, first, last))
    order = np.argsort(band, kind="stable")
    band, d, first, last = band[order], d[order], first[order], last[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(band)) + 1, [len(band)]])
    hits = np.add.reduceat(last - first + 1, cuts[:-1])
    # Of a band whose places are all taken, no region can come.
    places = np.concatenate([[0], np.cumsum(~taken)])
    free = places[np.maximum.reduceat(last, cuts[:-1]) + Q] > places[np.minimum.reduceat(first, cuts[:-1])]
    runs = []
    for k in np.flatnonzero((hits >= needed) & free).tolist():
        part = slice(int(cuts[k]), int(cuts[k + 1]))
        for size, start, end in _dense_runs(first[part], last[part], needed, window + edits - Q):
            runs.append((size, start, end, part))
    for size, start, end, part in sorted(runs, key=lambda run: -run[0]):
        region = (start, end + Q)
        if taken[start : end + Q].any():
            continue
        low = int(band[part.start]) * width
        mine = (first[part] <= end) & (last[part] >= start)
        marked = np.zeros(len(item), bool)
        for diagonal, a, b in zip(d[part][mine].tolist(), first[part][mine].tolist(), last[part][mine].tolist()):
            marked[max(a, start) - diagonal : min(b, end) - diagonal + 1] = True
        sure = _confirmed_window(item, doc, np.flatnonzero(marked), low - edits, low + width + 2 * edits, allowed)
        if sure:
            taken[start : end + Q] = True
            yield region, sure, size


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "region_start", "region_end", "item_start", "item_end", "shared_qgrams", "edits"]
        block = index.value
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for which, *rest in passages(block, normal(text.as_py())):
                    out.append((doc_id, block.item_ids[which], *rest))
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _mark(index, at: int):
    """Each row with what a block of items has in its text, added to the list in its last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = index.value
        kind = pa.list_(pa.struct([("bare", pa.bool_()), ("item", pa.int64()), ("place", pa.int64())]))
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            for found, text in zip(lists, batch.column(at)):
                for which, start, _, first, last, *_ in passages(block, normal(text.as_py())):
                    found.append({"bare": last - first < 2 * Q, "item": block.item_ids[which], "place": start})
            columns = [*batch.columns[:-1], pa.array(lists, kind)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def _indexes(spark: SparkSession, benchmark: DataFrame) -> Iterator:
    """The benchmark in blocks of at most ``BLOCK_CHARS`` characters (or a longer single item), for all tasks."""
    items = benchmark.where(F.length("text") > 0).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_CHARS) + 1
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield spark.sparkContext.broadcast(
            Index.build([(row["item_id"], row["text"]) for row in part.toLocalIterator()])
        )


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per passage of a benchmark item in a document, with its place in both.

    ``docs`` has ``doc_id, text`` and ``benchmark`` has ``item_id, text``. Places count
    characters of the texts in lower case with single blanks. A passage is a window of 100
    characters or one of 50 (or the whole of a shorter item) with at most 6 % edits. Null and empty texts
    have none; items of fewer than ten characters have no q-gram and are found as they are, as whole words.
    Repeated rows give repeated results. Null ids of either side are kept in the result. Other columns are left
    aside; an empty table or benchmark gives an empty result. Long texts are read whole.

    The benchmark is the stated set of queries: it is cut into blocks, and the documents are read once per block.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    found = None
    for index in _indexes(docs.sparkSession, benchmark):
        hits = map_batches(plain, _search(index), HIT_SCHEMA)
        found = hits if found is None else found.unionByName(hits)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no passage of the benchmark is found.

    A whole item of fewer than 20 characters may be a common phrase, so such ones only count
    if a text has two different ones at different places. Every row is judged by its own text
    where it is, so repeated or null ids do not matter, nothing is shuffled, and columns of any names are kept. Null
    and empty texts stay; an empty table or benchmark changes nothing.
    """
    name = "_leaks"
    while name in docs.columns:
        name = f"_{name}"
    none = F.array().cast("array<struct<bare: boolean, item: bigint, place: bigint>>")
    marked = docs.withColumn(name, none)
    for index in _indexes(docs.sparkSession, benchmark):
        marked = map_batches(marked, _mark(index, docs.columns.index("text")), marked.schema)
    items = F.size(F.array_distinct(F.col(name)["item"]))
    places = F.size(F.array_distinct(F.col(name)["place"]))
    leaking = F.exists(name, lambda found: ~found["bare"]) | ((items > 1) & (places > 1))
    return marked.where(~leaking).drop(name)
