"""Byte-pair encoding as a transducer with bounded lookahead, and streaming decoding.

Encoding reads a text in pieces and gives out ids as soon as nothing that follows can
change them. How far back what follows can reach is computed from the merge list: a
difference to the right of a boundary moves it left over ``u`` only by a merge
``(u, v)``, at most once per rank, and the next merge that moves it is of a later
rank with a right side that starts with ``u``. The longest such chain, in symbols,
is a sufficient lookahead. So a word of any length is encoded with a window of
constant size.

This holds for lists in which each part of a merge is a base symbol or made by earlier
merges only, which is checked on loading.
"""

from __future__ import annotations

import codecs
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corpusmix.llm.common import Memo, WordIds, lowered, map_batches, slices

WINDOW_STEP = 512
SHORT = 32
UNMERGED = 1 << 60
MEMO_LENGTH = 64
HELD_BACK = 4
PIECE = 1 << 16
DOC_SCHEMA = "doc_id bigint, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Merges:
    """A merge list with word ends: ids of symbols, ranks of pairs, and the lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        model = settings["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in settings["added_tokens"]}
        self.added_pattern = regex.compile("|".join(map(regex.escape, self.added)) or r"(?!)")
        self.longest_added = max(map(len, self.added), default=1)
        self.byte_of = {symbol: byte for byte, symbol in byte_symbols().items()}
        self.text_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self._check_order(pairs)
        self.lookahead = self._lookahead(pairs)

    @staticmethod
    def _check_order(pairs: list[tuple[str, str]]) -> None:
        last_made = {u + v: rank for rank, (u, v) in enumerate(pairs)}
        for rank, (u, v) in enumerate(pairs):
            if last_made.get(u, -1) >= rank or last_made.get(v, -1) >= rank:
                raise ValueError(f"merge {rank} uses a part that a later merge makes")

    @staticmethod
    def _lookahead(pairs: list[tuple[str, str]]) -> int:
        """Symbols before the end of what is known that may still change."""
        reach: dict[str, int] = {}
        longest = 0
        for u, v in reversed(pairs):
            moved = len(u) + reach.get(u, 0)
            longest = max(longest, moved)
            for k in range(1, len(v) + 1):
                if reach.get(v[:k], 0) < moved:
                    reach[v[:k]] = moved
        return longest

    def merge(self, symbols: list[str]) -> list[str]:
        """Tokens of a whole window: the lowest rank first, from the left."""
        return self._merge_short(symbols) if len(symbols) <= SHORT else self._merge_long(symbols)

    def _merge_short(self, symbols: list[str]) -> list[str]:
        """Looks through the ranks of all pairs for each merge, which is quick while they are few."""
        rank_of, parts = self.ranks.get, list(symbols)
        ranks = [rank_of(pair, UNMERGED) for pair in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != UNMERGED:
            at = ranks.index(low)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((parts[at - 1], parts[at]), UNMERGED)
            if at < len(ranks):
                ranks[at] = rank_of((parts[at], parts[at + 1]), UNMERGED)
        return parts

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """Keeps the pairs in a heap, for time in proportion to the window but for a logarithm."""
        ranks, size = self.ranks, len(symbols)
        parts: list[str | None] = list(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heap = [(r, k) for k in range(size - 1) if (r := ranks.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, left = heapq.heappop(heap)
            right = after[left]
            if parts[left] is None or right >= size or ranks.get((parts[left], parts[right])) != rank:
                continue
            parts[left] += parts[right]
            parts[right] = None
            after[left] = after[right]
            if after[right] < size:
                before[after[right]] = left
                r = ranks.get((parts[left], parts[after[right]]))
                if r is not None:
                    heapq.heappush(heap, (r, left))
            if before[left] >= 0:
                r = ranks.get((parts[before[left]], parts[left]))
                if r is not None:
                    heapq.heappush(heap, (r, before[left]))
        return [part for part in parts if part is not None]


@lru_cache(maxsize=4)
def load_merges(path: str) -> Merges:
    return Merges(path)


def _safe_cut(text: str) -> int:
    """The last place at which normal form C of both sides can be taken apart, or 0."""
    for at in range(len(text) - 1, 0, -1):
        code = ord(text[at])
        if code < 128 or (unicodedata.category(text[at])[0] == "L" and not 0x1160 <= code <= 0x11FF):
            return at
    return 0


class StreamEncoder:
    """``feed`` pieces of a text and get the ids that are settled; ``finish`` gives the rest."""

    # The tokenizer's own pattern for parts of a text.
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
    RUNS = {"letters": regex.compile(r"\p{L}+"), "marks": regex.compile(r"[^\p{White_Space}\p{L}\p{N}]+")}
    SPACE = regex.compile(r"\p{White_Space}+")
    BYTES = byte_symbols()

    def __init__(self, merges: Merges):
        self.merges = merges
        self.raw = ""  # not yet normalised
        self.text = ""  # normalised, not yet in parts
        self.run: str | None = None  # the kind of part that is open
        self.window: list[str] = []  # its symbols that are not settled

    def feed(self, piece: str) -> list[int]:
        out: list[int] = []
        self.raw += piece
        while found := self.merges.added_pattern.search(self.raw):
            out += self._normalised(self.raw[: found.start()]) + self._cut_parts(True)
            out.append(self.merges.added[found.group()])
            self.raw = self.raw[found.end() :]
        cut = _safe_cut(self.raw[: max(0, len(self.raw) - self.merges.longest_added)])
        if cut:
            out += self._normalised(self.raw[:cut]) + self._cut_parts(False)
            self.raw = self.raw[cut:]
        return out

    def finish(self) -> list[int]:
        out = self._normalised(self.raw) + self._cut_parts(True)
        self.raw = ""
        return out

    def _normalised(self, raw: str) -> list[int]:
        text = self.SPACE.sub(" ", unicodedata.normalize("NFC", raw))
        # Letter by letter: no final form of sigma.
        self.text += text.replace("Σ", "σ").lower()
        return []

    def _cut_parts(self, final: bool) -> list[int]:
        """Cut the normalised text into parts; one that reaches its end stays open."""
        out: list[int] = []
        text, at = self.text, 0
        end = len(text) if final else max(0, len(text) - HELD_BACK)
        while at < end:
            if self.run:
                more = self.RUNS[self.run].match(text, at, end)
                if more:
                    at = more.end()
                    out += self._extend(more.group())
                if at < end:
                    out += self._close()
                continue
            part = self.PARTS.search(text, at)
            if part is None or part.start() >= end:
                at = end
                continue
            at, word = part.end(), part.group()
            kind = "letters" if word[0].isalpha() and self.RUNS["letters"].fullmatch(word) else "marks"
            if self.RUNS[kind].fullmatch(word):
                at = min(at, end)
                self.run = kind
                out += self._extend(word[: at - part.start()])
            else:  # a number or a contraction is whole
                out += self._extend(word) + self._close()
        self.text = text[at:]
        if final:
            out += self._close()
        return out

    def _extend(self, characters: str) -> list[int]:
        self.window += map(self.BYTES.__getitem__, characters.encode("utf-8"))
        out: list[int] = []
        limit = self.merges.lookahead
        while len(self.window) > limit + WINDOW_STEP + 1:
            size = min(len(self.window) - 1, 2 * limit + 4 * WINDOW_STEP)
            settled, used = size - limit, 0
            for token in self.merges.merge(self.window[:size]):
                if used + len(token) > settled:
                    break
                used += len(token)
                out.append(self.merges.vocab[token])
            if not used:
                break
            self.window = self.window[used:]
        return out

    def _close(self) -> list[int]:
        self.run = None
        if not self.window:
            return []
        self.window[-1] += self.merges.end
        tokens = self.merges.merge(self.window)
        self.window = []
        return [self.merges.vocab[token] for token in tokens]


class StreamDecoder:
    """Ids to text, piece by piece.

    ``style="tokens"`` gives the vocabulary's own spelling, one blank between tokens, as a
    tokenizer without a decoder has it. ``style="text"`` gives plain text: the bytes
    of the tokens go through an incremental UTF-8 machine that keeps an unfinished
    character until its other bytes come, word ends become blanks, and what is no UTF-8
    becomes U+FFFD.
    """

    def __init__(self, merges: Merges, style: str = "tokens"):
        self.spelled = merges.text_of
        self.style = style
        self.first = True
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.end = merges.end
        self.added = merges.added.values()
        self.byte_of = merges.byte_of

    def feed(self, ids: Iterable[int]) -> str:
        if self.style == "tokens":
            joined = " ".join(map(self.spelled.__getitem__, ids))
            if not joined:
                return ""
            lead, self.first = ("" if self.first else " "), False
            return lead + joined
        return self.machine.decode(b"".join(map(self._bytes, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)

    def _bytes(self, token_id: int) -> bytes:
        token = self.spelled[token_id]
        if token_id in self.added:
            return token.encode("utf-8")
        ends = bool(self.end) and token.endswith(self.end)
        stem = token[: -len(self.end)] if ends else token
        return bytes(map(self.byte_of.__getitem__, stem)) + (b" " if ends else b"")


class TextEncoder:
    """Ids of whole texts through the transducer, each distinct short part once.

    White space always ends a part, so a text goes through word by word. A part within
    the window of the transducer is settled by its own end; the memo keeps those.
    Longer words, and those not yet in normal form, stream through in pieces.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.part_stream = StreamEncoder(merges)
        self.parts = Memo(self._encode_parts)
        self.encode_all = WordIds(self._encode_words).encode

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        return [np.array(self._part(part), dtype="<u4").tobytes() for part in parts]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        split: list[list[str] | None] = []
        for word in words:
            low = lowered(word) if len(word) <= MEMO_LENGTH else None
            split.append(None if low is None else StreamEncoder.PARTS.findall(low))
        ids = iter(self.parts.values(list(chain.from_iterable(filter(None, split)))))
        return [
            np.array(self.stream(word), dtype="<u4").tobytes()
            if parts is None
            else b"".join(next(ids) for _ in parts)
            for word, parts in zip(words, split)
        ]

    def _part(self, part: str) -> list[int]:
        return self.part_stream._extend(part) + self.part_stream._close()

    def stream(self, text: str) -> list[int]:
        stream = StreamEncoder(self.merges)
        out: list[int] = []
        for at in range(0, len(text), PIECE):
            out += stream.feed(text[at : at + PIECE])
        return out + stream.finish()

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()


@lru_cache(maxsize=4)
def text_encoder(path: str) -> TextEncoder:
    """The encoder of a worker process, made once."""
    return TextEncoder(load_merges(path))


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        encoder = text_encoder(path)
        decimal = {i: str(i) for i in encoder.merges.text_of}
        for batch in batches:
            counts, encoded, decoded = [], [], []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for array in chain.from_iterable(map(encoder.encode_all, slices(texts))):
                ids = array.tolist()
                counts.append(len(ids))
                encoded.append(sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoder, digest = StreamDecoder(encoder.merges), sha256()
                for at in range(0, len(ids), PIECE):
                    digest.update(decoder.feed(ids[at : at + PIECE]).encode("utf-8"))
                digest.update(decoder.finish().encode("utf-8"))
                decoded.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(encoded, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            ids = [encoder.encode(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return run


def _texts(path: str, style: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(path)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder = StreamDecoder(merges, style)
                texts.append(decoder.feed(ids or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return run


def _two_columns(docs: DataFrame, second: str) -> DataFrame:
    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", second)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids`` of every whole text. Null text: no ids. Repeated rows are kept."""
    return map_batches(_two_columns(docs, "text"), _ids(tokenizer), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, style: str = "text") -> DataFrame:
    """``doc_id, text`` of every list of ids. Null list: empty text."""
    return map_batches(_two_columns(encoded, "ids"), _texts(tokenizer, style), "doc_id bigint, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode, decode, and give counts and digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    One row per input row, in any order; no shuffle. Null text counts as empty, with
    no ids and the digests of an empty text. Columns but ``doc_id`` and ``text`` are left aside.
    """
    return map_batches(_two_columns(docs, "text"), _round_trip(tokenizer), DOC_SCHEMA)
