"""Token counting and cutting.

``PatternTokenizer`` is the default: a word-level stand-in made of native
expressions. ``BatchTokenizer`` takes any real tokenizer through Arrow batches.
Both offer the same three column expressions, so operators take either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmix.functions.text import strip

# Leading white space belongs to the token, so that joining the first n tokens
# gives a prefix of the text. White space is spelled out because engines differ.
SPACE = r"[ \t\n\x0B\f\r]"
SPECIAL = r"<(?:bos|eos|start_of_turn|end_of_turn)>"
TOKEN = SPACE + r"*(?:" + SPECIAL + r"|\p{L}+|\p{N}|[^ \t\n\x0B\f\r\p{L}\p{N}])"
# The same tokens without backtracking: the first character decides which kind a token is.
# Its group is the rest of a turn marker, so what is extracted to be counted is an empty text for nearly all tokens.
SAME_TOKEN = SPACE + r"*+(?:\p{L}++|[^ \t\n\x0B\f\r\p{L}<]|<((?:bos|eos|start_of_turn|end_of_turn)>)?+)"
BATCH_CHARS = 1 << 18
PART_ROWS = 1_000


@dataclass(frozen=True)
class PatternTokenizer:
    """Counts words, digits, symbols and turn markers with one regular expression."""

    pad_tokens: int = 1

    def count(self, text: Column) -> Column:
        return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SAME_TOKEN), F.lit(1)))

    def cut(self, text: Column, limit: Column) -> Column:
        """The first ``limit`` tokens as text, without turn markers, stripped."""
        # Tokens leave nothing between them: the last piece is what stands behind those that are kept.
        rest = F.element_at(F.split(text, SAME_TOKEN, limit + 1), -1)
        kept = F.left(text, F.length(text) - F.length(rest))
        return strip(F.regexp_replace(kept, SPACE + "*+" + SPECIAL, ""))


_LOADED: dict[bytes, Any] = {}


def loaded_once(key: bytes, loader: Callable[[], Any]) -> Any:
    """The loader's result, made once per Python worker and kept."""
    if key not in _LOADED:
        _LOADED[key] = loader()
    return _LOADED[key]


def in_parts(texts: Iterable[str], chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Neighbouring texts together, of about so many characters."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars or len(part) >= PART_ROWS:
            yield part
            part, size = [], 0
    if part:
        yield part


@dataclass(frozen=True)
class BatchTokenizer:
    """Runs a caller's tokenizer on Arrow batches.

    ``loader`` returns an object with ``encode_batch(list of str) -> list of
    sequences`` and ``decode(sequence) -> str``. It is called once per worker. Its
    batches are bounded by their characters, as the tokens of a text take many times its size.
    """

    loader: Callable[[], Any]
    pad_tokens: int = 1

    def count(self, text: Column) -> Column:
        loader, key = self.loader, cloudpickle.dumps(self.loader)

        @F.pandas_udf("int")
        def count_batch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokenizer = loaded_once(key, loader)
            for batch in batches:
                counts = [len(ids) for part in in_parts(batch.fillna("")) for ids in tokenizer.encode_batch(part)]
                yield pd.Series(counts, dtype="int32")

        return count_batch(text)

    def cut(self, text: Column, limit: Column) -> Column:
        loader, key = self.loader, cloudpickle.dumps(self.loader)

        @F.pandas_udf("string")
        def cut_batch(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            tokenizer = loaded_once(key, loader)
            for texts, limits in batches:
                encoded = (ids for part in in_parts(texts.fillna("")) for ids in tokenizer.encode_batch(part))
                # A null limit marks a row whose text is not to be cut.
                yield pd.Series(
                    [
                        None if pd.isna(most) else tokenizer.decode(ids[: int(most)])
                        for ids, most in zip(encoded, limits)
                    ],
                    dtype="object",
                )

        return strip(cut_batch(text, limit))


Tokenizer = PatternTokenizer | BatchTokenizer
