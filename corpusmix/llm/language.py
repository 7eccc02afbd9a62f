"""Languages of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A group of three letters is bound as the
product of their vectors, shifted by their places, and a text is the sum of its groups. A
language is the sum of its texts, and a text has the language with the largest cosine.
Sums are of whole numbers, so the order in which tasks add them changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmix.llm.common import map_batches
from corpusmix.session import materialize

DIMENSIONS = 1024
LETTERS = 64  # kinds of letters; 0 is what stands between words
SEED = 7
BATCH = 128


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code point: a to z have their own, other letters share the rest."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = ord(char.lower()[0])
            out[code] = low - 96 if 97 <= low <= 122 else 27 + (low * 2_654_435_761 >> 7) % (LETTERS - 27)
    return out


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters' vectors for the first, second and third place of a group."""
    plain = np.random.default_rng(SEED).integers(0, 2, (LETTERS, DIMENSIONS)).astype(np.int8) * 2 - 1
    return np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain


def group_vectors(groups: np.ndarray) -> np.ndarray:
    first, second, third = _letters()
    return first[groups >> 12] * second[(groups >> 6) & 63] * third[groups & 63]


def letter_groups(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The different groups of a whole text, and how often each is there."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.concatenate([[0], _kinds()[codes], [0]]).astype(np.int32)
    kinds = kinds[np.concatenate([[True], (kinds[1:] != 0) | (kinds[:-1] != 0)])]
    if len(kinds) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.unique((kinds[:-2] << 12) | (kinds[1:-1] << 6) | kinds[2:], return_counts=True)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a task's texts per language: groups are counted first and bound once."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            groups, times = letter_groups(text.as_py())
            if lang not in counts:
                counts[lang] = np.zeros(LETTERS**3, np.int64)
            counts[lang][groups] += times
    for lang, times in counts.items():
        total = np.zeros(DIMENSIONS, np.int64)
        groups = np.flatnonzero(times)
        for at in range(0, len(groups), 4096):
            part = groups[at : at + 4096]
            total += times[part] @ group_vectors(part).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {"lang": [lang], "total": pa.array([total], pa.list_(pa.int64()))}
        )


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text") -> dict[str, np.ndarray]:
    """The vector of each language in ``labelled``; rows without a language are left out.

    What comes to the driver is one vector per language, whatever the number of texts.
    """
    known = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sums = map_batches(known, _sums, "lang string, total array<bigint>")
    summed = (
        materialize(sums, "language_sums")
        .select("lang", F.posexplode("total").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
    )
    vectors: dict[str, np.ndarray] = {}
    for row in summed.toLocalIterator():
        vectors.setdefault(row["lang"], np.zeros(DIMENSIONS, np.int64))[row["at"]] = row["value"]
    return vectors


def _cosines(texts: list[str | None], profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of texts with unit profiles, and which texts have a letter."""
    found = [letter_groups(text) for text in texts]
    groups, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    table = np.zeros((len(texts), len(groups)), np.float32)
    rows = np.repeat(np.arange(len(texts)), [len(g) for g, _ in found])
    table[rows, where] = np.concatenate([t for _, t in found])
    vectors = table @ group_vectors(groups).astype(np.float32)
    lengths = np.linalg.norm(vectors.astype(np.float64), axis=1)
    cosines = vectors.astype(np.float64) @ profiles.T / np.maximum(lengths, 1e-9)[:, None]
    return cosines, np.array([len(g) > 0 for g, _ in found])


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, profiles = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                langs, scores = ["und"] * part.num_rows, [0.0] * part.num_rows
                if names:
                    cosines, lettered = _cosines(part.column(2).to_pylist(), profiles)
                    best = cosines.argmax(axis=1)
                    for k in np.flatnonzero(lettered).tolist():
                        langs[k] = names[best[k]]
                        scores[k] = round(min(1.0, max(0.0, float(cosines[k, best[k]]))), 6)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs`` (``doc_id, text, lang``).

    Languages are learnt from the rows outside the held-out fold that have one; a null
    doc_id is neither learnt from nor held out. A text that is null or has no letter is
    ``und`` with score 0, as is every text if nothing could be learnt. Of equal cosines the
    language first in the alphabet wins.
    """
    out = is_held_out(F.col("doc_id"), folds)
    vectors = learn(docs.where(F.col("doc_id").isNotNull() & ~out))
    usable = sorted(name for name, v in vectors.items() if v.any())
    profiles = np.array([vectors[n] / np.linalg.norm(vectors[n]) for n in usable]).reshape(-1, DIMENSIONS)
    model = docs.sparkSession.sparkContext.broadcast((usable, profiles))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), "text")
    return map_batches(plain, _predict(model), "doc_id bigint, held_out boolean, lang_pred string, score double")
