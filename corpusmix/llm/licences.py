"""Licence notices in texts, found with one suffix automaton over all templates.

The automaton holds every run of words of every template. Words of a text are streamed through it, which gives
at each place the longest run that ends there and is in some template (matching statistics). Runs that cannot be
made longer and have enough words are chained per template, in the order of text and template, over
short gaps; a chain that covers enough of its template is a span of that licence. A phrase is a template that
counts wherever all its words stand together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.llm.common import map_batches, slices

LEAST_MATCH = 4  # words of a run that is chained
MOST_GAP = 8  # words of the text between two runs of a chain
LEAST_SHARE = 0.75  # of a template's words under a chain

# Characters that part words, and the phrases, by the query's contract.
WORD_MARKS = r"[\x00-/:-`{-\x7f]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices that licences give for use in files, in their own words.
NOTICES = {
    "agpl-3.0": (
        "GNU Affero General Public License version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "gpl-2.0": ("licensed under the GNU General Public License, version 2",),
    "gpl-3.0": (
        "licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    "lgpl": ("GNU Lesser General Public License as published by the Free Software Foundation",),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "mpl-2.0": ("subject to the terms of the Mozilla Public License, v. 2.0",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}

RESULT = (
    "n_words bigint, places array<struct<label: string, first_word: bigint>>, "
    "spans array<struct<label: string, first_word: bigint, last_word: bigint, share: double>>"
)


def flat_words(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """All words of texts in a row, A-Z lower-cased, and how many each text has."""
    low = pc.ascii_lower(pa.array([text or "" for text in texts], pa.large_string()))
    spaced = pc.utf8_trim(pc.replace_substring_regex(low, WORD_MARKS, " "), " ")
    split = pc.split_pattern(spaced, " ")
    words = split.flatten()
    none = pc.equal(spaced, "").to_numpy(zero_copy_only=False)  # these give one empty word
    return words.filter(pc.not_equal(words, "")), np.diff(split.offsets.to_numpy()) - none


class SuffixAutomaton:
    """All runs of the given sequences; a state's runs end at the same places of the same sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest, self.ends = [-1], [0], [[]]
        for number, sequence in enumerate(sequences):
            state = 0
            for at, word in enumerate(sequence):
                state = self._append(state, word)
                self.ends[state].append((number, at))
        self._tour()

    def _add(self, longest: int, link: int, following: dict[int, int]) -> int:
        self.next.append(dict(following))
        self.link.append(link)
        self.longest.append(longest)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, source: int, word: int) -> int:
        """The state after ``word`` that has just the runs of ``source`` and shorter ones before it."""
        target = self.next[source][word]
        if self.longest[target] == self.longest[source] + 1:
            return target
        apart = self._add(self.longest[source] + 1, self.link[target], self.next[target])
        self.link[target] = apart
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = apart
            source = self.link[source]
        return apart

    def _append(self, last: int, word: int) -> int:
        if word in self.next[last]:  # another sequence has begun like this
            return self._split(last, word)
        made = self._add(self.longest[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = made
            last = self.link[last]
        if last >= 0:
            self.link[made] = self._split(last, word)
        return made

    def _tour(self) -> None:
        """Puts the places of all sequences in an order in which each state's are side by side."""
        below: list[list[int]] = [[] for _ in self.link]
        for state in range(1, len(self.link)):
            below[self.link[state]].append(state)
        self.order: list[tuple[int, int]] = []
        self.first, self.last = [0] * len(self.link), [0] * len(self.link)
        stack = [(0, False)]
        while stack:
            state, done = stack.pop()
            if done:
                self.last[state] = len(self.order)
                continue
            self.first[state] = len(self.order)
            self.order.extend(self.ends[state])
            stack.append((state, True))
            stack.extend((child, False) for child in below[state])

    def places(self, state: int) -> list[tuple[int, int]]:
        """``(sequence, last place)`` of the state's runs."""
        return self.order[self.first[state] : self.last[state]]

    def stream(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: per word the state and length of the longest run that ends with it."""
        state = length = 0
        following, link, longest = self.next, self.link, self.longest
        for word in words:
            while state and word not in following[state]:
                state = link[state]
                length = longest[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            yield state, length


@dataclass(frozen=True)
class Scanner:
    """The automaton of a set of templates, with what is known of its states beforehand."""

    numbers: dict[str, int]
    labels: list[str]
    lengths: list[int]
    phrases: int
    automaton: SuffixAutomaton
    phrase_ends: list[tuple[tuple[int, int], ...]]
    pairs: np.ndarray

    @classmethod
    def of(cls, notices: Mapping[str, tuple[str, ...]], phrases: Mapping[str, str]) -> Scanner:
        texts = [(label, phrase) for phrase, label in phrases.items()]
        texts += [(label, text) for label in sorted(notices) for text in notices[label]]
        numbers: dict[str, int] = {}
        sequences = []
        for _, text in texts:
            words = flat_words([text])[0].to_pylist()
            if len(words) < 2:
                raise ValueError(f"a template needs two words or more, not {text!r}")
            sequences.append([numbers.setdefault(word, len(numbers)) for word in words])
        automaton = SuffixAutomaton(sequences)
        # Which phrases are at the end of a state's runs: its own, and those of the states it links to.
        own: list[list[tuple[int, int]]] = [[] for _ in automaton.next]
        for phrase, sequence in enumerate(sequences[: len(phrases)]):
            state = 0
            for word in sequence:
                state = automaton.next[state][word]
            own[state].append((phrase, len(sequence)))
        found: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        for state in sorted(range(1, len(own)), key=automaton.longest.__getitem__):
            found[state] = (*own[state], *found[automaton.link[state]])
        pairs = {a * len(numbers) + b for s in sequences for a, b in zip(s, s[1:])}
        labels, lengths = [label for label, _ in texts], [len(s) for s in sequences]
        return cls(numbers, labels, lengths, len(phrases), automaton, found, np.array(sorted(pairs)))

    def stretches(self, words: pa.Array, lengths: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """``text, first word, numbers`` of the stretches in which each two neighbours are in a template.

        Runs of two words or more lie within them, so nothing else needs to be streamed.
        """
        listed = words.dictionary_encode()
        known = np.array([self.numbers.get(word, -1) for word in listed.dictionary.to_pylist()], dtype=np.int64)
        if not len(known):
            return
        numbers = known[listed.indices.to_numpy()]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        text = np.repeat(np.arange(len(lengths)), lengths)
        together = (numbers[:-1] >= 0) & (numbers[1:] >= 0) & (text[:-1] == text[1:])
        at = np.flatnonzero(together)
        at = at[np.isin(numbers[at] * len(self.numbers) + numbers[at + 1], self.pairs)]
        if not len(at):
            return
        for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
            which = int(text[part[0]])
            yield which, int(part[0] - starts[which]), numbers[part[0] : part[-1] + 2].tolist()

    def scan(self, first: int, numbers: list[int], places: list, runs: list) -> None:
        """Adds the phrases of a stretch, and its runs that cannot be made longer, as word places of the text."""
        before = (0, 0)
        for at, (state, length) in enumerate(self.automaton.stream(numbers), start=first):
            for phrase, words in self.phrase_ends[state]:
                if words <= length:
                    places.append((self.labels[phrase], at - words + 1))
            if length <= before[1]:
                runs.append((at - before[1], *before))
            before = (state, length)
        runs.append((first + len(numbers) - before[1], *before))

    def chains(
        self, runs: list[tuple[int, int, int]], least_match: int, most_gap: int, least_share: float
    ) -> list[tuple[str, int, int, float]]:
        """Spans ``label, first word, last word, share`` that runs (``first word, state, words``) make up.

        Each run goes on the chain of its template that covers most, among those that end within reach before
        it in the text and in the template, or begins a chain. What is within reach is bounded by the template's length.
        """
        ending: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, list[tuple[int, int, int]]] = {}
        for start, state, length in runs:
            if length < 2:
                continue
            last = start + length - 1
            for template, end in self.automaton.places(state):
                size = self.lengths[template]
                # A short template counts as one run when it is whole.
                if template < self.phrases or length < min(least_match, size):
                    continue
                near = [chain for chain in ending.get(template, ()) if chain[1] >= start - most_gap - 1]
                covered, first = length, start
                for begun, stop, upto, words in near:
                    longer = words + min(length, end - upto, last - stop)
                    if upto < end and stop < last and longer > covered:
                        covered, first = longer, begun
                near.append((first, last, end, covered))
                ending[template] = near
                if covered >= least_share * size:
                    _take(taken.setdefault(template, []), (first, last, covered))
        spans = [
            (self.labels[template], first, last, covered / self.lengths[template])
            for template, chains in taken.items()
            for first, last, covered in chains
        ]
        return sorted(spans, key=lambda span: (span[1], span[2], span[0], span[3]))


def _take(taken: list[tuple[int, int, int]], chain: tuple[int, int, int]) -> None:
    """Adds a chain of a template; of chains on the same words the one that covers most stays."""
    while taken and taken[-1][1] >= chain[0]:
        if taken[-1][2] >= chain[2]:
            return
        taken.pop()
    taken.append(chain)


def scan_texts(
    scanner: Scanner, texts: list[str | None], least_match: int, most_gap: int, least_share: float
) -> Iterator[tuple[int, list, list]]:
    """Per text its words, phrase places and spans."""
    words, lengths = flat_words(texts)
    places: dict[int, list] = {}
    runs: dict[int, list] = {}
    for which, first, numbers in scanner.stretches(words, lengths):
        scanner.scan(first, numbers, places.setdefault(which, []), runs.setdefault(which, []))
    for which, n_words in enumerate(lengths.tolist()):
        spans = scanner.chains(runs[which], least_match, most_gap, least_share) if which in runs else []
        yield n_words, places.get(which, []), spans


def find_licences(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    notices: Mapping[str, tuple[str, ...]] = NOTICES,
    phrases: Mapping[str, str] = PHRASES,
    least_match: int = LEAST_MATCH,
    most_gap: int = MOST_GAP,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``key, n_words, places, spans`` of each row; other columns of ``docs`` are not read.

    ``places`` lists each phrase with its first word, ``spans`` each covered template with its first and last
    word and the covered share. A null or empty text has no words and empty lists, repeated rows have one result each, a null
    key stays null, and an empty table gives an empty one. A text is streamed in memory of its own size.
    """
    scanner = Scanner.of(notices, phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))]
        span = [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())]
        kinds.append(pa.list_(pa.struct(span)))
        for batch in batches:
            rows = []
            for part in slices([t or "" for t in batch.column(1).to_pylist()]):
                rows.extend(scan_texts(scanner, part, least_match, most_gap, least_share))
            found = [
                [row[0] for row in rows],
                [[{"label": a, "first_word": b} for a, b in row[1]] for row in rows],
                [[dict(zip(("label", "first_word", "last_word", "share"), s)) for s in row[2]] for row in rows],
            ]
            columns = [batch.column(0), *[pa.array(values, kind) for values, kind in zip(found, kinds)]]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "places", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(key, text), run, f"`{key}` {kind}, {RESULT}")


def licence_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The phrase places and spans of ``find_licences`` in one line of counts and labels per row.

    ``score`` is the largest covered share of any span, 1 where a phrase stands, 0 where nothing was found.
    """
    base = F.col("places.label")
    first = F.col("places.first_word")
    score = F.greatest(F.array_max("spans.share"), F.when(F.size("places") > 0, 1.0), F.lit(0.0))
    return found.select(
        key,
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("spans.label"))), ",").alias("labels"),
        score.alias("score"),
    )
