"""License scans with a generalised suffix automaton.

The words of all license templates make one automaton, which accepts every run
of words that stands in any of them. A text streams through it; after each word
the automaton knows the longest run that ends there and stands in a template:
the matching statistics. The suffix links lead to the shorter runs that end
there and stand elsewhere, so every template gets the runs it shares with the
text itself. Those that follow each other in text and template are chained into
spans, and a template counts as found when enough of it is covered.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Statements and notices of public licenses, and their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at http www apache org licenses "
        "license 2 0 unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied see the license for the specific language governing permissions and limitations "
        "under the license",
        "apache-2.0",
    ),
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions the above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the software",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted provided that the above copyright notice and this permission notice appear in "
        "all copies",
        "isc",
    ),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        "gpl",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
)

#: Words of the shortest run that takes part in a chain.
LEAST_RUN = 3
#: Words of the text that a chain may skip between two runs.
MOST_GAP = 12
#: Part of a template that a chain has to cover.
LEAST_COVER = 0.7

_WORD_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
)
_FOUND = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, spans string"
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of ASCII letters and digits, folded, and of all other characters."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


@dataclass(frozen=True)
class Span:
    """Words ``start`` to ``end`` of a text that hold a template."""

    start: int
    end: int
    template: int
    cover: float


class Automaton:
    """Generalised suffix automaton over the words of several templates."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases, self.templates = tuple(phrases), tuple(templates)
        texts = [words_of(text) for text, _ in (*self.phrases, *self.templates)]
        self.lengths = [len(words) for words in texts]
        names = sorted({word for words in texts for word in words})
        self.number = dict(zip(names, range(len(names))))
        coded = [[self.number[word] for word in words] for words in texts]
        self._next: list[dict[int, int]] = [{}]
        self._link, self._length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        self._ends = ends
        for which, words in enumerate(coded):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                ends[last].add((which, place + 1))
        for state in sorted(range(len(self._link)), key=self._length.__getitem__, reverse=True):
            if self._link[state] > 0:
                ends[self._link[state]] |= ends[state]
        self._read_off(coded)

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self._next.append(follow)
        self._length.append(length)
        self._link.append(link)
        self._ends.append(set())
        return len(self._link) - 1

    def _extend(self, last: int, word: int) -> int:
        """Add ``word`` after the run of state ``last``; returns the state of the longer run."""
        there = self._next[last].get(word)
        if there is not None and self._length[there] == self._length[last] + 1:
            return there
        if there is not None:
            return self._cut(last, word, there)
        state = self._state(self._length[last] + 1, {}, 0)
        while last != -1 and word not in self._next[last]:
            self._next[last][word] = state
            last = self._link[last]
        if last != -1:
            there = self._next[last][word]
            whole = self._length[there] == self._length[last] + 1
            self._link[state] = there if whole else self._cut(last, word, there)
        return state

    def _cut(self, last: int, word: int, there: int) -> int:
        """Give the shorter runs of state ``there`` a state of their own."""
        copy = self._state(self._length[last] + 1, dict(self._next[there]), self._link[there])
        self._link[there] = copy
        while last != -1 and self._next[last].get(word) == there:
            self._next[last][word] = copy
            last = self._link[last]
        return copy

    def _read_off(self, coded: list[list[int]]) -> None:
        """Tables for scanning: which phrases end at a state, and which word pairs occur."""
        final = {}
        for which in range(len(self.phrases)):
            state = 0
            for word in coded[which]:
                state = self._next[state][word]
            final.setdefault(state, []).append(which)
        self._phrases_at: list[tuple[int, ...]] = []
        for state in range(len(self._link)):
            found, above = [], state
            while above > 0:
                found += final.get(above, [])
                above = self._link[above]
            self._phrases_at.append(tuple(found))
        size = len(self.number)
        self._pairs = np.zeros(size * size, bool)
        for words in coded:
            for one, two in zip(words, words[1:]):
                self._pairs[one * size + two] = True
        # The word after each place of a text, -2 after the last.
        self._follow = [[*words, -2] for words in coded]
        self._matches: dict[int, tuple[tuple[int, int, int, int], ...]] = {}

    def _matches_at(self, state: int) -> tuple[tuple[int, int, int, int], ...]:
        """Places of the templates that share a run with ``state``: (template, end, most words, word after)."""
        found = self._matches.get(state)
        if found is None:
            longest: dict[tuple[int, int], int] = {}
            above = state
            while above > 0 and self._length[above] >= LEAST_RUN:
                for place in self._ends[above]:
                    if place[0] >= len(self.phrases):
                        longest.setdefault(place, self._length[above])
                above = self._link[above]
            found = tuple((which, end, most, self._follow[which][end]) for (which, end), most in sorted(longest.items()))
            self._matches[state] = found
        return found

    def scan(
        self, words: list[bytes]
    ) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
        """Places of the phrases, the maximal runs, and the matches of single templates.

        Phrases are (start, phrase), runs (start, length, state), and matches
        (start, length, template, end in the template). A match is as long as text
        and template agree at that place, whatever other templates go on with.
        """
        phrases: list[tuple[int, int]] = []
        runs: list[tuple[int, int, int]] = []
        matches: list[tuple[int, int, int, int]] = []
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int32, len(words))
        known = ids >= 0
        both = np.flatnonzero(known[:-1] & known[1:])
        both = both[self._pairs[ids[both] * len(self.number) + ids[both + 1]]]
        if not len(both):
            return phrases, runs, matches
        # Only stretches of word pairs that occur in a template can match two words or more.
        breaks = np.flatnonzero(np.diff(both) > 1) + 1
        for stretch in np.split(both, breaks):
            first, last = int(stretch[0]), int(stretch[-1]) + 1
            state = length = 0
            part = [*ids[first : last + 1].tolist(), -1]
            for place, word in enumerate(part[:-1], first):
                if word not in self._next[state]:
                    if length >= LEAST_RUN:
                        runs.append((place - length, length, state))
                    while state and word not in self._next[state]:
                        state = self._link[state]
                        length = self._length[state]
                state = self._next[state].get(word, 0)
                length = length + 1 if state else 0
                for phrase in self._phrases_at[state]:
                    if self.lengths[phrase] <= length:
                        phrases.append((place + 1 - self.lengths[phrase], phrase))
                if length >= LEAST_RUN:
                    after = part[place + 1 - first]
                    for template, end, most, goes_on in self._matches_at(state):
                        if goes_on != after:
                            shared = min(length, most)
                            matches.append((place + 1 - shared, shared, template, end))
            if length >= LEAST_RUN:
                runs.append((last + 1 - length, length, state))
        return phrases, runs, matches

    def chain(self, matches: list[tuple[int, int, int, int]]) -> list[Span]:
        """Matches that follow each other in text and template, where they cover enough of it.

        Every match ends the chain that covers most of its template, of those that
        it can continue or begin. Spans of one template do not overlap: the one
        that covers most comes first, then the shorter one.
        """
        chains: dict[int, list[tuple[int, int, int, int]]] = {}  # text end, template end, covered, text start
        for start, length, template, end in matches:
            text_end = start + length
            known = chains.setdefault(template, [])
            covered, text_start = length, start
            for before in reversed(known):
                if start - before[0] > MOST_GAP:
                    break
                fresh = min(length, end - before[1], text_end - before[0])
                if fresh > 0 and (before[2] + fresh, before[3]) > (covered, text_start):
                    covered, text_start = before[2] + fresh, before[3]
            known.append((text_end, end, covered, text_start))
        spans: list[Span] = []
        for template, known in chains.items():
            size = self.lengths[template]
            enough = [(-covered, end - start, start, end) for end, _, covered, start in known if covered / size >= LEAST_COVER]
            taken: list[tuple[int, int]] = []
            for covered, _, start, end in sorted(enough):
                at = bisect_left(taken, (end,))
                if at and taken[at - 1][1] > start:
                    continue
                taken.insert(at, (start, end))
                spans.append(Span(start, end, template - len(self.phrases), -covered / size))
        return sorted(spans, key=lambda span: (span.start, span.template))


@lru_cache(maxsize=4)
def automaton(phrases: tuple, templates: tuple) -> Automaton:
    return Automaton(phrases, templates)


def scan_text(text: str | None, phrases=PHRASES, templates=TEMPLATES):
    """Words, phrase places and template spans of one text."""
    machine = automaton(phrases, templates)
    words = words_of(text)
    places, _, matches = machine.scan(words)
    return len(words), sorted(places), machine.chain(matches)


def _scanner(phrases: tuple, templates: tuple):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for text in batch.column(1):
                count, places, spans = scan_text(text.as_py(), phrases, templates)
                starts = [start for start, _ in places]
                base = {phrases[phrase][1] for _, phrase in places}
                labels = base | {templates[span.template][1] for span in spans}
                score = max([0.5 if base else 0.0, *(span.cover for span in spans)])
                row = (
                    count,
                    len(places),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(base)),
                    ",".join(sorted(labels)),
                    score,
                    ",".join(f"{templates[s.template][1]}:{s.start}:{s.end}" for s in spans),
                )
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(column, kind) for column, kind in zip(columns, kinds)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    return scan


def scan_licenses(
    docs: DataFrame,
    phrases: tuple = PHRASES,
    templates: tuple = TEMPLATES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Scan whole texts: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``n_base`` counts all places of the phrases, overlapping ones included;
    ``first_word`` and ``last_word`` are the smallest and largest of their
    starts, null without any. ``labels`` adds those of the covered templates,
    ``spans`` says where as label:first word:word after the last. ``score`` is
    the best cover, 0.5 at least with a phrase. One row per input row; other
    columns are left out; null and empty texts have no words.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scanner(tuple(phrases), tuple(templates)), _FOUND)
