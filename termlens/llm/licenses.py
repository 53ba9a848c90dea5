"""Licence scans with a generalised suffix automaton of licence tokens.

The licence templates and the base phrases, as word sequences, make one generalised suffix
automaton; it is small (a bounded parameter, not data) and travels to the tasks in the function.
Each text is streamed through it: after every word the automaton holds the longest suffix of
what was read that occurs in some template (the matching statistics).

* Base phrases: every place where a phrase ends is read off the automaton's state, whose suffix
  links lead to the phrases that are suffixes of the current match.
* Templates: matches of ``MIN_MATCH`` words or more that the next word does not prolong are laid
  over all their places in the templates and chained: in order in text and template, no more than
  ``MAX_GAP`` words apart in the text, overlaps counted once.  A chain that covers ``MIN_COVER`` of
  its template's words adds the template's label and a span.

A word that starts no two-word sequence of a template resets the automaton, so only stretches of
known word pairs are streamed; this changes no match of two words or more.

``score`` is the largest covered share of any template or phrase, 0 without a match.

Defined results: a null or empty text has no words, no labels and score 0; a repeated row is
judged on its own; an empty table gives no rows; other columns of the input, whatever their
names, are not read.  A very long text is cut into words a part at a time and kept as one code
of four bytes a word; matches run over the parts' ends.

Scale: map only.  No shuffle, no state beyond one text.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlens.llm.common import tidy

# --- fixed values: base phrases and licence notices, as their stewards publish them -----------
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
MIN_MATCH, MAX_GAP, MIN_COVER = 3, 8, 0.9
# ------------------------------------------------------------------------------------------------

PART_BYTES = 1 << 18
#: A-Z become a-z, digits and bytes of other scripts stay, everything else parts words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_parts(data: bytes, size: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lower case, from about ``size`` bytes of it at a time."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while True:
            piece = data[at:end].translate(FOLD)
            cut = len(piece) if end == len(data) else piece.rfind(b" ")
            if cut > 0 or end == len(data):
                break
            end = min(len(data), end + size)  # one word fills the part: read on
        yield piece[:cut].split()
        at += cut


class SuffixAutomaton:
    """Generalised suffix automaton of integer sequences, with the places of every substring."""

    def __init__(self, sequences: Sequence[Sequence[int]], phrases: Sequence[Sequence[int]] = ()):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        places: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate([*sequences, *phrases]):
            last = 0
            for end, symbol in enumerate(sequence, 1):
                last = self._extend(last, symbol, places)
                if k < len(sequences):
                    places[last].append((k, end))
        # what ends in a state also ends in every suffix of it
        for state in sorted(range(len(self.link)), key=self.longest.__getitem__, reverse=True):
            if self.link[state] > 0:
                places[self.link[state]].extend(places[state])
        self.places = [sorted(set(p)) for p in places]
        owned: dict[int, list[int]] = {}
        for k, phrase in enumerate(phrases):
            if phrase:
                owned.setdefault(self.state_of(phrase), []).append(k)
        #: phrases that are suffixes of a state's longest string, with their lengths
        self.suffixes: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for state in sorted(range(len(self.link)), key=self.longest.__getitem__):
            up = self.suffixes[self.link[state]] if self.link[state] > 0 else []
            self.suffixes[state] = [*up, *((k, len(phrases[k])) for k in owned.get(state, []))]

    def _new(self, longest: int, step: dict[int, int], link: int, places) -> int:
        self.step.append(step)
        self.longest.append(longest)
        self.link.append(link)
        places.append([])
        return len(self.link) - 1

    def _split(self, origin: int, symbol: int, places) -> int:
        """The state of the string ``origin + symbol`` alone: the target itself, or a copy of it
        that takes over the shorter strings."""
        target = self.step[origin][symbol]
        if self.longest[target] == self.longest[origin] + 1:
            return target
        copy = self._new(self.longest[origin] + 1, dict(self.step[target]), self.link[target], places)
        self.link[target] = copy
        while origin >= 0 and self.step[origin].get(symbol) == target:
            self.step[origin][symbol] = copy
            origin = self.link[origin]
        return copy

    def _extend(self, last: int, symbol: int, places) -> int:
        if symbol in self.step[last]:  # an earlier sequence holds this prefix
            return self._split(last, symbol, places)
        new = self._new(self.longest[last] + 1, {}, 0, places)
        at = last
        while at >= 0 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, symbol, places)
        return new

    def state_of(self, sequence: Sequence[int]) -> int:
        state = 0
        for symbol in sequence:
            state = self.step[state][symbol]
        return state

    def statistics(self, symbols: Sequence[int]) -> Iterator[tuple[int, int]]:
        """After each symbol: (state, length) of the longest suffix that occurs in a sequence."""
        state = length = 0
        step, link, longest = self.step, self.link, self.longest
        for symbol in symbols:
            while state and symbol not in step[state]:
                state = link[state]
                length = longest[state]
            if symbol in step[state]:
                state = step[state][symbol]
                length += 1
            yield state, length


class Scanner:
    """Phrases and templates made ready; ``scan`` judges one text."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]], min_match: int,
                 max_gap: int, min_cover: float):
        self.words: dict[bytes, int] = {}

        def code(text: str) -> list[int]:
            return [self.words.setdefault(w, len(self.words)) for part in word_parts(text.encode()) for w in part]

        self.phrase_labels = [label for label, _ in phrases]
        self.labels = [label for label, _ in templates]
        coded = [code(text) for _, text in templates]
        named = [code(text) for _, text in phrases]
        if not all(coded) or not all(named):
            raise ValueError("a template or phrase without a word")
        self.sizes = [len(c) for c in coded]
        self.follows = [[*c[1:], -1] for c in coded]
        self.automaton = SuffixAutomaton(coded, named)
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        # with a one-word phrase or match, single words count as well
        self.pairs = None
        if min([min_match, *map(len, named)]) >= 2:
            self.pairs = np.zeros((len(self.words) + 1, len(self.words) + 1), dtype=bool)  # last row: unknown
            for sequence in [*coded, *named]:
                self.pairs[sequence[:-1], sequence[1:]] = True

    def codes(self, data: bytes) -> np.ndarray:
        unknown = len(self.words)
        parts = []
        for words in word_parts(data):
            found = map(self.words.get, words)
            parts.append(np.fromiter((unknown if c is None else c for c in found), dtype=np.int32, count=len(words)))
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)

    def stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """The stretches of words a match may lie in."""
        if self.pairs is None:
            known = codes < len(self.words)
            last = 0
        else:
            known = self.pairs[codes[:-1], codes[1:]]
            last = 1
        edges = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            yield a, b + last

    def scan(self, data: bytes) -> dict:
        codes = self.codes(data)
        hits: list[list[int]] = [[] for _ in self.phrase_labels]
        best = [0] * len(self.labels)
        open_: list[list[tuple]] = [[] for _ in self.labels]  # chains that may go on: (text end, template end, covered, start)
        spans: list[list[tuple]] = [[] for _ in self.labels]
        suffixes = self.automaton.suffixes
        for a, b in self.stretches(codes):
            path = list(self.automaton.statistics(codes[a:b].tolist()))
            for i, (state, length) in enumerate(path):
                for k, size in suffixes[state]:
                    if size <= length:
                        hits[k].append(a + i + 1 - size)
                if length >= self.min_match:
                    after = int(codes[a + i + 1]) if i + 1 < len(path) else -2
                    self._lay(a + i + 1, state, length, after, open_, best, spans)
        labelled = sorted(
            (start, end, self.labels[t], covered / self.sizes[t])
            for t, found in enumerate(spans) for start, end, covered in found)
        base = {self.phrase_labels[k] for k, found in enumerate(hits) if found}
        starts = [s for found in hits for s in found]
        share = max((c / n for c, n in zip(best, self.sizes)), default=0.0)
        return {
            "n_words": len(codes), "n_base": len(starts), "first_word": min(starts, default=None),
            "last_word": max(starts, default=None), "base_labels": sorted(base),
            "labels": sorted(base | {s[2] for s in labelled}), "score": 1.0 if base else min(1.0, share),
            "spans": [{"label": s[2], "first": s[0], "last": s[1] - 1, "share": s[3]} for s in labelled]}

    def _lay(self, end: int, state: int, length: int, after: int, open_, best, spans) -> None:
        """Lay what ends here over its places in the templates: a place that the next word does
        not prolong takes the longest suffix of the match that ends there."""
        seen: set[tuple[int, int]] = set()
        while length >= self.min_match:
            for place in self.automaton.places[state]:
                if place not in seen:
                    seen.add(place)
                    t, to = place
                    if self.follows[t][to - 1] != after:
                        self._chain(end - length, end, t, to, open_, best, spans)
            state = self.automaton.link[state]
            length = self.automaton.longest[state]

    def _chain(self, start: int, end: int, t: int, to: int, open_, best, spans) -> None:
        """Prolong the best chain the match can follow."""
        since = to - (end - start)
        # no later match of this template starts before ``end`` less its words
        open_[t] = [c for c in open_[t] if end - self.sizes[t] - c[0] <= self.max_gap]
        covered, first = end - start, start
        for c_end, c_to, c_covered, c_first in open_[t]:
            fresh = end - max(start, c_end, start + c_to - since)
            if start - c_end <= self.max_gap and c_end <= end and c_to <= to and fresh > 0 and c_covered + fresh > covered:
                covered, first = c_covered + fresh, c_first
        open_[t].append((end, to, covered, first))
        best[t] = max(best[t], covered)
        if covered >= self.min_cover * self.sizes[t]:
            if spans[t] and first < spans[t][-1][1]:  # the chain goes on: one span, the largest cover
                old = spans[t].pop()
                first, covered = min(first, old[0]), max(covered, old[2])
            spans[t].append((first, end, covered))


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, score double, spans array<struct<label: string, first: long, last: long, share: double>>")
ARROW = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                                  ("share", pa.float64())])))])


def scan(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
         templates: Sequence[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
         min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) per row."""
    scanner = Scanner(phrases, templates, min_match, max_gap, min_cover)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[Mapping] = [scanner.scan(t.as_py() or b"") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[c.name] for f in found], c.type) for c in ARROW)],
                names=["doc_id", *ARROW.names])

    return rows.mapInArrow(tidy(run), f"doc_id {dict(rows.dtypes)['doc_id']}, {SCHEMA}")
