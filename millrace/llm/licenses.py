"""License scans by matching statistics in a generalised suffix automaton.

The automaton holds every run of words of the license templates.  A text is
streamed through it: after each word it knows the longest run ending there that
some template has, and where.  Runs that cannot grow are matches; long ones
are chained, template by template, into spans in which text and template go on
in the same order, and a span that covers enough of its template names its
license, edited copies included.  Short phrases are templates that must be
covered whole.

Only stretches of a text in which all neighbouring words are neighbours in
some template can hold a match of two words or more, so the rest is passed over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a match that counts for a chain; words a chain may pass over in text or template; share of a template a span must cover.
LONG, GAP, SHARE = 4, 12, 0.6

# ---- fixed values: phrases that name a license, and passages of public license texts

PHRASES = (
    ("mit", "MIT License"),
    ("apache", "Apache License"),
    ("gpl", "General Public License"),
)

TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"""),
    ("mit", """The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software"""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at"""),
    ("apache", """Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
        License for the specific language governing permissions and limitations under the License"""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version"""),
    ("gpl", """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details"""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
        your option) any later version"""),
    ("agpl", """under the terms of the GNU Affero General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met"""),
    ("bsd", """Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer"""),
    ("bsd", """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at"""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means"""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

# ----

Passages = Sequence[tuple[str, str]]

# ASCII letters in lower case and digits stay, bytes of other characters too; all else ends a word.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SPANS = "struct<n_words:long,spans:array<struct<label:string,phrase:boolean,first:long,last:long,covered:long,share:double>>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_BYTES).split()


class Automaton:
    """Generalised suffix automaton of word numbers: transitions, suffix links, longest runs and their places."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Of each state the sequences and end positions at which its runs occur.
        self.places: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for position, symbol in enumerate(sequence):
                last = self._extend(last, symbol)
                self.places[last].append((number, position))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]].extend(self.places[state])

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.places.append([])
        return len(self.next) - 1

    def _split(self, state: int, symbol: int) -> int:
        """The state of the run one longer than ``state``'s by a symbol it has; a copy if that state holds longer runs too."""
        target = self.next[state][symbol]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            return self._split(last, symbol)
        made = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and symbol not in self.next[state]:
            self.next[state][symbol] = made
            state = self.link[state]
        if state >= 0:
            self.link[made] = self._split(state, symbol)
        return made

    def statistics(self, symbols: Sequence[int]) -> tuple[list[int], list[int]]:
        """After each symbol the length of the longest run ending there, and its state."""
        state = length = 0
        lengths, states = [], []
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.next[state]:
                state, length = self.next[state][symbol], length + 1
            lengths.append(length)
            states.append(state)
        return lengths, states


class Scanner:
    """Finds phrases and template spans in texts."""

    def __init__(self, phrases: Passages, templates: Passages):
        passages = [words_of(text.encode()) for _, text in (*phrases, *templates)]
        if any(len(words) < 2 for words in passages):
            raise ValueError("phrases and templates have two words or more")
        self.labels = [label for label, _ in (*phrases, *templates)]
        self.phrases, self.sizes = len(phrases), [len(words) for words in passages]
        vocabulary = {word: k for k, word in enumerate(dict.fromkeys(w for words in passages for w in words))}
        self.number, self.unknown = vocabulary, len(vocabulary)
        sequences = [[vocabulary[w] for w in words] for words in passages]
        self.automaton = Automaton(sequences)
        # Neighbours in some passage, and in some phrase.
        self.neighbours = np.zeros((self.unknown + 1,) * 2, bool)
        self.named = self.neighbours.copy()
        for k, sequence in enumerate(sequences):
            self.neighbours[sequence[:-1], sequence[1:]] = True
            if k < self.phrases:
                self.named[sequence[:-1], sequence[1:]] = True
        # A phrase's own state, and so every state whose runs end with it.
        self.ending: list[list[int]] = [[] for _ in self.automaton.link]
        for k, sequence in enumerate(sequences[: self.phrases]):
            state = 0
            for symbol in sequence:
                state = self.automaton.next[state][symbol]
            self.ending[state].append(k)
        for state in sorted(range(1, len(self.ending)), key=self.automaton.length.__getitem__):
            self.ending[state] = self.ending[state] + self.ending[self.automaton.link[state]]

    def stretches(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """First word and end of the stretches that can hold a phrase or a long match."""
        pairs = self.neighbours[numbers[:-1], numbers[1:]]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], pairs, [False]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return []
        named = np.concatenate([[0], np.cumsum(self.named[numbers[:-1], numbers[1:]])])
        kept = (ends - starts + 1 >= LONG) | (named[ends] > named[starts])
        return [(int(a), int(b) + 1) for a, b in zip(starts[kept], ends[kept], strict=True)]

    def scan(self, text: bytes | None) -> tuple[int, list[dict]]:
        """The number of words, and the spans: phrases first, then templates, each by place."""
        words = words_of(text)
        get, unknown = self.number.get, self.unknown
        numbers = np.fromiter((get(word, unknown) for word in words), np.int64, len(words))
        found, matches = [], {}
        for start, end in self.stretches(numbers) if len(words) > 1 else []:
            lengths, states = self.automaton.statistics(numbers[start:end].tolist())
            for k, (length, state) in enumerate(zip(lengths, states, strict=True)):
                at = start + k
                for phrase in self.ending[state]:
                    if self.sizes[phrase] <= length:
                        found.append((phrase, at - self.sizes[phrase] + 1, at, self.sizes[phrase]))
                if length >= LONG and (k + 1 == len(lengths) or lengths[k + 1] <= length):
                    for passage, place in self.automaton.places[state]:
                        if passage >= self.phrases:
                            matches.setdefault(passage, []).append((at - length + 1, at, place, length))
        spans = [self._span(*one) for one in sorted(found)]
        for passage in sorted(matches):
            spans += [self._span(passage, *one) for one in chains(matches[passage]) if one[2] >= SHARE * self.sizes[passage]]
        return len(words), spans

    def _span(self, passage: int, first: int, last: int, covered: int) -> dict:
        return {"label": self.labels[passage], "phrase": passage < self.phrases, "first": first, "last": last,
                "covered": covered, "share": covered / self.sizes[passage]}


def chains(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (first word, last word, words covered) of one template from matches (first, last, last place in it, length).

    Matches of a chain go on in text and template alike, with ``GAP`` words at
    most between them; overlaps count once.  Of the chains with one beginning the one
    that covers most stays.
    """
    matches = sorted(matches, key=lambda m: (m[1], m[2]))
    best: list[tuple[int, int]] = []  # words covered and first match of the best chain that ends with each match
    oldest, widest = 0, max((m[3] for m in matches), default=0)
    for j, (first, last, place, length) in enumerate(matches):
        covered, root = length, j
        while matches[oldest][1] < last - widest - GAP:
            oldest += 1
        for i in range(oldest, j):
            _, end, end_place, _ = matches[i]
            fresh = min(last - max(first - 1, end), place - max(place - length, end_place))
            if end < last and end_place < place and first - end <= GAP + 1 and place - length - end_place <= GAP and fresh > 0:
                if best[i][0] + fresh > covered:
                    covered, root = best[i][0] + fresh, best[i][1]
        best.append((covered, root))
    ends: dict[int, int] = {}
    for j, (covered, root) in enumerate(best):
        if root not in ends or covered > best[ends[root]][0]:
            ends[root] = j
    return sorted((matches[root][0], matches[j][1], best[j][0]) for root, j in ends.items())


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(phrases, templates)


def with_licenses(docs: DataFrame, into: str = "licenses", phrases: Passages = PHRASES, templates: Passages = TEMPLATES) -> DataFrame:
    """The documents with a struct column: n_words, and spans as label, phrase, first, last, covered, share.

    ``docs`` needs a ``text`` (null and empty: no words, no spans); other
    columns stay, but for one called ``into``, which is replaced.  Words are
    numbered from 0 in the whole text.  A phrase has a span at each of its
    places; a template's spans cover ``SHARE`` of its words or more.  Rows that
    repeat give the same spans each; an empty table gives no rows.  The
    templates go to the tasks and are no larger than what the caller passes.
    """
    own = tuple(phrases), tuple(templates)
    Scanner(*own)  # a template that is too short fails here, not in a task

    @F.pandas_udf(SPANS)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        scanner = _scanner(*own)
        made = [scanner.scan(text) for text in texts]
        return pd.DataFrame({"n_words": [n for n, _ in made], "spans": [spans for _, spans in made]})

    return docs.withColumn(into, scanned(F.col("text").cast("binary")))
