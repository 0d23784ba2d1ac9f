"""License scans: matching statistics against a generalised suffix automaton.

The automaton holds the token sequences of all templates and base phrases. A text
is streamed through it word by word: after each word the state tells the longest
suffix of the text so far that stands in some template. Maximal matches of
``MIN_MATCH`` or more words are chained in order, within ``MAX_GAP`` words, into
spans of a template; a template covered to ``MIN_COVER`` gives its label. A base
phrase is found where the state holds it as a suffix of its match.

Words are runs of digits, letters and non-ASCII characters with A-Z lowered.
Null texts are empty: no words, null places, empty labels, score 0. The score is
the largest share of a template that a chain covers; a base phrase covers itself.
Extra columns are ignored, repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import alnum_or_high, hashed_words

MIN_MATCH = 5
MAX_GAP = 12
MIN_COVER = 0.5

# The base phrases and passages of public licenses, by label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label: string, first_word: bigint, last_word: bigint, cover: double>>"
)


def words(text: str) -> list[str]:
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


class SuffixAutomaton:
    """Generalised suffix automaton of several token sequences.

    ``ends[state]`` lists ``(sequence, end)`` of every place where the state's
    strings end.
    """

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate(sequences):
            state = 0
            for i, token in enumerate(sequence):
                state = self._extend(state, token)
                self.ends[state].append((k, i + 1))
        # Longer states hand their places up the suffix links.
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]

    def _new(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, state: int, token: int, to: int) -> int:
        """The state for ``state``'s string and ``token`` alone, cut off from ``to``."""
        if self.length[to] == self.length[state] + 1:
            return to
        clone = self._new(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = clone
        while state >= 0 and self.next[state].get(token) == to:
            self.next[state][token] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token, self.next[last][token])
        new = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, token, self.next[state][token])
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """After each token: length of the longest suffix found in a sequence, and its state."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.next[state].get(token)
            if to is None:
                state = length = 0
            else:
                state, length = to, length + 1
            yield length, state


class Scanner:
    """Automaton, vocabulary and templates; made once in each worker."""

    def __init__(self) -> None:
        texts = [words(text) for _, text in TEMPLATES] + [p.split() for p, _ in PHRASES]
        self.labels = [label for label, _ in TEMPLATES]
        self.sizes = [len(t) for t in texts]
        vocabulary = sorted({w for t in texts for w in t})
        hashes = next(hashed_words(pa.array([" ".join(vocabulary)]), alnum_or_high()))[3]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        number = {w: i for i, w in enumerate(vocabulary)}
        self.automaton = SuffixAutomaton([[number[w] for w in t] for t in texts])
        n = len(TEMPLATES)
        self.phrases: list[list[int]] = [[] for _ in self.automaton.link]
        for p, (phrase, _) in enumerate(PHRASES):
            state = 0
            for w in phrase.split():
                state = self.automaton.next[state][number[w]]
            # Every state whose strings all end with the phrase lies below its state.
            for s in range(len(self.phrases)):
                t = s
                while t > 0 and t != state:
                    t = self.automaton.link[t]
                if t == state:
                    self.phrases[s].append(p)
        self.places = [[(k, e) for k, e in ends if k < n] for ends in self.automaton.ends]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word hash, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def scan(self, numbers: np.ndarray) -> tuple:
        """Result columns for the word numbers of one text."""
        known = np.flatnonzero(numbers >= 0)
        base: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []  # start, end, state
        if len(known):
            breaks = np.flatnonzero(np.diff(known) > 1)
            starts = known[np.concatenate(([0], breaks + 1))]
            ends = known[np.concatenate((breaks, [len(known) - 1]))] + 1
            long = ends - starts > 1  # the shortest phrase has two words
            for start, end in zip(starts[long].tolist(), ends[long].tolist()):
                self._stream(start, numbers[start:end].tolist(), base, matches)
        spans = self._chains(matches)
        base_labels = sorted({PHRASES[p][1] for p, _ in base})
        good = [s for s in spans if s["cover"] >= MIN_COVER]
        labels = sorted({*base_labels, *(s["label"] for s in good)})
        starts = [start for _, start in base]
        score = 1.0 if base else max((s["cover"] for s in spans), default=0.0)
        first, last = (min(starts), max(starts)) if starts else (None, None)
        return len(numbers), len(base), first, last, ",".join(base_labels), ",".join(labels), score, good

    def _stream(self, offset: int, tokens: list[int], base: list, matches: list) -> None:
        before = (0, 0)
        for i, (length, state) in enumerate(self.automaton.statistics(tokens)):
            if before[0] >= MIN_MATCH and length != before[0] + 1:
                matches.append((offset + i - before[0], offset + i, before[1]))
            for p in self.phrases[state]:
                size = self.sizes[len(TEMPLATES) + p]
                if length >= size:
                    base.append((p, offset + i + 1 - size))
            before = (length, state)
        if before[0] >= MIN_MATCH:
            matches.append((offset + len(tokens) - before[0], offset + len(tokens), before[1]))

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of matches that follow each other in the text and in a template."""
        spans, open_chains = [], {}
        for start, end, state in matches:
            for k, template_end in self.places[state]:
                template_start = template_end - (end - start)
                chain = open_chains.get(k)
                if chain and 0 <= start - chain["end"] <= MAX_GAP and 0 <= template_start - chain["at"] <= MAX_GAP:
                    chain["end"], chain["at"] = end, template_end
                    chain["words"] += end - start
                    continue
                if chain and start < chain["end"] and chain["words"] >= end - start:
                    continue  # another place of words that are chained already
                if chain:
                    spans.append((k, chain))
                open_chains[k] = {"start": start, "end": end, "at": template_end, "words": end - start}
        spans += open_chains.items()
        return [
            {"label": self.labels[k], "first_word": c["start"], "last_word": c["end"] - 1, "cover": min(1.0, c["words"] / self.sizes[k])}
            for k, c in sorted(spans, key=lambda x: (x[1]["start"], x[0]))
        ]


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the columns of RESULT, one row per row of ``docs``."""
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())])
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, word = scanner(), alnum_or_high()
        for batch in batches:
            rows = []
            for lo, hi, limits, hashes in hashed_words(batch.column(1), word):
                numbers = own.numbers(hashes)
                rows += [own.scan(numbers[limits[i] : limits[i + 1]]) for i in range(hi - lo)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [*kinds, pa.list_(span)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(scan, "doc_id bigint, " + RESULT)
