"""Licence scans: matching statistics of texts against a suffix automaton of licence templates."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tallyflow.llm import spans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Passages of public licences and of common notices, with their labels.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation either version 3 of the license "
            "or at your option any later version"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

WORD = spans.byte_set([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LEAST_MATCH = 3
MAX_GAP = 4
LEAST_COVER = 0.6
RESULT = (
    "struct<n_words:bigint,phrases:array<struct<start:int,label:string>>,"
    "spans:array<struct<first:int,last:int,label:string,cover:double>>>"
)


class SuffixAutomaton:
    """Generalised suffix automaton of token sequences, by online extension."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].add((number, place))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        copy = self._new(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(token) == target:
            self.step[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        target = self.step[last].get(token)
        if target is not None:  # another sequence has been here
            return target if self.length[target] == self.length[last] + 1 else self._split(last, token, target)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and token not in self.step[last]:
            self.step[last][token] = new
            last = self.link[last]
        if last >= 0:
            target = self.step[last][token]
            straight = self.length[target] == self.length[last] + 1
            self.link[new] = target if straight else self._split(last, token, target)
        return new

    def statistics(self, tokens: Sequence[int]) -> Iterator[tuple[int, int]]:
        """For each token: the state and length of the longest template piece that ends there."""
        state, size = 0, 0
        for token in tokens:
            while state and token not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if token in self.step[state]:
                state = self.step[state][token]
                size += 1
            yield state, size


class LicenceScanner:
    """Finds base phrases and chains of template pieces in the words of one text."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES):
        self.labels = [label for label, _ in templates] + list(phrases.values())
        texts = [text.encode().split() for _, text in templates] + [p.encode().split() for p in phrases]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.sequences = [[self.vocabulary[w] for w in t] for t in texts]
        self.first_phrase = len(templates)
        self.automaton = SuffixAutomaton(self.sequences)
        self.closed = self._closed_phrases()

    def _closed_phrases(self) -> list[list[int]]:
        """For each state the phrases that its strings may end with, from the suffix links."""
        machine = self.automaton
        closed: list[list[int]] = [[] for _ in machine.link]
        for state in sorted(range(1, len(machine.link)), key=machine.length.__getitem__):
            own = [n for n, place in machine.ends[state]
                   if n >= self.first_phrase and place == len(self.sequences[n]) - 1 and machine.length[state] > place]
            closed[state] = sorted({*closed[machine.link[state]], *own})
        return closed

    def scan(self, tokens: np.ndarray, places: np.ndarray):
        """Phrase places and covered spans, from the known tokens of a text and their word numbers.

        Runs of neighbouring known words stream through the automaton. A match is taken where it
        can't be prolonged; its phrases are counted at every place.
        """
        phrases, pieces = [], []
        breaks = np.flatnonzero(np.diff(places) != 1) + 1
        for run, at in zip(np.split(tokens, breaks), np.split(places, breaks), strict=True):
            if len(run) < 2:  # no phrase or piece is that short
                continue
            found = list(self.automaton.statistics(run.tolist()))
            for k, (state, size) in enumerate(found):
                for number in self.closed[state]:
                    whole = len(self.sequences[number])
                    if size >= whole:
                        phrases.append((int(at[k]) - whole + 1, self.labels[number]))
                if size >= LEAST_MATCH and (k + 1 == len(found) or found[k + 1][1] <= size):
                    pieces += [(number, place - size + 1, int(at[k]) - size + 1, size)
                               for number, place in sorted(self.automaton.ends[state]) if number < self.first_phrase]
        return sorted(phrases), self._chains(pieces)

    def _chains(self, pieces):
        """Pieces of one template in rising order, with small gaps on both sides, make a span."""
        out = []
        chains: dict[int, list[list[int]]] = {}
        for number, place, start, size in sorted(pieces, key=lambda p: (p[0], p[2], p[1])):
            for chain in reversed(chains.setdefault(number, [])):
                gap, skip = start - chain[1] - 1, place - chain[3] - 1
                if 0 <= gap <= MAX_GAP and 0 <= skip <= MAX_GAP:
                    chain[1], chain[3], chain[4] = start + size - 1, place + size - 1, chain[4] + size
                    break
                if gap > MAX_GAP:
                    chains[number].append([start, start + size - 1, place, place + size - 1, size])
                    break
            else:
                chains[number].append([start, start + size - 1, place, place + size - 1, size])
        for number, found in chains.items():
            whole = len(self.sequences[number])
            out += [(c[0], c[1], self.labels[number], min(1.0, c[4] / whole)) for c in found if c[4] >= LEAST_COVER * whole]
        return sorted(out)


def licence_column():
    """A column function: text -> RESULT."""

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = LicenceScanner()
        known = np.array(sorted(
            (int(d), i) for d, i in zip(_word_digests(scanner.vocabulary), scanner.vocabulary.values(), strict=True)
        ), dtype=object)
        keys, ids = known[:, 0].astype(np.uint64), known[:, 1].astype(np.int64)
        kind = pa.struct([
            ("n_words", pa.int64()),
            ("phrases", pa.list_(pa.struct([("start", pa.int32()), ("label", pa.string())]))),
            ("spans", pa.list_(pa.struct([
                ("first", pa.int32()), ("last", pa.int32()), ("label", pa.string()), ("cover", pa.float64())]))),
        ])
        for column in batches:
            rows = []
            for start, stop in spans.slices(column):
                data, offsets = spans.flat(column[start:stop])
                data = spans.LOWER[data]
                starts, ends, ranges = spans.word_spans(data, offsets, WORD)
                digests = spans.SpanDigests(data)(starts, ends)
                at = np.minimum(np.searchsorted(keys, digests), len(keys) - 1)
                hits = np.flatnonzero(keys[at] == digests)
                tokens = ids[at[hits]]
                cuts = np.searchsorted(hits, ranges)
                for k in range(len(ranges) - 1):
                    a, b = cuts[k], cuts[k + 1]
                    row = {"n_words": int(ranges[k + 1] - ranges[k]), "phrases": [], "spans": []}
                    if b - a > 1:
                        phrases, covered = scanner.scan(tokens[a:b], hits[a:b] - ranges[k])
                        row["phrases"] = [{"start": p, "label": n} for p, n in phrases]
                        row["spans"] = [{"first": f, "last": e, "label": n, "cover": c} for f, e, n, c in covered]
                    rows.append(row)
            yield pa.array(rows, kind)

    return arrow_udf(scan, RESULT, ArrowUDFType.SCALAR_ITER)


def _word_digests(words) -> np.ndarray:
    data, offsets = spans.flat(pa.array([w.decode() for w in words], pa.string()))
    return spans.SpanDigests(data)(offsets[:-1], offsets[1:])


def scan_licences(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, phrases, spans) for every document.

    Words are runs of digits, letters a-z after lower-casing A-Z, and code points from U+0080.
    ``phrases`` has each place of a base phrase (its first word's number, label); ``spans`` has
    passages that cover at least LEAST_COVER of a licence template by pieces of LEAST_MATCH words
    or more, at most MAX_GAP words apart in text and template. A null or empty text has none.
    Repeated rows are scanned each; an empty table gives an empty one.
    """
    return docs.select(F.col(id), licence_column()(F.col(text)).alias("_found")).select(id, "_found.*")
