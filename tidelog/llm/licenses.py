"""License notices in texts, by templates with markup.

A template is wording with two kinds of regions: ``<<beginOptional>> … <<endOptional>>`` may be missing as a whole, and
``<<var;name=…;words=a-b>>`` stands for a to b words of any kind. The rest is mandatory and must match word for word.
A template is compiled into an automaton over words, made deterministic as far as texts need it. Capitals, marks and
line ends do not count: texts and templates are compared as words.

A text is searched for the mandatory words that a template begins with; only there its automaton runs. Texts without
the longest mandatory wording of a template are passed over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wording of public licenses and of the notices by which works refer to them.
TEMPLATES = (
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the <<var;name=software;words=1-4>>), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>> (including the next paragraph) <<endOptional>> shall be included in all copies or substantial
        portions of the Software.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    ),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: <<var;name=bullet;words=0-1>> Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer. <<var;name=bullet;words=0-1>>
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. <<beginOptional>>
        <<var;name=bullet;words=0-1>> <<endOptional>> This software is provided""",
    ),
    (
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: <<var;name=bullet;words=0-1>> Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer. <<var;name=bullet;words=0-1>>
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution.
        <<var;name=bullet;words=0-1>> Neither the name<<beginOptional>>s<<endOptional>> of
        <<var;name=holder;words=1-20>> may be used to endorse or promote products derived from this software without
        specific prior written permission.""",
    ),
    (
        "apache-2",
        """Licensed under the Apache License, Version 2.0 <<beginOptional>> (the <<var;name=license;words=1-2>>)
        <<endOptional>> <<beginOptional>> you may not use this <<var;name=what;words=1-2>> except in compliance with the
        License <<endOptional>>""",
    ),
    (
        "gpl-3",
        """GNU General Public License <<beginOptional>> as published by the Free Software Foundation <<endOptional>>
        <<beginOptional>> either <<endOptional>> <<beginOptional>> (GPL) <<endOptional>> version 3 <<beginOptional>> .0
        <<endOptional>> <<beginOptional>> of the License <<endOptional>> <<beginOptional>> or (at your option) any later
        version <<endOptional>>""",
    ),
    (
        "gpl-2",
        """GNU General Public License <<beginOptional>> as published by the Free Software Foundation <<endOptional>>
        <<beginOptional>> either <<endOptional>> <<beginOptional>> (GPL) <<endOptional>> version 2 <<beginOptional>> .0
        <<endOptional>> <<beginOptional>> of the License <<endOptional>> <<beginOptional>> or (at your option) any later
        version <<endOptional>>""",
    ),
    (
        "lgpl",
        """GNU Lesser General Public License <<beginOptional>> as published by the Free Software Foundation
        <<endOptional>> <<beginOptional>> either <<endOptional>> version <<var;name=version;words=1-2>>""",
    ),
    ("agpl-3", "GNU Affero General Public License <<beginOptional>> as published by the Free Software Foundation <<endOptional>> <<beginOptional>> either <<endOptional>> version 3"),
    ("mpl-2", "Mozilla Public License <<beginOptional>> , v <<endOptional>> <<beginOptional>> , version <<endOptional>> 2.0"),
    ("cc-by", "Creative Commons Attribution <<var;name=version;words=0-2>> International <<beginOptional>> Public <<endOptional>> License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike <<var;name=version;words=0-2>> <<beginOptional>> International <<endOptional>> <<beginOptional>> Public <<endOptional>> License"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial <<var;name=version;words=0-2>> <<beginOptional>> International <<endOptional>> <<beginOptional>> Public <<endOptional>> License"),
    ("cc-by-nc-sa", "CC BY-NC-SA"),
    ("cc-by-sa", "CC BY-SA"),
    ("cc0", "CC0 1.0 <<beginOptional>> Universal <<endOptional>>"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Bytes as words see them: A-Z in lower case, all that is no part of a word a blank.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;name=\w+;words=(\d+)-(\d+))>>")


def words_of(text: str | bytes | None) -> list[bytes]:
    """The words of a text: letters, digits and everything beyond ASCII, A-Z in lower case."""
    return (text.encode() if isinstance(text, str) else text or b"").translate(_WORDS).split()


class Automaton:
    """Accepts the word sequences of a template. States are numbers; sets of them are the deterministic states."""

    def __init__(self, markup: str) -> None:
        self._on: list[tuple[bytes | None, int] | None] = []  # the word (None: any) that leads on from a state
        self._free: list[list[int]] = []  # states reached without a word
        runs: list[list[bytes]] = [[]]  # mandatory wording
        opened: list[int] = []
        state, at = self._state(), 0
        for found in [*_MARKUP.finditer(markup), None]:
            wording = words_of(markup[at : found.start() if found else None])
            for word in wording:
                state = self._step(state, word)
            if not opened:
                runs[-1] += wording
            if found is None:
                break
            at = found.end()
            if found[2]:
                least, most = int(found[2]), int(found[3])
                for _ in range(least):
                    state = self._step(state, None)
                # from each further word, and before it, the region may end
                ways = [state]
                for _ in range(most - least):
                    ways.append(state := self._step(state, None))
                state = self._state()
                for way in ways:
                    self._free[way].append(state)
                runs.append([])
            elif found[1] == "beginOptional":
                opened.append(state)
                runs.append([])
            else:
                self._free[opened.pop()].append(end := self._state())
                self._free[state].append(end)
                state = end
        if opened:
            raise ValueError(f"an optional region has no end: {markup}")
        if not runs[0]:
            raise ValueError(f"a template must begin with mandatory words: {markup}")
        self.accepts = state
        #: Mandatory words at the start, and the longest mandatory wording, between blanks.
        self.prefix = b" %s " % b" ".join(runs[0])
        self.needle = b" %s " % b" ".join(max(runs, key=lambda r: len(b" ".join(r))))
        self._alphabet = {on[0] for on in self._on if on} - {None}
        self._known: dict[tuple[frozenset[int], bytes | None], frozenset[int]] = {}
        self._begin = self._closed({0})

    def _state(self) -> int:
        self._on.append(None)
        self._free.append([])
        return len(self._on) - 1

    def _step(self, state: int, word: bytes | None) -> int:
        if self._on[state]:
            self._free[state].append(other := self._state())
            state = other
        then = self._state()
        self._on[state] = (word, then)
        return then

    def _closed(self, states: set[int]) -> frozenset[int]:
        left = list(states)
        while left:
            for state in self._free[left.pop()]:
                if state not in states:
                    states.add(state)
                    left.append(state)
        return frozenset(states)

    def _next(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        kind = word if word in self._alphabet else None
        if (states, kind) not in self._known:
            on = [self._on[s] for s in states if self._on[s]]
            self._known[states, kind] = self._closed({then for wanted, then in on if wanted is None or wanted == kind})
        return self._known[states, kind]

    def longest(self, words: Sequence[bytes], at: int) -> int | None:
        """Where the longest accepted sequence from a word on ends; None if there is none."""
        states, end = self._begin, None
        for k in range(at, len(words)):
            states = self._next(states, words[k])
            if not states:
                break
            if self.accepts in states:
                end = k + 1
        return end


class Scanner:
    """Finds all places of some templates, (label, markup) each."""

    def __init__(self, templates: Sequence[tuple[str, str]]) -> None:
        self.templates = tuple(templates)
        self._ready: list[Automaton] | None = None
        # faults in templates show where they are given
        for _, markup in self.templates:
            Automaton(markup)

    def __getstate__(self) -> dict:
        return {"templates": self.templates, "_ready": None}

    def places(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, int]]:
        """(template number, first word, number of words) of every place."""
        if self._ready is None:
            self._ready = [Automaton(markup) for _, markup in self.templates]
        joined = b" %s " % b" ".join(words)
        for number, automaton in enumerate(self._ready):
            if automaton.needle not in joined:
                continue
            at = joined.find(automaton.prefix)
            counted = before = 0
            while at >= 0:
                # blanks before a place are words
                before += joined.count(b" ", counted, at)
                counted = at
                end = automaton.longest(words, before)
                if end is not None:
                    yield number, before, end - before
                at = joined.find(automaton.prefix, at + 1)


_PLACES = "struct<n_words: long, places: array<struct<template: int, label: string, start: long, length: long>>, score: double>"


def license_places(text: Column, templates: Sequence[tuple[str, str]] = (*((m, p) for p, m in PHRASES.items()), *TEMPLATES)) -> Column:
    """A struct for each text: ``n_words``, all ``places`` (number of the template, label, first word, number of words)
    by first word and template, and ``score``, the share of the text's words that lie in places.

    A null text, and one without words, has no places and score 0. A text is read whole, whatever its length.
    """
    scanner = Scanner(templates)
    labels = [label for label, _ in templates]

    @F.arrow_udf(_PLACES)
    def every(texts: pa.Array) -> pa.Array:
        sizes, offsets, flat, scores = [], [0], [], []
        for value in texts.cast(pa.binary()):
            words = words_of(value.as_py())
            found = sorted(scanner.places(words), key=lambda p: (p[1], p[0]))
            covered = reached = 0
            for _, start, length in found:
                covered += max(0, start + length - max(start, reached))
                reached = max(reached, start + length)
            sizes.append(len(words))
            flat += found
            offsets.append(len(flat))
            scores.append(covered / len(words) if found else 0.0)
        fields = {
            "template": pa.array([p[0] for p in flat], pa.int32()), "label": pa.array([labels[p[0]] for p in flat], pa.string()),
            "start": pa.array([p[1] for p in flat], pa.int64()), "length": pa.array([p[2] for p in flat], pa.int64()),
        }
        places = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), places, pa.array(scores, pa.float64())], ["n_words", "places", "score"])

    return every(text)


def with_licenses(frame: DataFrame, text: str = "text", into: str = "licenses", more: Mapping[str, str] | None = None) -> DataFrame:
    """The frame with a column ``into`` of ``license_places``; a column of that name is replaced.

    ``more`` adds templates (markup to label) of one's own. Repeated rows stay, an empty table stays empty, other columns pass.
    """
    templates = [*((m, p) for p, m in PHRASES.items()), *TEMPLATES, *((label, markup) for markup, label in (more or {}).items())]
    return frame.withColumn(into, license_places(F.col(f"`{text}`"), templates))
