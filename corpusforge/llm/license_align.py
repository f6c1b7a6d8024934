"""License scans by patience alignment.

Only templates of whose words a text holds enough, in any order, are aligned
with it. First, around each pair of neighbouring words of the template (with a
word that is not a mere function word), a window of the template's size is
aligned with the template: words that are unique in both anchor the alignment,
the longest increasing subsequence of anchors is kept, and the gaps between
them are aligned the same way; gaps without anchors match what is equal at
their ends. The share of the template's words that are aligned is the coverage;
a match needs ``min_coverage``. Scanning goes on behind a match, so repeated
licenses are all found.

The stretches between these matches are then aligned in overlapping windows of
doubled sizes, up to the whole stretch, so a copy is found however many words
are inserted in it. Words of a short notice may also be scattered over a text
by chance, so a match has a ``density``, its aligned words over the words it
spreads over: matches of at least ``min_density`` come first, and only these
name the license of a text; the others are listed beside them. Where a template
holds all words of another one, a dense match of the longer template that is
covered as well stands for both at its place.

Templates are a table of names and texts, given as a dict or a DataFrame of at
most ``MAX_TEMPLATES`` rows; work is per document in Arrow batches, nothing is
shuffled.

Defined cases: null and empty texts have no words and no matches; very long
texts are scanned whole, in memory proportional to the text; rows of one id
each get a row; null ids are kept; overlapping matches of several templates are
all returned, dense ones first, then by best coverage, longer template,
greater density, place and name; an empty table gives an empty result, as do
templates without words. Only the id and the text are read, so other columns
may have any name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices and paragraphs of public licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                      "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                      "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                      "following conditions: The above copyright notice and this permission notice shall be included in all "
                      "copies or substantial portions of the Software.",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                      "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                      "that the following conditions are met:",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "mit-notice-licensed": "Licensed under the MIT License",
    "mit-notice-short": "Released under MIT license",
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "boost-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "gpl-2.0-or-later-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                               "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                               "option) any later version.",
    "gpl-3.0-or-later-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                               "option) any later version.",
    "lgpl-2.1-or-later-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                                "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                                "(at your option) any later version.",
    "agpl-3.0-or-later-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                                "(at your option) any later version.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                      "distributed with this file, You can obtain one at",
    "epl-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "bsd-source-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary-clause": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                         "disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                        "derived from this software without specific prior written permission.",
    "zlib-body": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
                 "any damages arising from the use of this software.",
    "unlicense-body": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                      "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                      "commercial or non-commercial, and by any means.",
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
}
# Function words, too common to start a window.
FUNCTION_WORDS = frozenset("a above all an and any are as at be by for from in is it may not of on or shall that the this to use with without you".split())
MIN_COVERAGE, MIN_DENSITY = 0.9, 0.5
MAX_TEMPLATES = 4096
WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _unique(seq: list[str], lo: int, hi: int) -> dict[str, int]:
    count = Counter(seq[lo:hi])
    return {w: i for i, w in enumerate(seq[lo:hi], lo) if count[w] == 1}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (ascending in the first) that ascends in the second too."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        place = bisect_left(tails, j)
        tails[place:place + 1] = [j]
        at[place:place + 1] = [k]
        back.append(at[place - 1] if place else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of two word lists, ascending in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            found.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            found.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        there = _unique(b, blo, bhi)
        anchors = _increasing([(i, there[w]) for w, i in _unique(a, alo, ahi).items() if w in there])
        if not anchors:
            continue
        found += anchors
        ends = [(alo - 1, blo - 1), *anchors, (ahi, bhi)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(found)


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float, min_density: float = MIN_DENSITY):
        self.min_coverage, self.min_density = min_coverage, min_density
        self.templates = {name: w for name, t in templates.items() if (w := words(t))}
        self.bags = {name: Counter(t) for name, t in self.templates.items()}
        self.longer = {name: [other for other, b in self.bags.items() if bag < b] for name, bag in self.bags.items()}
        self.starts: dict[tuple[str, str], list[tuple[str, int]]] = {}
        for name, t in self.templates.items():
            for p, pair in enumerate(zip(t, t[1:])):
                if not FUNCTION_WORDS.issuperset(pair):
                    self.starts.setdefault(pair, []).append((name, p))
        self.firsts = {a for a, _ in self.starts}

    def _align(self, name: str, text: list[str], lo: int, hi: int) -> tuple[float, int, int] | None:
        """Coverage and span of the template in a window, if enough."""
        t = self.templates[name]
        window = text[lo:hi]
        need = self.min_coverage * len(t)
        if sum((Counter(window) & self.bags[name]).values()) < need:
            return None
        aligned = patience(window, t)
        return (len(aligned) / len(t), lo + aligned[0][0], lo + aligned[-1][0] + 1) if aligned and len(aligned) >= need else None

    def _spread(self, name: str, text: list[str], matches: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
        """Matches with inserted words, in the stretches of the text between ``matches``."""
        need = self.min_coverage * len(self.templates[name])
        size, found = 2 * len(self.templates[name]), []
        ends = [0, *(x for _, first, end in matches for x in (first, end)), len(text)]
        todo = list(zip(ends[::2], ends[1::2]))
        while todo:
            todo = [(lo, hi) for lo, hi in todo if sum((Counter(text[lo:hi]) & self.bags[name]).values()) >= need]
            rest = []
            for lo, hi in todo:
                start, behind = lo, lo
                while start < hi:
                    if got := self._align(name, text, start, min(hi, start + size)):
                        found.append(got)
                        rest.append((behind, got[1]))
                        start = behind = got[2]
                    elif start + size >= hi:
                        break
                    else:
                        start += size // 2
                if behind > lo or size < hi - lo:  # else it was aligned as a whole
                    rest.append((behind, hi))
            todo, size = rest, 2 * size
        return found

    def __call__(self, text: list[str]) -> list[tuple[str, float, int, int]]:
        count = Counter(text)
        near: dict[str, list[tuple[float, int, int]]] = {
            name: [] for name, bag in self.bags.items()
            if sum(min(n, count[w]) for w, n in bag.items()) >= self.min_coverage * len(self.templates[name])}
        if not near:
            return []
        behind = dict.fromkeys(near, 0)
        firsts, starts = self.firsts, self.starts
        for i, w in enumerate(text):
            if w in firsts and i + 1 < len(text) and (hits := starts.get((w, text[i + 1]))):
                for name, p in hits:
                    if name not in near or i < behind[name]:
                        continue
                    n = len(self.templates[name])
                    slack = n // 4 + 1
                    lo, hi = max(behind[name], i - p - slack), min(len(text), i + n - p + slack)
                    if got := self._align(name, text, lo, hi):
                        near[name].append(got)
                        behind[name] = got[2]
        found = [(name, *got) for name, matches in near.items() for got in matches + self._spread(name, text, matches)]
        found = [m for m in found if not self._held(m, near)]
        return sorted(found, key=lambda x: (self.density(x) < self.min_density, -x[1], -len(self.templates[x[0]]), -self.density(x), x[2], x[0]))

    def _held(self, match: tuple[str, float, int, int], near: dict[str, list[tuple[float, int, int]]]) -> bool:
        """Whether a dense match, as well covered, of a longer template that holds all words of this one's is at the place."""
        for longer in self.longer.get(match[0], ()):
            matches = near.get(longer, [])  # ascending, without overlaps
            k = bisect_right(matches, match[2], key=lambda m: m[1]) - 1
            if k >= 0 and matches[k][0] >= match[1] and match[3] <= matches[k][2] and self.density((longer, *matches[k])) >= self.min_density:
                return True
        return False

    def density(self, match: tuple[str, float, int, int]) -> float:
        """Aligned words of a match over the words it spreads over."""
        name, coverage, first, end = match
        return round(coverage * len(self.templates[name])) / (end - first)


def _given(templates: dict[str, str] | DataFrame | None) -> dict[str, str]:
    if isinstance(templates, DataFrame):
        rows = templates.select("license", "text").where("license is not null").limit(MAX_TEMPLATES + 1).collect()
        if len(rows) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        return {r["license"]: r["text"] or "" for r in rows}
    return templates if templates is not None else TEMPLATES


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | DataFrame | None = None,
         min_coverage: float = MIN_COVERAGE, min_density: float = MIN_DENSITY) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_matches, license (the best dense match's, else null) with its coverage and
    density, and all ``matches`` (license, coverage, density, and the words from ``first`` up to ``end``).

    ``templates``: names and texts, as a dict or a DataFrame (license, text).
    """
    given = _given(templates)
    match = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("density", pa.float64()), ("first", pa.int64()), ("end", pa.int64())])

    def run(batches):
        scanner = Scanner(given, min_coverage, min_density)
        for batch in batches:
            texts = [words(t) for t in batch.column(1).to_pylist()]
            found = [[(name, cov, scanner.density((name, cov, a, b)), a, b) for name, cov, a, b in scanner(t)] for t in texts]
            best = [f[0] if f and f[0][2] >= min_density else (None,) * 3 for f in found]
            yield pa.record_batch([
                batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(f) for f in found], pa.int64()),
                *(pa.array([b[k] for b in best], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))),
                pa.array([[dict(zip([f.name for f in match], m)) for m in f] for f in found], pa.list_(match))],
                names=["id", "n_words", "n_matches", "license", "coverage", "density", "matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_words long, n_matches long, license string, coverage double, density double, "
             "matches array<struct<license: string, coverage: double, density: double, first: long, end: long>>")
    return out.withColumnRenamed("id", id_col)
