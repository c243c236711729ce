"""License scans by patience alignment.

A template is aligned with a stretch of text by anchors: words that occur once in both. The longest
increasing run of anchors is kept, and the gaps between them are aligned in the same way, after
equal words at their ends. The share of the template's words that are aligned is its coverage.
Stretches are found by what a template needs at least: enough of its words close together. That is
a bound on the coverage, so no stretch that could reach it is passed over.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from wakeline.llm.common import tasks_find_package, text_of

WORD = re.compile(r"[^\W_]+")
LEAST = 0.75
#: Longest stretch of text for a template: so many words for each of its own.
STRETCH = 2

# Names and public notices of licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    ("MIT", "Released under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned positions in text and template, both increasing."""
    found, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        once, here = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(text[a:b], a) if once[w] == 1}
        anchors = [(at[w], j) for j, w in enumerate(template[c:d], c) if here[w] == 1 and w in at]
        chain = _longest_run(anchors)
        if not chain:
            continue
        found += chain
        for (i, j), (k, m) in zip([(a - 1, c - 1), *chain], [*chain, (b, d)]):
            gaps.append((i + 1, k, j + 1, m))
    return sorted(found)


def _longest_run(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of anchors, given by place in the template, that increases in the text."""
    tails, at_tail, before = [], [], []
    for n, (i, _) in enumerate(anchors):
        k = bisect_left(tails, i)
        before.append(at_tail[k - 1] if k else -1)
        tails[k : k + 1], at_tail[k : k + 1] = [i], [n]
    out, n = [], at_tail[-1] if at_tail else -1
    while n >= 0:
        out.append(anchors[n])
        n = before[n]
    return out[::-1]


class Template:
    def __init__(self, license_id: str, text: str):
        self.license_id, self.words = license_id, words_of(text)
        self.counts = Counter(self.words)

    def possible(self, held: set[str], least: float) -> bool:
        most = sum(n for w, n in self.counts.items() if w in held)
        return most >= least * len(self.words)

    def stretches(self, text: list[str], least: float) -> Iterator[tuple[int, int]]:
        """Stretches whose words leave the coverage possible, one for each word one may begin at.

        They overlap. A notice whose first needed words lie within ``width`` is in one that begins
        with its own first word, whatever stands before it.
        """
        width, need = STRETCH * len(self.words), least * len(self.words)
        places = [i for i, w in enumerate(text) if w in self.counts]
        inside: Counter = Counter()
        overlap, start = 0, 0
        for i in places:
            word = text[i]
            overlap += inside[word] < self.counts[word]
            inside[word] += 1
            while overlap >= need or i - places[start] >= width:
                if overlap >= need and i - places[start] < width:
                    # what is missing of the template may still follow
                    yield places[start], min(i + len(self.words), len(text))
                gone = text[places[start]]
                inside[gone] -= 1
                overlap -= inside[gone] < self.counts[gone]
                start += 1


def find(text: list[str], templates: list[Template], least: float) -> list[tuple]:
    """``license, coverage, start, end`` in words, the best where several overlap.

    The best has most words aligned, then the highest coverage, then the fewest words between. A
    stretch that overlaps a better one is aligned again in what that leaves of it.
    """
    held, found = set(text), []

    def aligned(k: int, begin: int, end: int) -> None:
        words = templates[k].words
        if end - begin < least * len(words):
            return
        pairs = align(text[begin:end], words)
        coverage = len(pairs) / len(words)
        if coverage >= least:
            first, last = begin + pairs[0][0], begin + pairs[-1][0] + 1
            best = -len(pairs), -coverage, last - first, first
            heapq.heappush(found, (best, templates[k].license_id, last, k, begin, end))

    for k, template in enumerate(templates):
        if template.possible(held, least):
            for begin, end in template.stretches(text, least):
                aligned(k, begin, end)
    out: list[tuple] = []
    places: list[tuple[int, int]] = []
    tried = set()
    while found:
        (_, less, _, first), name, last, k, begin, end = heapq.heappop(found)
        at = bisect_left(places, (last, 0)) - 1
        if at < 0 or places[at][1] <= first:
            out.append((name, -less, first, last))
            places.insert(at + 1, (first, last))
            continue
        taken = places[at]
        for part in ((k, begin, min(end, taken[0])), (k, max(begin, taken[1]), end)):
            if part not in tried:
                tried.add(part)
                aligned(*part)
    return sorted(out, key=lambda x: x[2])


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id, license, coverage, start, end``: a row for every notice found.

    Positions count words, the end exclusive. Texts without a notice, null and empty ones among
    them, have no row; repeated rows give repeated results; whole texts are read. An empty table
    gives none; further columns are ignored.
    """
    tasks_find_package(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = [Template(*t) for t in templates]
        for frame in frames:
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(frame["doc_id"], frame["text"])
                for hit in find(words_of(text), known, least)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "start", "end"])
            yield out.astype({"doc_id": "Int64", "license": object})

    schema = "doc_id long, license string, coverage double, start int, end int"
    return docs.select("doc_id", text_of("text").alias("text")).mapInPandas(run, schema)
