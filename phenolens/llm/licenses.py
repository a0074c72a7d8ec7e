"""License scans by patience alignment.

A text and a template are sequences of words (letters and digits, lower case).
A window of one and a half template lengths moves over the text by half a
length, so every occurrence lies whole in a window and no window holds two.
In it, words that occur once in the window and once in the template are the
anchors; the longest increasing run of their places is kept, and the gaps
between kept anchors are aligned in the same way, after equal words at either
end of a gap. Coverage is the share of the template's words that are aligned;
a window with at least ``COVERAGE`` is a hit.

A template is tried on a text only if enough of its words occur there at all -
coverage cannot exceed their share - and on a window by the same bound, so
nothing is lost. Overlapping hits are settled for the one with more words
aligned, then the higher coverage.

Cases: a null or empty text has no hits. Rows are scanned one by one: repeated
rows get equal results, a null ``doc_id`` is no obstacle. Equal hits go to the
template listed first. Texts are scanned whole. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import renamed, texts_of

COVERAGE = 0.85

# Public license notices, as (license, notice).
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORD = re.compile(r"[a-z0-9]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of the pairs, sorted by the first place, whose second places increase."""
    tops: list[int] = []  # smallest second place that ends a run of each length
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        if k == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[k], ends[k] = b, i
        before[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words in ``a`` and ``b``, increasing in both."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 == in_a.get(w)}
        anchors = increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if w in place])
        if not anchors:
            continue
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        out += anchors
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


class Scanner:
    def __init__(self, notices=NOTICES, coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = [(name, words, Counter(words)) for name, text in notices if (words := words_of(text))]
        self.vocabulary = {w for _, words, _ in self.templates for w in words}

    def _enough(self, template, have) -> bool:
        _, words, counts = template
        return sum(n for w, n in counts.items() if w in have) >= self.coverage * len(words)

    def scan(self, text: str) -> list[tuple[int, int, int, float, str]]:
        """(first word, word after the last, words aligned, coverage, license) of the hits, in order."""
        words = words_of(text)
        have = self.vocabulary.intersection(words)
        hits = []
        for rank, template in enumerate(self.templates):
            if not self._enough(template, have):
                continue
            name, own, _ = template
            n = len(own)
            half = max(1, n // 2)
            for lo in range(0, max(1, len(words) - half), half):
                part = words[lo:lo + n + half + 1]
                if not self._enough(template, self.vocabulary.intersection(part)):
                    continue
                pairs = align(part, own)
                if len(pairs) >= self.coverage * n:
                    hits.append((-len(pairs), -len(pairs) / n, rank, lo + pairs[0][0], lo + pairs[-1][0] + 1, name))
        out: list[tuple[int, int, int, float, str]] = []
        for matched, covered, _, start, end, name in sorted(hits):
            if all(end <= s or e <= start for s, e, *_ in out):
                out.append((start, end, -matched, -covered, name))
        return sorted(out)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    fields = ("start", "end", "matched", "coverage", "license")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("matched", pa.int32()),
                               ("coverage", pa.float64()), ("license", pa.string())]))
    for batch in batches:
        hits = [scanner.scan(t) if t else [] for t in texts_of(batch.column("text"))]
        best = [max(h, key=lambda x: (x[2], x[3], -x[0])) if h else None for h in hits]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([b[4] if b else None for b in best], pa.string()),
             pa.array([b[3] if b else 0.0 for b in best], pa.float64()), pa.array([len(h) for h in hits], pa.int64()),
             pa.array([[dict(zip(fields, x, strict=True)) for x in h] for h in hits], kind)],
            names=["doc_id", "license", "coverage", "n_hits", "hits"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license and coverage of the best hit, n_hits, hits (word places) of every row."""
    return renamed(docs, {id_col: "doc_id", text_col: "text"}).mapInArrow(
        _scan_batches, "doc_id long, license string, coverage double, n_hits long, "
                       "hits array<struct<start:int,end:int,matched:int,coverage:double,license:string>>")
