"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Texts are sequences of lower-cased words (letters and digits), compared by five-word
shingles.  A license template of ``n`` words is looked up in windows of the smallest size in
``SIZES`` that holds ``2 n`` words; windows overlap by half, so every span of ``n`` words lies within
one of them.  The similarity of that window to the template it contains is then at least
1/7, and with ``BANDS`` one-row bands some band agrees with probability
``1 - (6/7) ** BANDS`` (0.9999 for 64).  Templates too long for the largest window are looked up piece by piece.
Around every window that a band retrieves, as many words on each side as the template has are checked exactly:
every stretch that holds the share ``threshold`` of the template's shingles is an occurrence of its own, from its first
to its last shingle; stretches in the template's order come before those in any other.  Occurrences that share half of
the words of the smaller one are the same place: the best contained one is reported (then the longest).
A template of fewer than five words is one shingle of all its words; the texts are also cut into shingles of
that many words, and every one is compared.

The templates are a bounded parameter and travel with the function; documents are read once and
nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm import common
from tidewater.llm.common import GOLDEN, WORDS, Words, binary_column, distinct_per_text, id_text, lowered, mix64
from tidewater.llm.tokens import char_batches

N = 5
SIZES = (10, 20, 40, 80, 160, 320)
BANDS = 64

# Public licence notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        'required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version."),
    "LGPL-3.0-notice": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT-line": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so."),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "all-rights-reserved-line": "All rights reserved.",
    "all-rights-reserved-notice": "All rights reserved. No part of this work may be reproduced.",
}


def _seeds(bands: int) -> np.ndarray:
    return mix64((np.arange(bands, dtype=np.uint64) + np.uint64(77)) * GOLDEN)


def shingle_runs(words: Words, n: int = N, shorter: Sequence[int] = tuple(range(1, N))) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of all texts, then of those of each ``shorter`` size, and their edges per size and text."""
    parts = [common.shingle_runs(words, size) for size in (n, *shorter)]
    per = np.concatenate([np.diff(edges) for _, edges in parts])
    return np.concatenate([runs for runs, _ in parts]), np.concatenate([[0], np.cumsum(per)])


class Index:
    """Templates cut into pieces, their distinct shingles, their band values by window size; short templates by words."""

    def __init__(self, templates: Mapping[str, str], bands: int = BANDS):
        self.names = sorted(templates)
        self.pieces: list[tuple[int, np.ndarray, int]] = []  # template, distinct shingles, words
        self.seeds = _seeds(bands)
        self.by_size: dict[int, list[int]] = {}
        self.of: list[np.ndarray] = []
        self.places: list[list[int]] = []  # where each distinct shingle first stands in its template
        self.short: dict[int, list[int]] = {}  # words, templates
        longest = SIZES[-1] // 2
        for t, name in enumerate(self.names):
            w = Words(lowered([templates[name]]), WORDS)
            if not len(w.h):
                self.of.append(np.empty(0, dtype=np.uint64))
                self.places.append([])
                continue
            runs, _ = shingle_runs(w, N, ())
            mine, first = np.unique(runs, return_index=True)
            self.of.append(mine)
            self.places.append(first.tolist())
            if len(w.h) < N:
                self.short.setdefault(len(w.h), []).append(t)
                continue
            for lo in range(0, max(len(runs), 1), longest - N + 1):
                part = runs[lo:lo + longest - N + 1]
                words = len(part) + min(N, len(w.h)) - 1
                size = next(s for s in SIZES if s >= 2 * words)
                self.by_size.setdefault(size, []).append(len(self.pieces))
                self.pieces.append((t, np.unique(part), len(w.h)))
        self.tables = {}
        for size, own in self.by_size.items():
            rows = [(mix64(self.pieces[p][1] ^ s).min(), j, p) for p in own for j, s in enumerate(self.seeds)]
            self.tables[size] = [sorted((int(v), p) for v, j, p in rows if j == k) for k in range(len(self.seeds))]


def _minima(h: np.ndarray, steps: list[int]) -> dict[int, np.ndarray]:
    """Minima over consecutive blocks of each number of shingles; a block size is a multiple of the one before."""
    out, last, size = {}, h, 1
    for step in steps:
        k = step // size
        pad = -len(last) % k
        if pad:
            last = np.concatenate([last, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)])
        last = last.reshape(-1, k).min(axis=1)
        out[step], size = last, step
    return out


def _united(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(z, out[-1][1])
        else:
            out.append((a, z))
    return out


def _occurrences(spots: list[int], which: list[int], place: list[int], threshold: float, reach: int) -> list[tuple[bool, float, int, int]]:
    """(loose, share, first, past the last) of the separate occurrences of a template among its matching shingles in a text.

    ``spots``: places of the matching shingles in the text; ``which``: numbers of these; ``place``: where each number
    stands in the template.  Shingles that follow each other as in the template, up to ``N`` places off, are an occurrence if
    they hold ``threshold`` of the numbers.  Between these, the numbers may lie in any order within ``reach``: a loose one.
    """
    need = threshold * len(place)

    def near(i, j):
        return spots[j] - spots[i] <= abs(place[which[j]] - place[which[i]]) + N

    def loose(lo, end):
        count, j = Counter(), lo
        while j < end:
            count[which[j]] += 1
            j += 1
            while spots[j - 1] - spots[lo] >= reach:
                lo = _left(count, which, lo)
            if len(count) < need:
                continue
            while j < end and near(j - 1, j) and (which[j] not in count or place[which[j]] > place[which[j - 1]]):
                count[which[j]] += 1
                j += 1
            # what comes again, or is far off and not needed, does not belong to it
            while count[which[lo]] > 1 or (len(count) - 1 >= need and not near(lo, lo + 1)):
                lo = _left(count, which, lo)
            yield True, len(count) / len(place), lo, j
            count.clear()
            lo = j

    out, i, rest = [], 0, 0
    for j in range(1, len(spots) + 1):
        if j < len(spots) and place[which[j]] > place[which[j - 1]] and near(j - 1, j):
            continue
        if j - i >= need:
            out += [*loose(rest, i), (False, (j - i) / len(place), i, j)]
            rest = j
        i = j
    return [*out, *loose(rest, len(spots))]


def _left(count: Counter, which: list[int], lo: int) -> int:
    count[which[lo]] -= 1
    if not count[which[lo]]:
        del count[which[lo]]
    return lo + 1


def find(texts: list[str | None], index: Index, threshold: float = 0.8) -> list[tuple[int, str, float, int, int]]:
    """(text, template, containment, first and last byte) of every occurrence of a template."""
    w = Words(lowered(texts), WORDS)
    every, bounds = shingle_runs(w, N, tuple(index.short))
    if not len(every):
        return []
    edges = bounds[:len(texts) + 1]
    runs = every[:edges[-1]]
    steps = [s // 2 for s in sorted(SIZES)]
    found: set[tuple[int, int, int]] = set()  # window size, block, piece
    for j, seed in enumerate(index.seeds):
        blocks = _minima(mix64(runs ^ seed), steps)
        for size in index.by_size:
            b = blocks[size // 2]
            values = np.array([v for v, _ in index.tables[size][j]], dtype=np.uint64)
            pieces = [p for _, p in index.tables[size][j]]
            at = np.minimum(np.searchsorted(values, b), len(values) - 1)
            for k in np.flatnonzero(values[at] == b).tolist():
                lo = at[k]
                while lo < len(values) and values[lo] == b[k]:
                    found.add((size, k, pieces[lo]))
                    lo += 1
    near: dict[tuple[int, int], list[tuple[int, int]]] = {}  # stretches of shingles to look at, by text and template
    reach: dict[int, int] = {}  # most shingles that an occurrence spans
    for size, k, p in found:
        t, _, words = index.pieces[p]
        reach[t] = max(reach.get(t, 0), 3 * (size // 2) + 2 * words)
        # the block and its neighbours, and as many words around as the template has
        lo, hi = max(0, (k - 1) * (size // 2) - words), min(len(runs), (k + 2) * (size // 2) + words)
        first, last = np.searchsorted(edges, [lo, hi - 1], side="right") - 1
        for text in range(first, last + 1):
            a, z = max(lo, edges[text]), min(hi, edges[text + 1])
            if a < z:
                near.setdefault((text, t), []).append((int(a), int(z)))
    places: dict[int, list[tuple[bool, float, int, np.ndarray]]] = {}  # by text: loose, share, template, words of the matching shingles
    for (text, t), stretches in near.items():
        mine = index.of[t]
        spots = np.concatenate([a + np.flatnonzero(np.isin(runs[a:z], mine)) for a, z in _united(stretches)])
        which = np.searchsorted(mine, runs[spots])
        for loose, share, i, j in _occurrences(spots.tolist(), which.tolist(), index.places[t], threshold, reach[t]):
            word = (w.edges[text] - edges[text] + spots[i:j, None] + np.arange(N)).reshape(-1)
            places.setdefault(text, []).append((loose, share, t, np.unique(word[word < w.edges[text + 1]])))
    for k, (words, own) in enumerate(index.short.items(), 1):
        cut = bounds[k * len(texts):(k + 1) * len(texts) + 1]
        for t in own:
            for at in (cut[0] + np.flatnonzero(every[cut[0]:cut[-1]] == index.of[t][0])).tolist():
                text = int(np.searchsorted(cut, at, side="right")) - 1
                places.setdefault(text, []).append((False, 1.0, t, w.edges[text] + at - cut[text] + np.arange(words)))
    out: list[tuple[int, str, float, int, int]] = []
    for text, found_here in sorted(places.items()):
        owner = np.full(w.edges[text + 1] - w.edges[text], -1, dtype=np.int64)
        sizes: list[int] = []
        # of occurrences at the same place the one that is contained best, then the longest, counts
        for _, share, t, word in sorted(found_here, key=lambda x: (x[0], -x[1], -len(x[3]), index.names[x[2]], x[3][0])):
            mine = word - w.edges[text]
            others, shared = np.unique(owner[mine][owner[mine] >= 0], return_counts=True)
            if any(2 * n >= min(len(word), sizes[o]) for o, n in zip(others.tolist(), shared.tolist())):
                continue
            owner[mine[owner[mine] < 0]] = len(sizes)
            sizes.append(len(word))
            out.append((text, index.names[t], share, int(w.start[word[0]] - w.text_start[text]), int(w.end[word[-1]] - w.text_start[text])))
    return out


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """One row per document and occurrence of a license: ``doc_id, license, containment, start, end, span``.

    ``start``/``end``: bytes of the lower-cased UTF-8 text from the first to the last matching shingle;
    ``span`` is that text.  Documents without a match, without words and null texts give no row; equal
    rows give equal matches; without templates nothing is found.
    """
    index = Index(TEMPLATES if templates is None else templates)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            rows = []
            for s in char_batches(list(map(len, texts))):
                rows += [(s.start + r[0], *r[1:]) for r in find(texts[s], index, threshold)]
            which, names, share, lo, hi = map(list, zip(*rows)) if rows else ([],) * 5
            spans = [texts[i].lower().encode("utf-8", "surrogatepass")[x:y].decode("utf-8", "replace") for i, x, y in zip(which, lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(which, pa.int64())), pa.array(names, pa.string()), pa.array(share, pa.float64()),
                 pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(spans, pa.string())],
                names=["doc_id", "license", "containment", "start", "end", "span"])

    return id_text(docs).mapInArrow(run, "doc_id long, license string, containment double, start long, end long, span string")
