"""License scan: which license templates a text holds, how much of each and
where.

The templates' winnowed fingerprints (the smallest of every ``window``
consecutive hashes of ``k`` words) form an inverted index.  A text's winnowed
fingerprints that the index holds vote for (template, place); a banded
sequence alignment of the words around each place then gives the share of
the template that is matched and the span.

Plan: one pass over the texts, no shuffle.  The index is as large as the
templates, which are a parameter.  Only texts with a common fingerprint are
aligned.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wordloom.llm.common import pieces, small_batches

# Notices, headers, grant and condition paragraphs to look for
# (name, text); -excerpt marks a part of another entry.
TEMPLATES = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT-notice", "Released under the MIT License."),
    ("MIT-text",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software."),
    ("MIT-grant-excerpt",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so"),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-header",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("LGPL-3.0-header",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("AGPL-3.0-header",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("MPL-2.0-notice",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0-notice",
     "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
     "to this software to the public domain worldwide."),
    ("Unlicense-notice", "This is free and unencumbered software released into the public domain."),
    ("BSD-redistribution-excerpt",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("BSD-2-Clause-conditions",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
     "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    ("BSD-3-Clause-conditions",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
     "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
     "contributors may be used to endorse or promote products derived from this software without specific prior "
     "written permission."),
    ("ISC-text",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
]

_TOKEN = re.compile(r"[^\W_]+")
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash (the last of equals) of each window of
    consecutive hashes; the smallest of all if there are fewer."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min())[-1:] if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(1))


class Index:
    """Inverted index of the templates' winnowed fingerprints."""

    def __init__(self, templates: list[tuple[str, str]], k: int = 3, window: int = 2, band: int = 8):
        self.k, self.window, self.band = k, window, band
        self.names = [name for name, _ in templates]
        self.vocab: dict[str, int] = {}
        self.words = [[self.vocab.setdefault(w, len(self.vocab) + 1) for w in _TOKEN.findall(text.lower())]
                      for _, text in templates]
        self.sets = [np.array(sorted(set(ids)), np.uint64) for ids in self.words]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.words):
            h = self.hashes(np.array(ids, np.uint64))
            for p in (winnow(h, window) if len(h) else []):
                self.postings.setdefault(int(h[p]), []).append((t, int(p)))
        self.keys = np.array(sorted(self.postings), np.uint64)

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        """Hash of every k consecutive words; the largest value where one is
        not a template word, so that such places never win a window of
        template words."""
        m = len(ids) - self.k + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        h, known = np.zeros(m, np.uint64), np.ones(m, bool)
        for i in range(self.k):
            h = (h ^ (ids[i:m + i] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            known &= ids[i:m + i] > 0
        return np.where(known, h >> np.uint64(1), _FAR)

    def matches(self, text: str | None, least: float) -> list[tuple[int, int, float, int, int]]:
        """(template, matched words, coverage, first character, end character)
        of the matches with at least the coverage ``least``, in text order; of
        matches of one template that overlap only the best stays."""
        if not text:
            return []
        lower = text.lower()
        source = lower if len(lower) == len(text) else text  # some letters grow when lowered
        tokens = _TOKEN.findall(source)
        if source is text:
            tokens = [w.lower() for w in tokens]
        ids = np.fromiter((self.vocab.get(w, 0) for w in tokens), np.uint64, len(tokens))
        h = self.hashes(ids)
        if not len(h) or not len(self.keys):
            return []
        places = np.flatnonzero(np.isin(h, self.keys))
        if not len(places):
            return []
        found = list(_TOKEN.finditer(source))
        chosen = winnow(h, self.window)
        starts: dict[int, list[int]] = {}
        for p in np.intersect1d(places, chosen).tolist():
            for t, q in self.postings[int(h[p])]:
                starts.setdefault(t, []).append(p - q)
        out = []
        for t, diagonals in starts.items():
            best: list[tuple] = []
            last = None
            for d in sorted(set(diagonals)):
                if last is not None and d - last <= self.band:
                    continue  # within the band of the place already aligned
                last = d
                best += self.alignments(t, ids, d, least)
            taken: list[tuple] = []
            for n, a, b in sorted(best, key=lambda x: (-x[0], x[1])):
                if all(b <= c or a >= e for _, c, e in taken):
                    taken.append((n, a, b))
            out += [(t, n, n / len(self.words[t]), found[a].start(), found[b - 1].end()) for n, a, b in taken]
        return sorted(out, key=lambda x: (x[3], x[4], x[0]))

    def alignments(self, t: int, ids: np.ndarray, diagonal: int, least: float) -> list[tuple[int, int, int]]:
        """The alignments of template ``t`` around a diagonal with at least
        the coverage ``least``: the best one, then the best ones of the words
        left and right of it, and so on."""
        size, band, out = len(self.words[t]), 2 * self.band, []
        known = np.isin(ids[max(0, diagonal - band):diagonal + size + band], self.sets[t])
        start = max(0, diagonal - band)
        open_ = [(start, start + len(known))]
        while open_:
            lo, hi = open_.pop()
            if known[lo - start:hi - start].sum() / size < least:
                continue  # too few words of the template for a match
            hit = self.align(t, ids, diagonal, lo, hi)
            if hit:
                if hit[0] / size >= least:
                    out.append(hit)
                open_ += [(lo, hit[1]), (hit[2], hi)]
        return out

    def align(self, t: int, ids: np.ndarray, diagonal: int, lo: int = 0, hi: int | None = None) -> tuple[int, int, int] | None:
        """(matched words, first word, end word) of the best local alignment
        of template ``t`` with the words ``lo`` to ``hi`` of the text inside
        the band around a diagonal (a match scores 2, a mismatch or a gap -1)."""
        words, band, n = self.words[t], 2 * self.band, len(ids) if hi is None else hi
        best, previous = (0, 0, 0, 0), {}  # column -> (score, matches, first word)
        for i, w in enumerate(words):
            row: dict[int, tuple[int, int, int]] = {}
            for j in range(max(lo, diagonal + i - band), min(n, diagonal + i + band + 1)):
                same = int(ids[j]) == w
                score, hits, first = previous.get(j - 1, (0, 0, j))
                cell = (score + 2, hits + 1, first if score else j) if same else (score - 1, hits, first)
                for other in (previous.get(j), row.get(j - 1)):
                    if other and other[0] - 1 > cell[0]:
                        cell = (other[0] - 1, other[1], other[2])
                if cell[0] > 0:
                    row[j] = cell
                    if same and cell[:2] > best[:2]:
                        best = (cell[0], cell[1], cell[2], j + 1)
            previous = row
        return best[1:] if best[1] else None


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", min_coverage: float = 0.8, k: int = 3, window: int = 2) -> DataFrame:
    """One row per match: id, license (the template's name), matched_words,
    coverage (matched words / template words), first_char and end_char (code
    points of the text, end exclusive).

    Words are runs of letters and digits, compared in lower case.  A text
    that shares ``window + k - 1`` words in a row with a template is found as
    a candidate.  Null and empty texts and templates shorter than ``k`` words
    match nothing; repeated rows match each on their own; a template given
    twice is reported twice.  Other columns are ignored.
    """
    index = Index(TEMPLATES if templates is None else templates, k, window)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(index)  # as large as the templates
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("license", T.StringType()),
                           T.StructField("matched_words", T.LongType()), T.StructField("coverage", T.DoubleType()),
                           T.StructField("first_char", T.LongType()), T.StructField("end_char", T.LongType())])

    def run(batches):
        index = shared.value
        for batch in batches:
            for part in pieces(batch, text_col):
                at, rows = [], []
                for i, text in enumerate(part.column(text_col).to_pylist()):
                    for m in index.matches(text, min_coverage):
                        at.append(i)
                        rows.append(m)
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).take(pa.array(at, pa.int64())), pa.array([index.names[t] for t in cols[0]], pa.string()),
                     pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], names=schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)
