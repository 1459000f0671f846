"""License scans (operator 6).

Word k-grams of the templates are winnowed (the smallest hash of every window
is a fingerprint) into an inverted index. A document's k-grams that are in the
index give candidate (template, place) pairs; a banded alignment around that
place reports how much of the template the passage covers, and where.

Defined results: null or empty texts, and templates without words, match
nothing; overlapping passages of one template give one row, the best (equal
ones: the first); passages of several templates give a row each; rows that
repeat a document each get their own rows; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm.align import align_pairs
from strata.llm.common import id_type, ids_and_text, map_texts
from strata.llm.decontaminate import _expand
from strata.llm.textcore import Words, ngrams, words

#: Notices of public licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
]
GRAM_WORDS = 3
WINDOW = 4
#: Words that a passage may be shifted against its template: at most this,
#: and a third of the template, so that a second passage beside it stays apart.
BAND = 12
#: Share of a template's words that a passage must match.
MIN_COVERAGE = 0.8


class TemplateIndex:
    """Inverted index of winnowed fingerprints; its size is the templates'."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        w = words([t for _, t in templates])
        self.words = [w.hash[w.of(i)] for i in range(len(templates))]
        rows = []
        for i in range(len(templates)):
            own = Words(self.words[i], w.begin[w.of(i)], w.end[w.of(i)], np.array([0, len(self.words[i])]))
            n = min(GRAM_WORDS, len(own.hash))
            h, at = ngrams(own, n) if n else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            rows += [(n, int(h[j]), i, int(at[j])) for j in self.winnow(h)]
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in {r[0] for r in rows}:
            mine = sorted(r[1:] for r in rows if r[0] == n)
            self.grams[n] = (np.array([r[0] for r in mine], np.uint64), *(np.array([r[k] for r in mine], np.int64) for k in (1, 2)))

    @staticmethod
    def winnow(h: np.ndarray) -> list[int]:
        """The rightmost smallest hash of every window of ``WINDOW``."""
        if len(h) <= WINDOW:
            return list(range(len(h)))  # a short text keeps all
        view = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
        return sorted({int(i + WINDOW - 1 - np.argmin(v[::-1])) for i, v in enumerate(view)})

    def candidates(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(template, word where it would begin) of all index hits, once each."""
        parts = [np.zeros((2, 0), np.int64)]
        for n, (hashes, template, pos) in self.grams.items():
            h, at = ngrams(w, n)
            lo = np.searchsorted(hashes, h)
            found = np.flatnonzero(hashes[np.minimum(lo, len(hashes) - 1)] == h)
            k, which = _expand(lo[found], np.searchsorted(hashes, h[found], side="right"))
            parts.append(np.stack([template[k], at[found][which] - pos[k]]))
        return tuple(np.unique(np.concatenate(parts, axis=1), axis=1))


def scan(texts: list[str], index: TemplateIndex, min_coverage: float = MIN_COVERAGE) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, template, coverage, begin, end) with character positions."""
    w = words(texts)
    t, begin = index.candidates(w)
    if not len(t):
        return
    size = np.array([len(x) for x in index.words])
    bands = np.clip(size // 3, 1, BAND)
    # The text of a candidate is that of the hit's words; a begin before the
    # text is cut off by padding.
    anchor = np.clip(begin, 0, len(w.hash) - 1)
    ts, ds, rows = [], [], []
    for k, (i, b, a) in enumerate(zip(t.tolist(), begin.tolist(), anchor.tolist(), strict=True)):
        doc = int(np.searchsorted(w.first, a, side="right") - 1)
        # A template that begins in one text and is hit in the next lies in both.
        last = int(np.searchsorted(w.first, min(max(b + int(size[i]) - 1, 0), len(w.hash) - 1), side="right") - 1)
        for d in range(doc, last + 1):
            lo, hi = int(w.first[d]), int(w.first[d + 1])
            if lo == hi:
                continue
            from_, to = b - int(bands[i]), b + int(size[i] + bands[i])
            part = w.hash[max(from_, lo) : min(to, hi)]
            lead = max(from_, lo) - from_
            ds.append(np.concatenate([np.ones(lead, np.uint64), part]) if lead else part)
            ts.append(index.words[i])
            rows.append((d, i, from_))
    doc, which, base = (np.array(x) for x in zip(*rows, strict=True))
    matches, first, last = np.zeros(len(ts)), base.copy(), base.copy()
    for band in np.unique(bands[which]).tolist():
        some = np.flatnonzero(bands[which] == band)
        got = align_pairs([ts[k] for k in some], [ds[k] for k in some], band=band)
        matches[some], first[some], last[some] = got.matches, base[some] + got.d_begin, base[some] + got.d_end - 1
    coverage = matches / size[which]
    good = np.flatnonzero(coverage >= min_coverage)
    taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for k in good[np.lexsort((first[good], -coverage[good], which[good], doc[good]))].tolist():
        spans = taken.setdefault((int(doc[k]), int(which[k])), [])
        if all(last[k] < a or first[k] > b for a, b in spans):
            spans.append((int(first[k]), int(last[k])))
            yield int(doc[k]), int(which[k]), float(coverage[k]), int(w.begin[first[k]]), int(w.end[last[k]])


def license_matches(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    min_coverage: float = MIN_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per passage: ``license``, ``coverage`` and characters
    ``begin:end`` of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates))

    def run(rows: pa.RecordBatch, texts: list[str]) -> dict | None:
        found = list(scan(texts, shared.value, min_coverage))
        if not found:
            return None
        doc, which, coverage, begin, end = zip(*found, strict=True)
        return {
            "doc_id": rows.column("doc_id").take(pa.array(doc)),
            "license": [shared.value.names[i] for i in which],
            "coverage": coverage,
            "begin": begin,
            "end": end,
        }

    schema = f"doc_id {id_type(docs, id_col)}, license string, coverage double, `begin` int, `end` int"
    return map_texts(ids_and_text(docs, id_col, text_col), run, schema)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return license_matches(table(spark, sf_dir, "documents"))
