"""License scans by patience alignment of texts with license templates.

Anchors are words that occur once in the text's stretch and once in the template's stretch; the longest increasing subsequence of anchors is
kept, and the gaps between neighbouring anchors are aligned the same way. Where a gap has no anchor, equal words at its two ends
are matched. The share of a template's words that are matched is its coverage.

Where a text uses the template's words elsewhere too, or holds the license twice, few words are unique in the whole text and its alignment falls
short. Then stretches about as long as the template are aligned on their own. Of a covered template at most a share of 1 - threshold is
missing, so one more than that many of its words include one that every such place has: the rarest ones in the text are taken, and each
of their occurrences proposes the stretch that it would stand in.

Every pair of text and template is first bounded from above: no alignment can match more words than the two have in common, counted with
repetition. Only pairs whose bound reaches the threshold are aligned, so texts without a license cost one lookup per word. Templates are few and fixed; they travel with
the job.

Defined results: a null or empty text has no license; words are lower-cased letters and digits, so layout and punctuation do
not matter; of templates with equal coverage the longer one, then the first by name, is named first; a license that stands in a text twice counts once, at
the first of the best alignments found; repeated rows are scanned each. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from popledger.llm.common import keyed, prepare
from popledger.llm.sequences import FOLDED_VALUES, WORD_BYTE, packed, parts, prefix, stretch_hash, words

PART = 1 << 20

# fixed values: wording of common notices and licenses
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
}


@dataclass
class Template:
    name: str
    words: list[int]
    keys: np.ndarray  # different words, sorted
    counts: np.ndarray


def word_hashes(texts: pa.Array) -> Iterator[tuple]:
    data, offsets = packed(texts)
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, word_at = words(piece, at, WORD_BYTE)
        yield i, j, at, starts, ends, word_at, stretch_hash(prefix(FOLDED_VALUES[piece]), starts, ends)


def prepare_templates(templates: dict[str, str]) -> list[Template]:
    """Templates with words, longest first."""
    out = []
    for name, text in templates.items():
        for *_, hashes in word_hashes(pa.array([text])):
            keys, counts = np.unique(hashes, return_counts=True)
            if len(hashes):
                out.append(Template(name, hashes.tolist(), keys, counts))
    return sorted(out, key=lambda t: (-len(t.words), t.name))


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    places: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        tails[k : k + 1] = [v]
        places[k : k + 1] = [i]
        before[i] = places[k - 1] if k else -1
    out, i = [], places[-1] if places else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Matched places (text, template), rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d:
            continue
        once: dict[int, int] = {}
        for i in range(c, d):
            once[template[i]] = -1 if template[i] in once else i
        at: dict[int, int] = {}
        for i in range(a, b):
            if once.get(text[i], -1) >= 0:
                at[text[i]] = -1 if text[i] in at else i
        anchors = sorted((i, once[w]) for w, i in at.items() if i >= 0)
        kept = [anchors[k] for k in longest_rising([t for _, t in anchors])]
        if kept:
            out += kept
            edges = [(a - 1, c - 1), *kept, (b, d)]
            todo += [(x + 1, y, s + 1, t) for (x, s), (y, t) in zip(edges, edges[1:])]
            continue
        # no anchor: equal words at the ends, then the rest once more if anything was matched
        n = 0
        while a + n < b and c + n < d and text[a + n] == template[c + n]:
            out.append((a + n, c + n))
            n += 1
        m = 0
        while a + n < b - m and c + n < d - m and text[b - m - 1] == template[d - m - 1]:
            m += 1
            out.append((b - m, d - m))
        if n or m:
            todo.append((a + n, b - m, c + n, d - m))
    return sorted(out)


def stretches(text: np.ndarray, template: Template, threshold: float) -> list[tuple[int, int]]:
    """Stretches of a text that may hold the template, few and rising."""
    words_ = np.array(template.words, dtype=np.uint64)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    low, high = np.searchsorted(ranked, words_), np.searchsorted(ranked, words_, side="right")
    rarest = np.argsort(high - low, kind="stable")[: int((1 - threshold) * len(words_)) + 1]
    begins = [order[low[q] : high[q]] - q for q in rarest]
    starts = np.unique(np.concatenate(begins)) if begins else np.zeros(0, np.int64)
    slack = len(words_) // 4 + 4
    out: list[tuple[int, int]] = []
    last = None
    for a in starts.tolist():
        # beginnings close to each other propose the same place
        if last is None or a - last > slack // 2:
            out.append((max(0, a - slack), min(len(text), a + len(words_) + slack)))
            last = a
    return out


def bound(text: np.ndarray, template: Template) -> int:
    """Most words of the template that any alignment with the text can match."""
    keys, many = np.unique(text, return_counts=True)
    at = np.minimum(np.searchsorted(template.keys, keys), len(template.keys) - 1)
    return int(np.minimum(many, template.counts[at])[template.keys[at] == keys].sum())


def best_alignment(text: np.ndarray, template: Template, threshold: float) -> list[tuple[int, int]]:
    """The alignment of the whole text, or of a stretch of it where that matches too little and the stretch more."""
    need = threshold * len(template.words)
    best = align(text.tolist(), template.words)
    if len(best) < need:
        for a, b in stretches(text, template, threshold):
            if bound(text[a:b], template) >= max(need, len(best) + 1):
                found = align(text[a:b].tolist(), template.words)
                if len(found) > len(best):
                    best = [(a + i, j) for i, j in found]
    return best


SCANS = "doc_id bigint, license string, coverage double, matched bigint, span_start bigint, span_end bigint, licenses array<string>"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the license that covers best with its coverage, words matched and byte span (null without one), and all
    licenses whose coverage reaches ``threshold``."""
    prepare(docs.sparkSession)
    known = prepare_templates(TEMPLATES if templates is None else templates)
    every = np.unique(np.concatenate([t.keys for t in known] or [np.zeros(0, np.uint64)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[tuple]] = [[] for _ in range(batch.num_rows)]
            for i, j, at, starts, ends, word_at, hashes in word_hashes(batch.column(1)):
                if not len(hashes) or not len(every):
                    continue
                place = np.minimum(np.searchsorted(every, hashes), len(every) - 1)
                hit = np.flatnonzero(every[place] == hashes)
                doc = np.searchsorted(word_at, hit, side="right") - 1
                pairs, many = np.unique(doc * len(every) + place[hit], return_counts=True)
                for t in known:
                    own = np.searchsorted(every, t.keys)
                    need = np.zeros(len(every), dtype=np.int64)
                    need[own] = t.counts
                    most = np.bincount(pairs // len(every), np.minimum(many, need[pairs % len(every)]), j - i)
                    for d in np.flatnonzero(most >= threshold * len(t.words)):
                        a, b = word_at[d], word_at[d + 1]
                        matched = best_alignment(hashes[a:b], t, threshold)
                        share = len(matched) / len(t.words)
                        if share >= threshold:
                            span = int(starts[a + matched[0][0]] - at[d]), int(ends[a + matched[-1][0]] - at[d])
                            found[i + d].append((-share, -len(t.words), t.name, len(matched), *span))
            best = [min(x) if x else None for x in found]
            column = lambda k, kind: pa.array([None if x is None else x[k] for x in best], kind)
            yield pa.record_batch(
                [
                    batch.column(0), column(2, pa.string()), pa.array([None if x is None else -x[0] for x in best], pa.float64()), column(3, pa.int64()),
                    column(4, pa.int64()), column(5, pa.int64()), pa.array([sorted(y[2] for y in x) for x in found], pa.list_(pa.string())),
                ],
                names=["doc_id", "license", "coverage", "matched", "span_start", "span_end", "licenses"],
            )

    return keyed(docs, key, text).mapInArrow(run, SCANS)
