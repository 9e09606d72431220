"""Licence scans: which licence texts and notices a document holds, how much of each, and where.

Templates are cut into runs of three words whose hashes are winnowed: of every two neighbouring hashes the smaller one
is kept, so any four words that a text shares with a template share a fingerprint. Templates of under ``SHORT`` words have
all their runs of two words instead, as one edit may leave no run of four. An inverted index leads from a fingerprint to
its places in the templates. A text's own fingerprints are looked up in it; places on about one diagonal make a candidate,
and an alignment in a band around that diagonal says which words match. A match weighs more there than all the edits that
the least coverage allows, so the alignment never leaves out an end of the template beside an edit. The number of matched
words over the template's words is the coverage.

The templates are a parameter with a size the caller sets (the default list has about a dozen); the index is sent to the
tasks, texts stream by once in whole, and nothing is shuffled.

Defined results: a null or empty text has no match; a match inside a longer match of another template is left out; two
matches of one template in one text are two rows; equal rows give equal rows; an empty table gives an empty result;
other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.anchors import Cut, Unit, long_cuts, word_units
from reelframe.llm.common import U64, slices

GRAM, WINNOW = 3, 2
SHORT, PAIR = 16, 2
LEAST = 0.8

# Notices and texts of public licences.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the Software.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                  "in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                  "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                  "language governing permissions and limitations under the License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, "
               "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
               "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
               "PARTICULAR PURPOSE.",
    "CC BY-NC 4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC BY 4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC BY-SA 4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met: Redistributions of source code must retain the above copyright "
           "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
           "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
           "documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
               "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

_FOLD = np.full(256, 32, np.uint8)
for _b in range(256):
    if _b >= 128 or chr(_b).isalnum():
        _FOLD[_b] = ord(chr(_b).lower()) if _b < 128 else _b


def folded_units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of letters and digits in lower case; all other ASCII separates them."""
    return word_units(_FOLD[raw])


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the smallest of every ``WINNOW`` neighbouring hashes, the left one at ties."""
    if len(hashes) < WINNOW:
        return np.arange(len(hashes))
    view = np.lib.stride_tricks.sliding_window_view(hashes, WINNOW)
    return np.unique(view.argmin(axis=1) + np.arange(len(view)))


@dataclass
class Prints:
    """Sorted fingerprints of runs of ``gram`` words, each with its template and place."""

    gram: int
    value: np.ndarray
    template: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, gram: int, rows: list[tuple[int, int, int]]) -> Prints:
        value, template, place = zip(*sorted(rows)) if rows else ((), (), ())
        return cls(gram, np.array(value, U64), np.array(template, np.int64), np.array(place, np.int64))


@dataclass
class Index:
    """Names and word hashes of the templates, and the fingerprints of long and of short ones."""

    names: list[str]
    words: list[np.ndarray]
    prints: list[Prints]
    unit: Unit

    @classmethod
    def of(cls, templates: dict[str, str]) -> Index:
        names, words, rows, short = list(templates), [], [], []
        unit = Unit(folded_units, GRAM, GRAM)
        for i, text in enumerate(templates.values()):
            cut = Cut([text.encode()], unit)
            words.append(cut.hashes)
            if len(cut.hashes) < SHORT:
                short += [(int(g), i, p) for p, g in enumerate(cut.rolling(PAIR))] if len(cut.hashes) >= PAIR else []
            else:
                grams = cut.rolling(GRAM)
                rows += [(int(grams[p]), i, int(p)) for p in winnowed(grams)]
        longest = max(map(len, words), default=GRAM)
        return cls(names, words, [Prints.of(GRAM, rows), Prints.of(PAIR, short)], Unit(folded_units, 3 * longest + 8, GRAM))


def aligned(template: np.ndarray, text: np.ndarray, diagonal: int, band: int, gain: int = 1) -> tuple[int, int, int]:
    """The best local alignment in a band: matched words, and its first and one-past-last word in the text.

    A match scores ``gain``, a substitution, insertion or deletion -1. ``diagonal`` is text place less template place.
    """
    width = 2 * band + 1
    score = np.zeros((len(template) + 1, width + 2), np.int64)
    offset = np.arange(width + 2)
    best, at = 0, (0, 0)
    for i in range(1, len(template) + 1):
        j = i - 1 + diagonal - band + np.arange(width)
        inside = (j >= 0) & (j < len(text))
        equal = np.zeros(width, bool)
        equal[inside] = text[j[inside]] == template[i - 1]
        row = np.maximum(0, np.maximum(score[i - 1, 1:-1] + np.where(equal, gain, -1), score[i - 1, 2:] - 1))
        row[~inside] = 0
        score[i, 1:-1] = row
        score[i, 1:-1] = np.maximum.accumulate(score[i] + offset)[1:-1] - offset[1:-1]
        score[i, 1:-1][~inside] = 0
        top = int(score[i].argmax())
        if score[i, top] > best:
            best, at = int(score[i, top]), (i, top)
    i, c = at
    last, matched, first = i - 1 + diagonal - band + c - 1 + 1, 0, 0
    while i > 0 and score[i, c] > 0:
        j = i - 1 + diagonal - band + c - 1
        equal = 0 <= j < len(text) and text[j] == template[i - 1]
        if score[i, c] == score[i - 1, c] + (gain if equal else -1):
            matched += int(equal)
            first = j if equal else first
            i -= 1
        elif c + 1 <= width and score[i, c] == score[i - 1, c + 1] - 1:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return matched, first, last


def matches(index: Index, cut: Cut, least: float) -> list[tuple[int, int, int, int, int]]:
    """Text, template, matched words, first and one-past-last word (counted in its text) of every match."""
    found: dict[tuple[int, int], list[int]] = defaultdict(list)
    for prints in index.prints:
        if len(cut.hashes) < prints.gram or not len(prints.value):
            continue
        grams = cut.rolling(prints.gram)
        owner = np.searchsorted(cut.end, np.arange(len(grams)), "right")
        whole = np.arange(len(grams)) + prints.gram <= cut.end[np.minimum(owner, len(cut.end) - 1)]
        spot = np.minimum(np.searchsorted(prints.value, grams), len(prints.value) - 1)
        known = prints.value[spot] == grams
        near = np.flatnonzero(known & whole)
        for text in np.unique(owner[near]).tolist():
            begin, end = int(cut.begin[text]), int(cut.end[text])
            own = grams[begin:end - prints.gram + 1]
            chosen = begin + (winnowed(own) if prints.gram == GRAM else np.arange(len(own)))
            for p in chosen[known[chosen]].tolist():
                for row in range(int(spot[p]), int(np.searchsorted(prints.value, grams[p], "right"))):
                    found[text, int(prints.template[row])].append(p - begin - int(prints.place[row]))
    out = []
    for (text, t), hits in found.items():
        template = index.words[t]
        words, band = cut.hashes[cut.begin[text]:cut.end[text]], max(2, len(template) // 8)
        hits.sort()
        last = None
        for diagonal in hits:
            if last is not None and diagonal <= last + band:
                continue
            last = diagonal
            low = max(0, diagonal - band)
            part = words[low:diagonal + len(template) + band + 1]
            matched, first, stop = aligned(template, part, diagonal - low, band, int((1 - least) * len(template)) + 2)
            if matched >= least * len(template):
                out.append((text, t, matched, first + low, stop + low))
    return _clear(out)


def _clear(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of overlapping matches of one template the one with most words; none inside a match of another template."""
    single: list[tuple[int, int, int, int, int]] = []
    for m in sorted(found, key=lambda m: (m[0], m[1], m[3], m[4])):
        if single and single[-1][:2] == m[:2] and m[3] < single[-1][4]:
            if m[2] > single[-1][2]:
                single[-1] = m
        else:
            single.append(m)
    kept, text, reach = [], None, -1
    for m in sorted(single, key=lambda m: (m[0], m[3], -m[4], -m[2], m[1])):
        if m[0] != text:
            text, reach = m[0], -1
        if m[4] > reach:
            kept.append(m)
            reach = m[4]
    return kept


def _scanning(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                texts = [b"" if t is None else t for t in part.column(1).cast(pa.binary()).to_pylist()]
                cuts = [(Cut(texts, index.unit), 0)] if len(texts) > 1 else long_cuts(texts[0], index.unit)
                rows: list[tuple] = []
                ends: dict[tuple[int, str], int] = {}  # a match in the overlap of two parts of a long text comes twice
                for cut, _ in cuts:
                    for text, t, matched, first, stop in matches(index, cut, least):
                        base, moved = int(cut.begin[text]), cut.offset - int(cut.starts[text])
                        start = int(cut.first[base + first]) + moved
                        end = int(cut.last[base + stop - 1]) + moved
                        if start < ends.get((text, index.names[t]), -1):
                            continue
                        ends[text, index.names[t]] = end
                        begin = len(texts[text][:start].decode("utf-8", "ignore"))
                        rows.append((text, index.names[t], begin,
                                     begin + len(texts[text][start:end].decode("utf-8", "ignore")), matched,
                                     len(index.words[t])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([r[1] for r in rows], pa.string()), *[pa.array([r[i] for r in rows], pa.int64())
                                                                    for i in (2, 3, 4, 5)]],
                    ["doc_id", "licence", "first_char", "end_char", "matched_words", "template_words"])
    return run


def licences(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, licence, first_char, end_char, matched_words, template_words, coverage`` for every match."""
    shared = docs.sparkSession.sparkContext.broadcast(Index.of(TEMPLATES if templates is None else templates))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scanning(shared, least), f"doc_id {kind}, licence string, first_char long, end_char long, "
                           "matched_words long, template_words long") \
        .withColumn("coverage", F.col("matched_words") / F.col("template_words"))
