"""License scan: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are few and go to the documents. Of every window of consecutive runs of ``RUN`` words of a
template the one with the smallest hash is indexed, with its place. Windows are as long as recall
allows: if at most e of a template's n words are changed or missing, some ceil((n - e) / (e + 1)) of
the others stand together, and the window is chosen so that any stretch of that length holds an
indexed run. So no text is lost in which the matched words stand as they do in the template. If words
are *inserted* between them, a stretch of that length must be left unbroken.

Hits near one diagonal form a candidate. If enough of the template's words stand in its band at all,
it is aligned there; matched words, coverage and the span in the text are reported, the span is
masked, and the band is aligned again until nothing is found, so each of several copies counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmill.llm import tokens
from txmill.llm.common import per_text, stored

RUN = 2
BAND = 8
COVERAGE = 0.8
#: Words of the templates that are sent to all tasks at a time.
BLOCK_WORDS = 2_000_000

# Short public notices by which licenses are named in texts.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0 notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT line": "Released under the MIT License.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
}


@dataclass(frozen=True)
class Index:
    """Templates as word numbers; fingerprints in ascending order with their template and place."""

    known: dict[str, int]
    names: list[str]
    items: list[np.ndarray]
    #: Different words of each template in ascending order, and how often it has them.
    words: list[tuple[np.ndarray, np.ndarray]]
    hashes: np.ndarray
    owner: np.ndarray
    place: np.ndarray


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of every window, the rightmost of equal ones; all in one if short."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())]) if len(hashes) else np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    picked = np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1)
    return np.unique(picked)


def window_for(words: int, run: int = RUN, coverage: float = COVERAGE) -> int:
    """Longest window of which every stretch that must survive in a found text holds one whole."""
    lost = words - math.ceil(coverage * words - 1e-9)
    stretch = -(-(words - lost) // (lost + 1))
    return max(stretch - run + 1, 1)


def blocks(templates: dict[str, str], block_words: int = BLOCK_WORDS) -> list[dict[str, str]]:
    """Templates by name, in parts of at most ``block_words`` words; a longer one is a part of its own."""
    out: list[dict[str, str]] = [{}]
    held = 0
    for name, template in sorted(templates.items()):
        size = len(tokens.words(template))
        if out[-1] and held + size > block_words:
            out.append({})
            held = 0
        out[-1][name] = template
        held += size
    return out


def build(templates: dict[str, str], run: int = RUN, coverage: float = COVERAGE) -> Index:
    """Index of the templates; those of fewer than ``run`` words cannot be found."""
    found = {n: tokens.words(t) for n, t in sorted(templates.items())}
    found = {n: w for n, w in found.items() if len(w) >= run}
    known = tokens.vocabulary(found.values())
    items = [tokens.numbers(w, known) for w in found.values()]
    hashes, owner, place = [], [], []
    for number, item in enumerate(items):
        every = tokens.runs(item, run)[0]
        picked = winnow(every, window_for(len(item), run, coverage))
        hashes.append(every[picked])
        owner.append(np.full(len(picked), number))
        place.append(picked)
    joined = [np.concatenate([*x, np.empty(0, x[0].dtype if x else np.int64)]) for x in (hashes, owner, place)]
    order = np.argsort(joined[0], kind="stable")
    different = [np.unique(item, return_counts=True) for item in items]
    return Index(known, list(found), items, different, *(x[order] for x in joined))


#: Stands for words that a found copy has taken.
_MASKED = -3


def align(template: np.ndarray, doc: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Matched words, and first and last+1 matched word of ``doc``, in the best local alignment.

    Word i of the template stands near word i + ``shift`` of the document, at most ``band`` away.
    A match gains 1, a mismatch or a gap costs 1; of equal scores the one with more matched words
    is best.
    """
    width = 2 * band + 1
    cost = len(template) + 1
    gain = cost + 1
    offset = np.arange(width) * cost
    padded = np.full(len(template) + width, -2, np.int64)
    low = shift - band
    first, last = max(low, 0), min(low + len(padded), len(doc))
    if last > first:
        padded[first - low : last - low] = doc[first:last]
    score = np.zeros((len(template) + 1, width), np.int64)
    for i, word in enumerate(template, 1):
        same = np.where(padded[i - 1 : i - 1 + width] == word, gain, -cost)
        above = np.append(score[i - 1, 1:], 0) - cost
        best = np.maximum(np.maximum(score[i - 1] + same, above), 0)
        score[i] = np.maximum.accumulate(best + offset) - offset
    i, k = (int(x) for x in np.unravel_index(score.argmax(), score.shape))
    matched, start, end = 0, 0, 0
    while i > 0 and score[i, k] > 0:
        same = padded[i - 1 + k] == template[i - 1]
        if score[i, k] == score[i - 1, k] + (gain if same else -cost):
            if same:
                matched, start = matched + 1, low + i - 1 + k
                end = end or start + 1
            i -= 1
        elif k + 1 < width and score[i, k] == score[i - 1, k + 1] - cost:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return matched, start, end


def shared(words: tuple[np.ndarray, np.ndarray], part: np.ndarray) -> int:
    """How many words of a template a part of a document has at most in common with it."""
    ordered = np.sort(part)
    held = np.searchsorted(ordered, words[0], "right") - np.searchsorted(ordered, words[0], "left")
    return int(np.minimum(held, words[1]).sum())


def aligned(
    doc: np.ndarray, index: Index, run: int = RUN, band: int = BAND, coverage: float = COVERAGE
) -> set[tuple[float, int, int, int, int]]:
    """coverage, matched words, first and last+1 word, template of every copy; spans may overlap."""
    hashes, at = tokens.runs(doc, run)
    if not len(hashes) or not len(index.hashes):
        return set()
    first = np.searchsorted(index.hashes, hashes, "left")
    last = np.searchsorted(index.hashes, hashes, "right")
    candidates = set()
    for p, a, b in zip(at.tolist(), first.tolist(), last.tolist()):
        for e in range(a, b):
            shift = p - int(index.place[e])
            candidates.add((int(index.owner[e]), round(shift / band) * band))
    results, masked, owner = set(), doc, None
    for number, shift in sorted(candidates):
        if number != owner:
            masked, owner = doc.copy(), number
        item = index.items[number]
        least = coverage * len(item) - 1e-9
        first_word, last_word = max(shift - 2 * band, 0), max(shift + len(item) + 2 * band + 1, 0)
        while shared(index.words[number], masked[first_word:last_word]) >= least:
            matched, start, end = align(item, masked, shift, 2 * band)
            if matched < least:
                break
            results.add((matched / len(item), matched, start, end, number))
            masked[start:end] = _MASKED
    return results


def apart(results: Iterable[tuple]) -> list[tuple]:
    """Of overlapping spans, the better covered and longer one; in order of their places."""
    kept: list[tuple] = []
    for r in sorted(results, key=lambda r: (-r[0], -r[1], r[2], r[4])):
        if all(r[3] <= k[2] or k[3] <= r[2] for k in kept):
            kept.append(r)
    return sorted(kept, key=lambda r: r[2])


def _rows(text: str, found: list[str], kept: Iterable[tuple], names: list[str]) -> list[dict]:
    kept = list(kept)
    spans = _places(text, found) if kept else []
    return [
        {
            "license": names[n], "coverage": c, "words": m, "first": a, "last": b,
            "start": spans[a][0], "end": spans[b - 1][1],
        }
        for c, m, a, b, n in kept
    ]


def every_match(text: str, index: Index, run: int = RUN, band: int = BAND, coverage: float = COVERAGE) -> list[dict]:
    """All copies of templates in a text, with the words they span, however they overlap."""
    found = tokens.words(text)
    results = aligned(tokens.numbers(found, index.known), index, run, band, coverage)
    return _rows(text, found, sorted(results), index.names)


def matches(text: str, index: Index, run: int = RUN, band: int = BAND, coverage: float = COVERAGE) -> list[dict]:
    """Templates found in a text, once per copy; where spans overlap, the better covered and longer
    one counts."""
    found = tokens.words(text)
    results = aligned(tokens.numbers(found, index.known), index, run, band, coverage)
    return _rows(text, found, apart(results), index.names)


def _places(text: str, found: list[str]) -> list[tuple[int, int]]:
    """Start and end of each word in the text itself, whose lower case may be longer."""
    lower = text.lower()
    spans = [m.span() for m in tokens.WORD.finditer(lower)]
    if len(lower) == len(text):
        return spans
    origin = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text]).tolist()
    return [(origin[a], origin[b - 1] + 1) for a, b in spans]


_FIELDS = [
    ("license", pa.string()), ("coverage", pa.float64()), ("words", pa.int32()), ("first", pa.int64()),
    ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
]
_KIND = "array<struct<license:string,coverage:double,words:int,first:bigint,last:bigint,start:bigint,end:bigint>>"
_OUT = ["license", "coverage", "words", "start", "end"]


def _finding(find, index: Index, coverage: float):
    def batch(texts: Iterable[str]) -> pa.Array:
        return pa.array([find(t, index, coverage=coverage) for t in texts], pa.list_(pa.struct(_FIELDS)))

    return per_text(batch, _KIND)


def _keep_apart(found: pa.Array) -> pa.Array:
    out = []
    for rows in found.to_pylist():
        by_key = {(r["coverage"], r["words"], r["first"], r["last"], r["license"]): r for r in rows}
        out.append([by_key[k] for k in apart(by_key)])
    return pa.array(out, pa.list_(pa.struct(_FIELDS)))


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per copy of a license: doc_id, license, coverage, words, start, end (code points).

    A document without one gives no row; so do NULL and empty texts and an empty set of templates.
    Repeated rows are all scanned, other columns ignored. No shuffle, unless the templates have more
    than ``block_words`` words: then documents are scanned block by block, what each block finds is
    stored, and overlapping spans of several blocks meet by the document's row.
    """
    parts = blocks(TEMPLATES if templates is None else templates, block_words)
    if len(parts) == 1:
        found = _finding(matches, build(parts[0], coverage=coverage), coverage)
        rows = docs.select(F.col(doc_id), F.explode(found(F.col(text))).alias("found"))
        return rows.select(doc_id, *[f"found.{c}" for c in _OUT])
    numbered = stored(
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")),
        "license-rows",
    )
    passes = []
    for part in parts:
        found = _finding(every_match, build(part, coverage=coverage), coverage)
        rows = numbered.select("id", "row", F.explode(found(F.col("text"))).alias("found"))
        passes.append(stored(rows, "license-matches"))
    every = reduce(DataFrame.unionByName, passes)
    # What a document holds is bounded by its length.
    gathered = every.groupBy("row").agg(F.first("id").alias("id"), F.collect_list("found").alias("found"))
    _keep_apart.__annotations__ = {"found": pa.Array, "return": pa.Array}
    kept = F.arrow_udf(_keep_apart, returnType=_KIND)("found")
    rows = gathered.select(F.col("id").alias(doc_id), F.explode(kept).alias("found"))
    return rows.select(doc_id, *[f"found.{c}" for c in _OUT])
