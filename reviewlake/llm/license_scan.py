"""License texts in documents: winnowed fingerprints pick candidates, banded alignment confirms them.

Texts and templates are normalised to lower-case words of letters and digits (other ASCII bytes separate
them) joined by one space. Of every ``window`` consecutive k-byte hashes the smallest are
kept (winnowing), so any run of k + window - 1 equal bytes shares a kept hash. The inverted index maps
a kept hash to the places of the templates that hold it; it is as large as the templates, which
are a parameter, and travels with the code. Whole licence texts lie in the folder ``licenses``. Where a
document's kept hashes meet a template, the words around that diagonal are aligned with the template's
in a band, with gaps and replaced words at a cost. A finding reports the matched part of the template
and its span in code points; words put into the span count against it. The words that tell a licence
apart (of short notices also names and numbers) must
stand in the span as in the template, none missing, put in or replaced. Only bands in which enough words of
the template occur at all are aligned, which loses no finding.

Each text is read where it lies; nothing is shuffled. Defined results: null or empty text has no
finding; of overlapping findings the one with more matched words stays, then the first template;
equal findings of repeated rows are reported for each row. A template needs at least k + window - 1 normalised
bytes. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.blocks import _BYTE, Words, range_hashes, slices, utf8, window_starts, words

K, WINDOW = 16, 8
BAND = 8
MIN_COVERAGE = 0.8
BLOCK_BYTES = 2 << 20
#: Notices that name a licence, as they stand in documents.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    **{name: f"This work is licensed under the GNU {kind}General Public License, version {version}." for name, kind, version in (
        ("GPL-2.0", "", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))},
    **{f"{name}-notice": (
        f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General "
        f"Public License as published by the Free Software Foundation{mark[:-1] or ','} either version {version} of the License, or "
        "(at your option) any later version.") for name, work, mark, kind, version in (
            ("GPL-2.0", "program", ";", "", "2"), ("LGPL-2.0", "library", ";", "Library ", "2"),
            ("LGPL-2.1", "library", ";", "Lesser ", "2.1"), ("LGPL-3.0", "program", ":", "Lesser ", "3"),
            ("AGPL-3.0", "program", ":", "Affero ", "3"))},
    **{f"CC-{short}-4.0-notice": f"This work is licensed under a Creative Commons Attribution-{long} 4.0 International License."
       for short, long in (("BY-NC", "NonCommercial"), ("BY-ND", "NoDerivatives"), ("BY-NC-SA", "NonCommercial-ShareAlike"),
                           ("BY-NC-ND", "NonCommercial-NoDerivatives"))},
    **{f"CC-{short}-4.0-short": f"Licensed under CC {short} 4.0." for short in ("BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
}
#: Words that tell licences apart anywhere, and those that do so in a notice of fewer than SHORT words.
KINDS = "affero lesser library noncommercial sharealike noderivatives noderivs"
NAMES = "apache mit bsd isc mozilla gnu gpl lgpl agpl mpl eclipse boost zlib unlicense creative cc nc sa nd"
SHORT = 60

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[48:58] = _BETWEEN[97:123] = _BETWEEN[128:] = False


def shipped() -> dict[str, str]:
    """The notices and the whole licence texts."""
    files = sorted(resources.files("reviewlake.llm").joinpath("licenses").iterdir(), key=lambda f: f.name)
    return TEMPLATES | {f"{f.name.removesuffix('.txt')}-whole": f.read_text("utf-8") for f in files if f.name.endswith(".txt")}


def _hashes(text: str) -> np.ndarray:
    return words(pa.array([text]), lower=True, between=_BETWEEN).joined().hashes()


_DIGITS = _hashes(" ".join(map(str, range(10))))
_VERSION = _hashes("version v")
_KIND = _hashes(KINDS)
_NAME = _hashes(NAMES)


def telling(part: np.ndarray, short: bool) -> np.ndarray:
    """The words of a part that tell a licence apart, in order."""
    number = np.isin(part, _DIGITS)
    if short:
        return part[number | np.isin(part, _KIND) | np.isin(part, _NAME)]
    number[1:] &= np.isin(part[:-1], _VERSION)
    number[:1] = False
    return part[number | np.isin(part, _KIND)]


def fingerprints(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of joined words and the byte each starts at (ascending)."""
    first = np.append(w.starts, len(w.data))[w.first]
    at = window_starts(first, K)
    h = range_hashes(_BYTE[w.data], at, at + K)
    if len(h) <= WINDOW:
        return h, at
    low = h
    for size in (1, 2, 4):
        low = np.minimum(low[:-size], low[size:])
    high = np.concatenate((np.repeat(low[:1], WINDOW - 1), low, np.repeat(low[-1:], WINDOW - 1)))
    for size in (1, 2, 4):                                # largest of the smallest around each hash
        high = np.maximum(high[:-size], high[size:])
    # Windows that reach into the next text may hide a text's first and last hashes; keep those.
    edge = np.zeros(len(h), dtype=bool)
    breaks = np.flatnonzero(np.diff(at) > 1)
    for shift in range(WINDOW):
        edge[np.maximum(breaks - shift, 0)] = True
        edge[np.minimum(breaks + 1 + shift, len(h) - 1)] = True
    keep = (h == high) | edge
    return h[keep], at[keep]


class Index:
    """Kept hashes of the templates (ascending) with template and byte of each, and their words."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        w = words(pa.array(list(templates.values()), pa.string()), lower=True, between=_BETWEEN).joined()
        edges = np.append(w.starts, len(w.data))[w.first]
        if (np.diff(edges) - 1 < K + WINDOW - 1).any():
            raise ValueError(f"a template needs {K + WINDOW - 1} bytes of words at least")
        h, at = fingerprints(w)
        order = np.argsort(h, kind="stable")
        self.hashes, at = h[order], at[order]
        self.template = np.searchsorted(edges, at, side="right") - 1
        self.word = np.searchsorted(w.starts, at, side="right") - 1 - w.first[self.template]
        hashes = w.hashes()
        self.words = [hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.sizes = np.diff(w.first)
        self.telling = [telling(x, len(x) < SHORT) for x in self.words]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in h, entry) of every meeting."""
        low, high = (np.searchsorted(self.hashes, h, side=s) for s in ("left", "right"))
        n = high - low
        of = np.repeat(np.arange(len(h)), n)
        return of, np.repeat(low, n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Best alignment of the whole template with a part of the text, at most ``band`` words off the diagonal.

    Returns (matched words, first text word, text word after the last). Template word i stands
    near text word i + shift. A matched word scores 2; a word left out or put in costs 1; a
    replaced word costs 1; text before and after the part is free.
    """
    width = 2 * band + 1
    none = (-(1 << 30), 0, -1, -1)
    before = [(0, 0, -1, -1)] * (width + 1)                       # (score, matched, first, after) for text words so far
    for i, word in enumerate(template.tolist()):
        row = []
        for j in range(width + 1):
            here = i + shift + j - band                           # number of text words read
            cell = none
            if 0 <= here - 1 < len(text) and j <= width:
                s, m, a, b = before[j]
                if int(text[here - 1]) == word:
                    cell = max(cell, (s + 2, m + 1, a if a >= 0 else here - 1, here))
                else:
                    cell = max(cell, (s - 1, m, a, b))
            if j + 1 <= width:                                    # the template word is left out
                s, m, a, b = before[j + 1]
                cell = max(cell, (s - 1, m, a, b))
            if j and row[j - 1][0] > none[0]:                     # a text word is put in
                s, m, a, b = row[j - 1]
                cell = max(cell, (s - (a >= 0), m, a, b))
            row.append(cell)
        before = row
    # Of equal alignments the one nearest to the diagonal: another may belong to the next notice.
    _, m, a, b = before[max(range(width + 1), key=lambda j: (*before[j][:2], -abs(j - band)))]
    return m, a, b


def most_matched(template: np.ndarray, text: np.ndarray, shift: int, band: int = BAND) -> int:
    """How many template words occur within the band: no alignment there matches more."""
    found = np.zeros(len(template), dtype=bool)
    for off in range(shift - band - 1, shift + band + 1):
        a, b = max(0, -off), min(len(template), len(text) - off)
        if a < b:
            found[a:b] |= template[a:b] == text[a + off:b + off]
    return int(np.count_nonzero(found))


def scan_text(w: Words, row: int, own: np.ndarray, entries: np.ndarray, word_at: np.ndarray, text_words: np.ndarray,
              index: Index, min_coverage: float) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, first word, word after, matched words) found in one row, from its meetings."""
    found, tried = [], set()
    whole = text_words[w.first[row]:w.first[row + 1]]
    own = own[len(whole) >= min_coverage * index.sizes[index.template[entries[own]]]]
    for place, entry in zip(word_at[own].tolist(), entries[own].tolist(), strict=True):
        t = int(index.template[entry])
        shift = place - int(index.word[entry])
        if any((t, near) in tried for near in range(shift - BAND // 2, shift + BAND // 2 + 1)):
            continue                                              # the band of an earlier meeting holds this one
        tried.add((t, shift))
        low = max(shift - BAND, 0)
        part = whole[low:max(shift, 0) + len(index.words[t]) + BAND + 1]
        if most_matched(index.words[t], part, shift - low) < min_coverage * len(index.words[t]):
            continue
        matched, a, b = align(index.words[t], part, shift - low)
        if (matched >= min_coverage * max(len(index.words[t]), b - a)
                and np.array_equal(telling(part[a:b], len(index.words[t]) < SHORT), index.telling[t])):
            found.append((-matched, t, low + a, low + b))
    out: list[tuple[str, float, int, int, int]] = []
    for matched, t, a, b in sorted(set(found)):
        if all(b <= x[2] or a >= x[3] for x in out):
            out.append((index.names[t], -matched / max(len(index.words[t]), b - a), a, b, -matched))
    return sorted(out, key=lambda x: x[2])


def _scan_task(templates: dict[str, str], min_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for block in slices(batches, "text", BLOCK_BYTES):
            raw = words(block.column("text"), lower=True, between=_BETWEEN)
            w = raw.joined()
            h, at = fingerprints(w)
            of, entries = index.hits(h)
            rows: list[tuple] = []
            if len(of):
                word_at = np.searchsorted(w.starts, at[of], side="right") - 1
                row = np.searchsorted(w.first, word_at, side="right") - 1
                text_words = w.hashes()
                word_at = word_at - w.first[row]
                _, offsets = utf8(block.column("text"))
                for r in np.unique(row).tolist():
                    found = scan_text(w, r, np.flatnonzero(row == r), entries, word_at, text_words, index, min_coverage)
                    points = lambda byte, r=r: int(np.count_nonzero(
                        (raw.data[offsets[r]:byte] & 0xC0) != 0x80))
                    for name, coverage, a, b, matched in found:
                        rows.append((block.column("doc_id")[r].as_py(), name, coverage, matched,
                                     points(raw.starts[raw.first[r] + a]), points(raw.ends[raw.first[r] + b - 1])))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "license", "coverage", "matched_words", "start", "stop"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per finding: (doc_id, license, coverage, matched_words, start, stop), spans in code points."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(_scan_task(templates or shipped(), min_coverage),
                          "doc_id long, license string, coverage double, matched_words int, start int, stop int")
