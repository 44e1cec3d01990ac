"""License scans: winnowed fingerprints and telling words of templates in inverted indexes pick candidates, banded alignment
reports coverage and spans."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole_text
from .tokens import small_batches, texts_of

# Public license notices, by SPDX-style name and kind of notice.
TEMPLATES = {
    "MIT/line": "Released under the MIT License.",
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC/grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL/notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD/grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
}
# Whole texts of public licenses.
TEMPLATES |= {
    "MIT/text": TEMPLATES["MIT/grant"] + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC/text": TEMPLATES["ISC/grant"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-3-Clause/text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
}
_NOT_WORD = re.compile(r"[\W_]+")


def folded(word: bytes) -> bytes:
    """A word in lower case without marks; may be empty."""
    return _NOT_WORD.sub("", word.decode("utf-8", "replace").lower()).encode()


class Words:
    """Hashes of white-space separated words after folding; 0 for a word that folds to nothing. Remembers words, within a bound."""

    def __init__(self, bound: int = 200_000):
        self.known: dict[bytes, int] = {}
        self.bound = bound

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in [w for w in set(words) if w not in known]:
                f = folded(w)
                known[w] = xxhash.xxh3_64_intdigest(f) if f else 0
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        out = (out ^ h[j : j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def winnowed(g: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest gram of each window of w grams, the rightmost of equals; every gram where there are fewer."""
    if len(g) <= w:
        return np.array([len(g) - 1 - int(np.argmin(g[::-1]))]) if len(g) else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(g, w)
    return np.unique(np.arange(len(windows)) + w - 1 - np.argmin(windows[:, ::-1], axis=1))


@dataclass
class Index:
    """Templates as word hashes, the words each needs, and postings (print, template, position) sorted by print.

    ``grams`` are the winnowed ones of k words. ``singles`` are the longest words of each template, one more than may be
    missing: an occurrence lacks at most that many, so it has at least one of them.
    """

    names: list[str]
    words: list[np.ndarray]
    need: list[int]
    grams: tuple[np.ndarray, np.ndarray, np.ndarray]
    singles: tuple[np.ndarray, np.ndarray, np.ndarray]
    k: int
    w: int


def postings(prints: list[np.ndarray], at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.concatenate([np.zeros(0, np.uint64), *prints])
    order = np.argsort(flat, kind="stable")
    return flat[order], np.repeat(np.arange(len(at)), [len(a) for a in at])[order], np.concatenate([np.zeros(0, np.int64), *at])[order]


def build_index(templates: dict[str, str], least: float, k: int = 3, w: int = 2) -> Index:
    names, reader = sorted(templates), Words()
    chunks = [[c for c in templates[n].encode().split() if folded(c)] for n in names]
    words = [reader.hashes(c) for c in chunks]
    need = [next(n for n in range(1, len(h) + 2) if n >= least * len(h)) for h in words]
    by_gram = [winnowed(grams(h, k), w) for h in words]
    by_word = [np.array(sorted(range(len(c)), key=lambda i: -len(folded(c[i])))[: len(c) - n + 1], np.int64) for c, n in zip(chunks, need)]
    return Index(names, words, need, postings([grams(h, k)[p] for h, p in zip(words, by_gram)], by_gram), postings([h[p] for h, p in zip(words, by_word)], by_word), k, w)


def aligned(text: np.ndarray, template: np.ndarray, band: int) -> tuple[int, int, int]:
    """Banded local alignment of a stretch of text with a template whose words lie within ``band`` of its diagonal.

    A match adds 2, a differing or missing word takes 1. Returns matched words and the first and last word of the best
    stretch (the earliest of equals). Row by row over the template, so work and memory follow its length times the band.
    """
    width = 2 * band + 1
    before = [(0, 0, -1)] * (width + 1)  # score, matches, first word
    best = (0, 0, -1, -1)
    for i in range(len(template)):
        row, left = [], (0, 0, -1)
        for d in range(width):
            j = i + d
            if j >= len(text):
                row.append((0, 0, -1))
                left = (0, 0, -1)
                continue
            up, diagonal = before[d + 1], before[d]
            same = text[j] == template[i]
            s = diagonal[0] + (2 if same else -1)
            cell = (s, diagonal[1] + same, diagonal[2] if diagonal[2] >= 0 else j) if s > 0 else (0, 0, -1)
            for other in (up, left):
                if other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, other[1], other[2])
            row.append(cell)
            left = cell
            if same and (cell[0], -j) > (best[0], -best[3]):
                best = (*cell, j)
        before = [*row, (0, 0, -1)]
    return best[1], best[2], best[3]


def occurrences(words: np.ndarray, template: np.ndarray, need: int, first: int, half: int) -> list[tuple[int, int, int]]:
    """(matched words, first word, last word) of what lies on the 2 * half + 1 diagonals from ``first``: the best, then those beside it."""
    out, ranges = [], [(max(0, first), max(0, min(len(words), first + len(template) + 2 * half)))]
    while ranges:
        lo, hi = ranges.pop()
        if hi - lo < need or np.count_nonzero(np.isin(template, words[lo:hi])) < need:
            continue
        matched, a, b = aligned(np.concatenate([np.zeros(lo - first, np.uint64), words[lo:hi]]), template, half)
        if matched >= need:
            out.append((matched, first + a, first + b))
            ranges += [(lo, first + a), (first + b + 1, hi)]
    return out


def scan(words: np.ndarray, index: Index, band: int) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first word, last word) of each occurrence, the overlapping of one template as the best one.

    An occurrence is found if its words lie within 4 * band of the diagonal of any of its seeds.
    """
    out = []
    g = grams(words, index.k)
    picked = winnowed(g, index.w)
    seeds: dict[int, set[int]] = {}
    for (prints, of, position), at, found in ((index.grams, picked, g[picked]), (index.singles, np.arange(len(words)), words)):
        lo, hi = np.searchsorted(prints, found, "left"), np.searchsorted(prints, found, "right")
        for i in np.flatnonzero(hi > lo):
            for p in range(lo[i], hi[i]):
                seeds.setdefault(int(of[p]), set()).add(int(at[i] - position[p]))
    for t, diagonals in seeds.items():
        found, end = [], None
        for diagonal in sorted(diagonals):
            if end is not None and diagonal <= end:
                continue  # covered by the band of the seed before
            end = diagonal + band
            found += occurrences(words, index.words[t], index.need[t], diagonal - 4 * band, 4 * band + (band + 1) // 2)
        for matched, a, b in sorted(found, key=lambda f: (-f[0], f[1])):
            if all(b < x[2] or a > x[3] for x in out if x[0] == t):
                out.append((t, matched, a, b))
    return sorted(out, key=lambda x: (x[2], x[0]))


MATCH = "license string, coverage double, matched_words long, template_words long, start long, end long"


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, band: int = 4, least: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per occurrence of a template: (id, license, coverage, matched_words, template_words, start, end).

    coverage is matched template words over all of them, at least ``least``; start and end are code points of the source.
    The index is of the templates alone, so its size is that of the parameter. Winnowing with k=3 and w=2 meets every
    shared run of 4 words, and single words what has no such run: at ``least``, one of those in the index is there. Null and empty texts have no matches; null and repeated ids keep their rows; an empty table
    gives no rows; other columns are ignored. No shuffle, one text at a time.
    """
    index = docs.sparkSession.sparkContext.broadcast(build_index(templates, least))

    def run(batches):
        ix, reader = index.value, Words()
        for batch in small_batches(batches):
            rows = []
            for key, text in zip(batch.column("id").to_pylist(), texts_of(batch)):
                chunks = text.split()
                h = reader.hashes(chunks)
                kept = np.flatnonzero(h)
                found = scan(h[kept], ix, band)
                if found:
                    spans = [m.span() for m in re.finditer(r"[^ \t-\r]+", text.decode())]
                    for t, matched, a, b in found:
                        rows.append((key, ix.names[t], matched / len(ix.words[t]), matched, len(ix.words[t]), spans[kept[a]][0], spans[kept[b]][1]))
            types = [batch.schema.field("id").type, pa.string(), pa.float64(), *[pa.int64()] * 4]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", *(f.split()[0] for f in MATCH.split(", "))])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {MATCH}").withColumnRenamed("id", id_col)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of every template in every document; nulls, repeats, empty texts and tables as license_matches() says."""
    return license_matches(spark.read.parquet(f"{sf_dir}/documents.parquet"))
