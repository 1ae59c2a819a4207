"""License scan: winnowed template fingerprints, an inverted index, banded alignment.

Templates, notices and whole licenses, are reduced to words. Of each window of `WINDOW` word k-grams the one of least hash
is kept with its place (winnowing), and all kept ones form an inverted index of fixed size. A
document's k-grams are all looked up; hits that lie near one diagonal of a template propose a
candidate, and a banded local alignment of the document's words against that part of the template
gives the matched words and the span in the text. Alignments of one template that follow each other in text and template, as
where words were put in between, are chained; coverage is the share of the template's words that a chain matches. Winnowing
finds any shared run of WINDOW + K - 1 words.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.kernels import trimmed

K = 3
WINDOW = 2
#: A candidate needs a hit for each so many words of the template.
HIT_WORDS = 10
#: Largest half width of the band around a diagonal, in words.
BAND = 8
#: Least share of a template's words that must match, and least number of matched words.
MIN_COVERAGE = 0.8
MIN_WORDS = 4
MATCH, MISS, GAP = 2, -3, -2
#: Words by which an alignment may reach beyond its outermost hits; hits of a part that is chained; words of text between two
#: parts of a chain, and words that they may share where they meet.
REACH = 24
PART_HITS = 3
MOST_BETWEEN, MEETING = 200, 8
#: Whole licenses, a file for each, named as the license is.
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")

#: Public notices and texts by which licenses are declared.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    ],
    "proprietary": ["All rights reserved."],
}

_WORD = re.compile(r"[^\W_]+(?:[.-](?=[^\W_])[^\W_]+)*")


def whole_texts(folder: str = TEXTS) -> dict[str, list[str]]:
    """Licenses by name from a folder of text files."""
    out = {}
    for file in sorted(os.listdir(folder)):
        with open(os.path.join(folder, file), encoding="utf-8") as text:
            out[os.path.splitext(file)[0]] = [text.read()]
    return out


class Index:
    """Words, winnowed fingerprints and postings of the templates."""

    def __init__(self, templates: dict[str, list[str]] | None = None, k: int = K, window: int = WINDOW):
        self.k, self.names, self.words = k, [], []
        self.vocabulary: dict[str, int] = {}
        given = [TEMPLATES, whole_texts()] if templates is None else [templates]
        for name, texts in (x for part in given for x in part.items()):
            for text in texts:
                words = [w.lower() for w in _WORD.findall(text)]
                if words:
                    self.names.append(name)
                    self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, ids in enumerate(self.words):
            hashes = self.hashes(ids)
            kept = set()
            for a in range(max(1, len(hashes) - window + 1)):
                if part := hashes[a : a + window].tolist():
                    kept.add(a + max(i for i, h in enumerate(part) if h == min(part)))  # the rightmost of least hash
            for at in sorted(kept):
                postings[int(hashes[at])].append((t, at))
        self.postings = dict(postings)
        self.keys = np.array(sorted(self.postings), np.int64)

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        """Hash of each k-gram of word numbers; shorter texts have one of all their words."""
        k = min(self.k, len(ids))
        value = np.zeros(max(0, len(ids) - k + 1), np.uint64)
        for i in range(k):
            value = (value ^ ids[i : i + len(value)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        return (value >> np.uint64(1)).astype(np.int64)


def align(text: np.ndarray, template: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int, int, int, int]:
    """Best local alignment within a band of diagonals (text place - template place): matched words, first and
    end text word, first and end template word, score."""
    size = len(template)
    if 0 <= diagonal <= len(text) - size and (text[diagonal : diagonal + size] == template).all():
        return (size, diagonal, diagonal + size, 0, size, MATCH * size)
    best = (0, 0, 0, 0, 0, 0)
    low = diagonal - band
    width = 2 * band + 1
    nothing = (0, 0, -1, -1)
    words = text.tolist()
    # cell b of row j is text place j + low + b; each holds (score, matches, first text place, first template place)
    above: list[tuple[int, int, int, int]] = [nothing] * (width + 1)
    for j, word in enumerate(template.tolist()):
        row: list[tuple[int, int, int, int]] = []
        for b in range(width):
            i = j + low + b
            if not 0 <= i < len(words):
                row.append(nothing)
                continue
            score, matches, first, top = above[b]
            hit = words[i] == word
            if first < 0 or not score:
                first, top = i, j
            cell = (score + MATCH, matches + 1, first, top) if hit else (score + MISS, matches, first, top)
            if above[b + 1][0] + GAP > cell[0]:
                cell = (above[b + 1][0] + GAP, *above[b + 1][1:])
            if b and row[b - 1][0] + GAP > cell[0]:
                cell = (row[b - 1][0] + GAP, *row[b - 1][1:])
            if cell[0] <= 0:
                cell = nothing
            row.append(cell)
            if hit and cell[0] > best[5]:
                best = (cell[1], cell[2], i + 1, cell[3], j + 1, cell[0])
        above = [*row, nothing]
    return best


def _parts(ids: np.ndarray, template: np.ndarray, hits: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Alignments (matched words, first and end text word, first and end template word) near the diagonals of hits (diagonal,
    template place)."""
    hits.sort()
    size, out, at = len(template), [], 0
    band = min(BAND, max(1, size // 4))  # narrower than the distance of two copies
    while at < len(hits):
        to = bisect_right(hits, (hits[at][0] + band, size))  # hits of one band
        places = sorted((j, d) for d, j in hits[at:to])
        at, first = to, 0
        for k in range(1, len(places) + 1):
            if k < len(places) and places[k][0] - places[k - 1][0] <= 2 * REACH:
                continue
            own, first = places[first:k], k  # hits that an alignment may reach from one to the next
            if len(own) < PART_HITS and len(own) * HIT_WORDS < size:
                continue
            a, b = max(0, own[0][0] - REACH), min(size, own[-1][0] + REACH + K)
            matches, x, y, p, q, _ = align(ids, template[a:b], own[len(own) // 2][1] + a, band)
            if matches:
                out.append((matches, x, y, p + a, q + a))
    return out


def _chains(parts: list[tuple[int, int, int, int, int]], enough: float) -> Iterator[tuple[int, int, int]]:
    """(matched words, first and end text word) of chains with `enough` matched words: parts that have as many alone, and
    parts that follow each other in text and template, the best first; no part is in two chains."""
    rest = []
    for part in parts:
        if part[0] >= enough:
            yield part[:3]
        else:
            rest.append(part)
    rest.sort(key=lambda p: (p[1], p[2]))
    total, before = [p[0] for p in rest], [-1] * len(rest)
    longest = max((p[2] - p[1] for p in rest), default=0)
    for k, (matches, a, _, top, _) in enumerate(rest):
        for i in range(k - 1, -1, -1):
            if rest[i][1] < a - MOST_BETWEEN - longest:
                break
            shared = max(0, rest[i][2] - a, rest[i][4] - top)
            if a - rest[i][2] <= MOST_BETWEEN and shared <= min(MEETING, matches - 1) and rest[i][3] < top and total[i] + matches - shared > total[k]:
                total[k], before[k] = total[i] + matches - shared, i
    used: set[int] = set()
    for k in sorted(range(len(rest)), key=lambda k: (-total[k], k)):
        chain, i = [], k
        while i >= 0 and i not in used:
            chain.append(i)
            i = before[i]
        matches = total[k] - (total[i] if i >= 0 else 0)
        if matches >= enough:
            used |= set(chain)
            yield matches, rest[chain[-1]][1], rest[k][2]


def scan(text: str, index: Index, min_coverage: float = MIN_COVERAGE, min_words: int = MIN_WORDS) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, matched words, start, end) of a text, code points of the text as it is, end exclusive; by start. Of
    spans that overlap the one with more matched words stays, then the higher coverage."""
    low = text.lower()
    if len(low) == len(text):  # letter for letter
        words = [m.span() for m in _WORD.finditer(low)]
        names = [low[a:b] for a, b in words]
    else:  # some letters grow when they are lowered
        words = [m.span() for m in _WORD.finditer(text)]
        names = [text[a:b].lower() for a, b in words]
    if not words:
        return []
    of = index.vocabulary.get
    ids = np.array([of(w, 0) for w in names], np.int64)
    hashes = index.hashes(ids) if len(ids) >= index.k else np.zeros(0, np.int64)
    known = np.convolve(ids > 0, np.ones(index.k, int), "valid") == index.k if len(hashes) else np.zeros(0, bool)
    places = np.flatnonzero(known)
    if len(places):
        at = np.minimum(np.searchsorted(index.keys, hashes[places]), len(index.keys) - 1)
        places = places[index.keys[at] == hashes[places]]
    hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i in places.tolist():
        for t, j in index.postings[int(hashes[i])]:
            hits[t].append((i - j, j))
    found = []
    for t, own in hits.items():
        size = len(index.words[t])
        if len(own) * HIT_WORDS < size:
            continue
        enough = max(min_coverage * size, min(min_words, size))
        for matches, a, b in _chains(_parts(ids, index.words[t], own), enough):
            found.append((matches, min(1.0, matches / size), words[a][0], words[b - 1][1], index.names[t]))
    out: list[tuple] = []
    taken: list[tuple[int, int]] = []  # disjoint, by start
    for matches, coverage, a, b, name in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[4])):
        at = bisect_right(taken, (a, b))
        if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b))
            out.append((name, round(coverage, 6), matches, a, b))
    return sorted(out, key=lambda x: (x[3], x[0]))


def license_scan(docs: DataFrame, index: Index | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, n_licenses, licenses, spans) of every row; spans is 'license:coverage:start:end' joined by commas.

    Columns read: doc_id, text; others are ignored. A null or empty text has none. Rows are independent:
    ties, repeats and null doc_ids pass through. An empty table gives an empty table.
    """
    index = index or Index()
    shipped = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shipped.value
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = scan(text, index, min_coverage) if text else []
                rows.append((len(found), sorted({f[0] for f in found}), ",".join(f"{n}:{c:.4f}:{a}:{b}" for n, c, _, a, b in found)))
            if rows:
                n, names, spans = zip(*rows)
                yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array([",".join(x) for x in names]), pa.array(spans)], ["doc_id", "n_licenses", "licenses", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, n_licenses long, licenses string, spans string")
