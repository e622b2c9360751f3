"""9. License scan: winnowed fingerprints, then banded alignment."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import SLICE, Memo, by_bytes, read, session, text_of, trim, words_in
from tidewire.storage import importable

#: Words in a fingerprint, and fingerprints in a winnowing window.
GRAM = 3
WINDOW = 3
#: Least share of a template's words that must align.
COVERAGE = 0.8
#: Templates of fewer words are looked up by single words, as a change can break all their grams.
SHORT = 16
#: Words that are looked up only where a template has too few others.
COMMON = tuple(w.encode() for w in "a an and by for in is of on or the this to under with work".split())

# License texts and notices as their publishers word them.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "LGPL-3.0": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
}

_EDGE = re.compile(r"^\W+|\W+$")


class Words(Memo):
    """64-bit hashes of words in lower case without punctuation around them."""

    def make(self, word: bytes) -> int:
        import xxhash

        return xxhash.xxh64_intdigest(_EDGE.sub("", word.decode("utf-8", "replace").lower()))


_WORDS = Words()


def hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def hashes_in(column: pa.Array) -> Iterator[np.ndarray]:
    """hashes() of each text of a column of bytes."""
    for texts in by_bytes(column, SLICE):
        word, words, bounds = words_in(texts, False)
        every = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))[word]
        yield from (every[i:j] for i, j in zip(bounds[:-1], bounds[1:]))


def grams(h: np.ndarray) -> np.ndarray:
    """A hash of each GRAM words in a row."""
    n = max(0, len(h) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(GRAM):
            out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ h[i : i + n]
            out ^= out >> np.uint64(29)
            out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def winnow(g: np.ndarray) -> list[int]:
    """Places of the rightmost smallest hash of each window, each once."""
    if not len(g):
        return []
    picked = []
    for at in range(max(1, len(g) - WINDOW + 1)):
        part = g[at : at + WINDOW]
        place = at + len(part) - 1 - int(np.argmin(part[::-1]))
        if not picked or picked[-1] != place:
            picked.append(place)
    return picked


class Index:
    """Inverted index of the templates' fingerprints, and of words of the short ones: where enough
    of a template aligns, one of any words more than it may lack does."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.names, self.coverage = list(templates), coverage
        self.words = [hashes(t.encode()) for t in templates.values()]
        self.sets = [set(h.tolist()) for h in self.words]
        short = [i for i, h in enumerate(self.words) if len(h) < SHORT]
        used = Counter(w for i in short for w in self.sets[i])
        common = {_WORDS[w] for w in COMMON}
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        anchors: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, h in enumerate(self.words):
            if i in short:
                rare = sorted(range(len(h)), key=lambda at: (int(h[at]) in common, used[int(h[at])], at))
                for at in rare[: len(h) - self.least(i) + 1]:
                    anchors[int(h[at])].append((i, at))
                continue
            g = grams(h)
            for at in winnow(g):
                postings[int(g[at])].append((i, at))
        self.postings, self.anchors = dict(postings), dict(anchors)
        self.low, self.low_words = self._low(postings), self._low(anchors)

    @staticmethod
    def _low(keys: dict) -> np.ndarray:
        out = np.zeros(1 << 16, bool)
        out[(np.array(sorted(keys), np.uint64) & np.uint64(0xFFFF)).astype(np.int64)] = True
        return out

    def least(self, i: int) -> int:
        """Words of template i that must align."""
        return max(1, math.ceil(self.coverage * len(self.words[i]) - 1e-9))

    def hits(self, h: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """(place in the text, place in the template) by template."""
        g = grams(h)
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at in np.flatnonzero(self.low[(g & np.uint64(0xFFFF)).astype(np.int64)]):
            for i, there in self.postings.get(int(g[at]), ()):
                out[i].append((int(at), there))
        return out

    def notices(self, h: np.ndarray) -> dict[int, set[int]]:
        """Diagonals by short template where a word of it has enough others around."""
        out: dict[int, set[int]] = defaultdict(set)
        for at in np.flatnonzero(self.low_words[(h & np.uint64(0xFFFF)).astype(np.int64)]):
            for i, there in self.anchors.get(int(h[at]), ()):
                t = self.words[i]
                reach = len(t) + 2 * _band(t)
                near = self.sets[i].intersection(h[max(0, at - reach) : at + reach + 1].tolist())
                if len(near) >= self.least(i) - (len(t) - len(self.sets[i])):
                    out[i].add(int(at) - there)
        return out


def _band(t: np.ndarray) -> int:
    return 4 + len(t) // 8


def align(t: np.ndarray, d: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment of template `t` and text `d` within `band` of a diagonal (place in d
    minus place in t): words matched, and the span of d. A match counts 2, a word replaced or left
    out on either side -1."""
    width = 2 * band + 1
    steps = np.arange(width)
    prev, rows, best = np.zeros(width, np.int64), [], (0, 0, 0)
    for i in range(len(t)):
        at = i + diagonal - band + steps
        inside = (at >= 0) & (at < len(d))
        same = np.zeros(width, bool)
        same[inside] = d[at[inside]] == t[i]
        cur = np.maximum(prev + np.where(same, 2, -1), np.append(prev[1:], 0) - 1)
        cur = np.where(inside, np.maximum(cur, 0), 0)
        cur = np.maximum.accumulate(cur + steps) - steps
        rows.append((cur, same))
        j = int(np.argmax(cur))
        best = max(best, (int(cur[j]), -i, j))
        prev = cur
    value, i, j = best[0], -best[1], best[2]
    matched, last, first = 0, -1, -1
    while value > 0:
        cur, same = rows[i]
        up = rows[i - 1][0] if i else np.zeros(width, np.int64)
        if cur[j] == up[j] + (2 if same[j] else -1):
            if same[j]:
                matched += 1
                first = i + diagonal - band + j
                last = first if last < 0 else last
            i, value = i - 1, up[j]
        elif j + 1 < width and cur[j] == up[j + 1] - 1:
            i, j, value = i - 1, j + 1, up[j + 1]
        else:
            j, value = j - 1, cur[j - 1]
        if i < 0:
            break
    return matched, first, last + 1


def _notices(index: Index, h: np.ndarray) -> list[tuple[str, float, int, int, int]]:
    """What `find` gives for short templates. Where several fit one place, the best stay; as they
    differ in a word or two, a notice can be nearly that of another license."""
    found = []
    for i, diagonals in index.notices(h).items():
        t, done = index.words[i], []
        for matched, first, end in sorted({align(t, h, d, _band(t)) for d in diagonals}, key=lambda x: (-x[0], x[2] - x[1], x[1])):
            if matched >= index.least(i) and not any(first < e and s < end for s, e in done):
                done.append((first, end))
                found.append((index.names[i], matched / len(t), matched, first, end))
    return _best(found)


def _best(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Without what lies within a place where more words of another template were found, and of those
    that share most of a place with a template that is covered better or, if alike, in more words."""
    same = lambda x, y: 2 * (min(x[4], y[4]) - max(x[3], y[3])) > max(x[4] - x[3], y[4] - y[3])
    inside = lambda x, y: y[3] <= x[3] and x[4] <= y[4] and x[2] < y[2] and (y[4] - y[3]) * 3 > (x[4] - x[3]) * 4
    found = [x for x in found if not any(x is not y and inside(x, y) for y in found)]
    return [x for x in found if not any(y[1:3] > x[1:3] and same(x, y) for y in found)]


def find(index: Index, text: bytes) -> list[tuple[str, float, int, int, int]]:
    """What `find_in` gives for the words of a text."""
    return find_in(index, hashes(text))


def find_in(index: Index, h: np.ndarray) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, first word, end word) for each place of a text, given its
    words' hashes, that holds enough of a template, in the order of places."""
    coverage = index.coverage
    out = _notices(index, h)
    for i, hits in index.hits(h).items():
        t = index.words[i]
        band = _band(t)
        hits.sort()
        groups: list[list[tuple[int, int]]] = []
        for at, there in sorted(hits, key=lambda x: (x[0] - x[1], x[0])):
            if groups and at - there - (groups[-1][-1][0] - groups[-1][-1][1]) <= band and at - there - (groups[-1][0][0] - groups[-1][0][1]) <= 2 * band:
                groups[-1].append((at, there))
            else:
                groups.append([(at, there)])
        done: set[tuple[int, int]] = set()
        for g in groups:
            starts = sorted(at - there for at, there in g)
            matched, first, end = align(t, h, starts[len(starts) // 2], band)
            if matched >= coverage * len(t) and not any(first < e and s < end for s, e in done):
                done.add((first, end))
                out.append((index.names[i], matched / len(t), matched, first, end))
    return sorted(_best(out), key=lambda x: (x[3], x[4], x[0]))


FOUND = "license string, coverage double, matched long, first_word long, end_word long, span string"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """key, license, coverage, matched, first_word, end_word, span for each license found.

    The index of the templates goes to the executors with the code; each text is read once, whole,
    and nothing is shuffled. Words are runs without ASCII white space, compared in lower case
    without the punctuation around them; places count them from 0; `span` is the words found. Null
    and empty texts, and those without a license, give no row; rows that repeat are each scanned.
    Other columns are not read.
    """
    importable(session(docs))
    index = Index(templates or TEMPLATES, coverage)
    kind = docs.select(F.col(key).alias("__key")).schema["__key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _WORDS.use()
        for b in batches:
            rows, at = [], []
            for r, (t, h) in enumerate(zip(b.column(1), hashes_in(b.column(1)))):
                for name, share, matched, first, end in find_in(index, h):
                    at.append(r)
                    rows.append((name, share, matched, first, end, b" ".join(t.as_py().split()[first:end]).decode("utf-8", "replace")))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["__key", *[x.split()[0] for x in FOUND.split(", ")]]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=names)
        trim()

    texts = docs.select(F.col(key).alias("__key"), text_of(text).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"__key {kind}, {FOUND}").withColumnRenamed("__key", key)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
