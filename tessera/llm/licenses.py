"""License scans by patience alignment.

A template's words are aligned with the words of a text: words that are
unique to both sides are anchors, the longest increasing subsequence of the
anchors is kept, equal neighbours extend it, and each gap between kept words
is aligned in the same way, with the words that are unique within it.  The
share of the template's words that are matched is its coverage.

A text may hold several notices, or one notice twice, among much else.  It is
first cut into regions: stretches in which words of the template follow each
other with fewer than ``MAX_GAP`` other words between; within a region, each
word that begins the template opens a place of its own, and what lies before
and after an aligned notice is aligned again.  Neighbouring regions without a
notice are also aligned together, where the words between them are no more
than the template has.  A region with too few template words to reach the
least coverage is not aligned.  Of notices that overlap,
the best one is kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_text

MIN_COVERAGE = 0.8
MAX_GAP = 6

#: Short notices, as texts refer to their licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, "
                    "are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                "and associated documentation files, to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General "
        "Public License as published by the Free Software Foundation, either version {2} of the License, or (at your "
        "option) any later version.")
_CC = "This work is licensed under a Creative Commons {} 4.0 International License"
#: Standard headers and short license texts, as the licenses state them.  Some are here so
#: that no sibling is taken for them (GPL-2.0 differs from GPL-3.0 by one word).
HEADERS = {
    "AGPL-3.0": [_GNU.format("program", "Affero ", "3")],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission."],
    "CC-BY-4.0": [_CC.format("Attribution")],
    "CC-BY-NC-4.0": [_CC.format("Attribution-NonCommercial")],
    "CC-BY-SA-4.0": [_CC.format("Attribution-ShareAlike")],
    "GPL-2.0": [_GNU.format("program", "", "2")],
    "GPL-3.0": [_GNU.format("program", "", "3")],
    "LGPL-2.1": [_GNU.format("library", "Lesser ", "2.1")],
    "LGPL-3.0": [_GNU.format(w, "Lesser ", "3") for w in ("program", "library")],
    "MIT-text": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
}
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
               for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_SPLIT).split() if text else []


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Increasing pairs (i, j) with a[i] == b[j]: patience alignment of two word lists."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:  # equal neighbours at the start
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:  # and at the end
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        anchors = _anchors(a, b, alo, ahi, blo, bhi)
        if not anchors:
            continue
        last = (alo, blo)
        for i, j in anchors:
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        out += anchors
        todo.append((last[0], ahi, last[1], bhi))
    return sorted(out)


def _anchors(a, b, alo, ahi, blo, bhi) -> list[tuple[int, int]]:
    """Longest increasing subsequence of the words unique in both ranges."""
    once_a, once_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
    place = {b[j]: j for j in range(blo, bhi) if once_b[b[j]] == 1}
    pairs = [(i, place[a[i]]) for i in range(alo, ahi) if once_a[a[i]] == 1 and a[i] in place]
    ends: list[int] = []  # least end of an increasing run of each length
    at: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(ends, j)
        before.append(at[p - 1] if p else -1)
        if p == len(ends):
            ends.append(j)
            at.append(k)
        else:
            ends[p], at[p] = j, k
    k = at[-1] if at else -1
    out = []
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


class Template:
    def __init__(self, name: str, text: str, min_coverage: float):
        self.name, self.words = name, words_of(text.encode())
        self.need = max(1, ceil(len(self.words) * min_coverage - 1e-9))
        self.counts = Counter(self.words)
        self.vocabulary = frozenset(self.words)

    def runs(self, hits: list[int]) -> list[list[int]]:
        """``hits`` (places of the template's words), cut where ``MAX_GAP`` is exceeded."""
        cuts = [k for k in range(1, len(hits)) if hits[k] - hits[k - 1] > MAX_GAP]
        return [hits[x:y] for x, y in zip([0, *cuts], [*cuts, len(hits)])]

    def notices(self, words: list[bytes], run: list[int]) -> list[tuple]:
        """(license, coverage, matched words, start, end) of all notices in a run; they may overlap."""
        cuts = [i for i, at in enumerate(run) if i and words[at] == self.words[0]]
        out = []
        for x, y in zip([0, *cuts], [*cuts, len(run)]):
            out += self._aligned(words, run[x:y])
        if cuts and (not out or self.words.count(self.words[0]) > 1):  # the first word may be one of the middle
            out += self._aligned(words, run)
        return out

    def across(self, words: list[bytes], runs: list[list[int]], found: list[tuple]) -> list[tuple]:
        """Notices that longer insertions cut into several runs, from what the ones ``found`` within runs leave.

        The insertions between its runs have as many words as the template at most.
        """
        out = []
        pieces: list[list[int]] = []
        taken = sorted(n[3:] for n in found)
        k = 0
        for run in runs:
            while k < len(taken) and taken[k][1] <= run[0]:
                k += 1
            while run and k < len(taken) and taken[k][0] <= run[-1]:
                start, end = taken[k]
                pieces += [run[:bisect_left(run, start)], []]  # no notice goes across another one
                run = run[bisect_left(run, end):]
                k += 1
            if run:
                pieces.append(run)
        for i, first in enumerate(pieces):
            gap, hits = 0, first
            for j in range(i + 1, len(pieces)):
                if not first or not pieces[j]:
                    break
                gap += pieces[j][0] - hits[-1] - 1
                if gap > len(self.words):
                    break
                hits = hits + pieces[j]
                for x in (0, *(x for x, at in enumerate(first) if x and words[at] == self.words[0])):
                    if (self.counts & Counter(words[at] for at in hits[x:])).total() >= self.need:
                        out += self._aligned(words, hits[x:])
        return out

    def _aligned(self, words, run) -> list[tuple]:
        """The notice that a stretch aligns to, and those before and after it."""
        out, todo = [], [run]
        while todo:
            run = todo.pop()
            if len(run) < self.need:
                continue
            lo = run[0]
            pairs = align(words[lo:run[-1] + 1], self.words)
            if len(pairs) >= self.need:
                start, end = lo + pairs[0][0], lo + pairs[-1][0] + 1
                out.append((self.name, len(pairs) / len(self.words), len(pairs), start, end))
                todo += [run[:bisect_left(run, start)], run[bisect_left(run, end):]]
        return out


def _rank(notice: tuple) -> tuple:
    """Best first: most coverage, then most matched words, then the first place, then the name."""
    name, coverage, matched, start, end = notice
    return -coverage, -matched, start, name, end


def scan(templates: list[Template], text: bytes | None) -> list[tuple]:
    """(license, coverage, matched words, start, end) of the notices in a text, the best one first.

    No two overlap: of those that do, the best one stays.
    """
    words = words_of(text)
    found = []
    places: dict[bytes, list[int]] = {}
    wanted = frozenset().union(*(t.vocabulary for t in templates)) if templates else frozenset()
    for i, w in enumerate(words):
        if w in wanted:
            places.setdefault(w, []).append(i)
    for t in templates:
        if not t.words or sum(w in places for w in t.words) < t.need:
            continue
        hits = sorted(i for w in t.vocabulary if w in places for i in places[w])
        runs = t.runs(hits)
        own = [n for run in runs if len(run) >= t.need for n in t.notices(words, run)]
        found += own + t.across(words, runs, own)
    kept: list[tuple] = []
    taken: list[tuple[int, int]] = []  # sorted places of those kept
    for notice in sorted(set(found), key=_rank):
        start, end = notice[3:]
        at = bisect_left(taken, (start, end))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            taken.insert(at, (start, end))
            kept.append(notice)
    return kept


def scan_licenses(df: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``df`` with license, coverage, n_matched, start, end (word places, end exclusive) and notices.

    A row for each row of ``df``.  ``notices`` has all notices of at least
    ``min_coverage`` in the order of their places, none overlapping; the other
    columns are those of the best one.  Texts without a notice, null and empty
    texts have null results and no notices.  Templates without words match
    nothing.  The whole text is scanned.  Columns named like a result column
    are replaced.
    """
    chosen = list((TEMPLATES if templates is None else templates).items())
    if templates is None:
        chosen += [(n, t) for n, texts in HEADERS.items() for t in texts]

    def start():
        own = [Template(n, t, min_coverage) for n, t in sorted(chosen)]
        kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
        one = pa.struct(list(zip(("license", "coverage", "n_matched", "start", "end"), kinds)))

        def work(texts):
            found = [scan(own, t) for t in texts]
            best = zip(*(f[0] if f else (None,) * 5 for f in found))
            every = [[dict(zip(one.names, n)) for n in sorted(f, key=lambda n: n[3])] for f in found]
            return [*(pa.array(c, k) for c, k in zip(best, kinds)), pa.array(every, pa.list_(one))]
        return work

    fields = [T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
              T.StructField("n_matched", T.LongType()), T.StructField("start", T.LongType()),
              T.StructField("end", T.LongType())]
    return map_text(df, text_col, [*fields, T.StructField("notices", T.ArrayType(T.StructType(fields)))], start, as_bytes=True)
