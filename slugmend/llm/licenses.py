"""License scans: winnowed fingerprints of templates pick candidates, banded alignment reports them.

Templates (license notices and texts) are cut into fingerprints of ``GRAM``
words, winnowed to the smallest hash of every ``WINDOW`` neighbours (short
templates keep all), and put in an inverted index: fingerprint -> template and
position. Every text looks up all its word triples in that index. Hits of one
template on neighbouring diagonals (position in the text less position in the
template) are one candidate; a candidate with enough of the template's
fingerprints is aligned, word by word, within a band around its diagonals
(Smith and Waterman). Reported are the template's words that match, their
share (``coverage``: of the template's words, or of the span's if there are more,
so that inserted words count against the match), and the span in the text.
Alignments below ``MIN_COVERAGE`` are left out, and those inside a better fitting
one.

Licenses of one family differ in single words. These *marks* (version numbers,
Affero, Lesser, NonCommercial, ShareAlike, NoDerivatives and their short forms)
must be the same in a template and its span: a notice without its version, or with
another, is not reported as the one of the template. Only where no other license
has the same words may a notice of ``LONG`` words have lost a mark to damage.

The templates are a fixed list, a few kilobytes, sent with the function; one
map over the texts, no shuffle. A template is looked for wherever it stands,
any number of times, in whole texts.

Edge cases: null and empty texts have no matches and so no row; repeated rows
give repeated matches; equal alignments of two templates keep the first by
name; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from slugmend.llm.common import map_arrow, slices, texts_of

GRAM = 3
WINDOW = 4
MIN_COVERAGE = 0.8
#: Templates of as many words may miss a mark in the text, if they are the only ones of their words.
LONG = 30
#: Share of a template's fingerprints that makes a candidate.
MIN_HITS = 0.2

# Published license notices and texts, as found in source files and documents.
TEMPLATES: dict[str, str] = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0/notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "BSD-3-Clause/text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED.""",
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0/line": "Licensed under CC BY-SA 4.0",
    "EPL-1.0/notice": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html""",
    "EPL-2.0/notice": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "CC0-1.0/line": "To the extent possible under law, the author has waived all copyright and related rights to this work",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0/notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "ISC/text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT/line": "Released under the MIT License",
    "MIT/text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "MPL-2.0/notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Proprietary/line": "All rights reserved",
    "Unlicense/line": "This is free and unencumbered software released into the public domain",
}
_DISCLAIMER = """ IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
    SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
    LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
    STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
    ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# The whole texts beside their first parts, which are also found alone.
TEMPLATES["BSD-3-Clause/whole"] = TEMPLATES["BSD-3-Clause/text"] + _DISCLAIMER
TEMPLATES["BSD-2-Clause/whole"] = re.sub(
    r"3\. Neither the name.*?written\s+permission\. ", "", TEMPLATES["BSD-3-Clause/whole"], flags=re.S
)
TEMPLATES["MIT/whole"] = TEMPLATES["MIT/text"] + """ IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
    DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
    THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
TEMPLATES["ISC/whole"] = TEMPLATES["ISC/text"] + """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
    REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
    LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
    OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
    USE OR PERFORMANCE OF THIS SOFTWARE."""
for _kind, _versions in {"": "2 3", "Lesser": "2.1 3", "Affero": "3", "Library": "2"}.items():
    for _v in _versions.split():
        _name = f"{ {'': '', 'Lesser': 'L', 'Affero': 'A', 'Library': 'L'}[_kind]}GPL-{_v}{'' if '.' in _v else '.0'}"
        for _form, _said in (("line", TEMPLATES["GPL-3.0/line"]), ("notice", TEMPLATES["GPL-3.0/notice"])):
            _said = re.sub(r"General\s+Public", f"{_kind} General Public", _said).replace("version 3", f"version {_v}")
            TEMPLATES.setdefault(f"{_name}/{_form}", _said)
for _terms in ("", "-NonCommercial", "-ShareAlike", "-NoDerivatives", "-NonCommercial-ShareAlike", "-NonCommercial-NoDerivatives"):
    _short = _terms.replace("NonCommercial", "NC").replace("ShareAlike", "SA").replace("NoDerivatives", "ND")
    for _v, _where in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
        _long = f"This work is licensed under a Creative Commons Attribution{_terms} {_v} {_where} License"
        for _form, _said in (("long", _long), ("short", f"Licensed under CC BY{_short} {_v}")):
            if _said not in TEMPLATES.values():
                TEMPLATES[f"CC-BY{_short}-{_v}/{_form}"] = _said

_WORD = re.compile(r"\w+")

# Words that tell licenses of one family apart, short forms as the long ones.
_MARKS = {
    "affero": "affero", "lesser": "lesser", "library": "library", "noncommercial": "nc", "nc": "nc", "sharealike": "sa", "sa": "sa",
    "noderivatives": "nd", "noderivs": "nd", "nd": "nd",
}
_BEFORE_VERSION = frozenset("version v by attribution license cc".split()) | set(_MARKS)
_VERSION = re.compile(r"v?([0-9]+)$")


def marks(found: list[str]) -> frozenset[str]:
    """Versions (without .0 at the end) and words that tell licenses apart."""
    said = set()
    for i, w in enumerate(found):
        if w in _MARKS and (w != "library" or found[i + 1 : i + 2] == ["general"]):
            said.add(_MARKS[w])
        if i and found[i - 1] in _BEFORE_VERSION and (m := _VERSION.match(w)):
            second = found[i + 1] if found[i + 1 : i + 2] and found[i + 1].isdecimal() else "0"
            said.add(m[1] if second == "0" else f"{m[1]}.{second}")
    return frozenset(said)


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def winnow(hashes: list[int], window: int = WINDOW) -> list[int]:
    """Positions of the smallest hash (the last among equals) of every window; all positions of a short list."""
    if len(hashes) <= window:
        return list(range(len(hashes)))
    chosen = {
        min(range(i, i + window), key=lambda j: (hashes[j], -j)) for i in range(len(hashes) - window + 1)
    }
    return sorted(chosen)


class Index:
    """The inverted index of a set of templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [split_words(templates[n]) for n in self.names]
        self.marks = [marks(w) for w in self.words]
        plain = [tuple(w for w in found if w not in _MARKS and not _VERSION.match(w)) for found in self.words]
        family: dict[tuple[str, ...], set[str]] = defaultdict(set)
        for name, found in zip(self.names, plain, strict=True):
            family[found].add(name.split("/")[0])
        self.lenient = [len(family[p]) == 1 and len(w) >= LONG for p, w in zip(plain, self.words, strict=True)]
        self.numbers: dict[str, int] = {}
        for found in self.words:
            for w in found:
                self.numbers.setdefault(w, len(self.numbers) + 1)  # 0: a word of no template
        self.base = len(self.numbers) + 1
        self.ids = [np.array([self.numbers[w] for w in found], dtype=np.int64) for found in self.words]
        index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sizes = []
        for t, found in enumerate(self.words):
            grams = [" ".join(found[i : i + GRAM]) for i in range(len(found) - GRAM + 1)]
            chosen = winnow([xxhash.xxh64_intdigest(g) for g in grams])
            keys = self.keys(self.ids[t])
            for i in chosen:
                index[int(keys[i])].append((t, i))
            self.sizes.append(len(chosen))
        self.index = dict(index)
        self.sorted_keys = np.array(sorted(index), dtype=np.int64)

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """Word triples as numbers; triples with a foreign word stay below every fingerprint's or match none."""
        return (ids[:-2] * self.base + ids[1:-1]) * self.base + ids[2:]

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, lowest diagonal, highest diagonal) of the hits that lie together."""
        if len(ids) < GRAM:
            return
        keys = self.keys(ids)
        at = np.searchsorted(self.sorted_keys, keys)
        at[at == len(self.sorted_keys)] = 0
        diagonals: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i in np.flatnonzero(self.sorted_keys[at] == keys).tolist():
            for t, j in self.index[int(keys[i])]:
                diagonals[t].append((i - j, j))
        for t, hits in diagonals.items():
            hits.sort()
            band = self.band(t)
            start = 0
            for end in range(1, len(hits) + 1):
                if end < len(hits) and hits[end][0] - hits[end - 1][0] <= band and hits[end][0] - hits[start][0] <= 2 * band:
                    continue
                if len({j for _, j in hits[start:end]}) >= max(1, MIN_HITS * self.sizes[t]):
                    yield t, hits[start][0], hits[end - 1][0]
                start = end

    def band(self, t: int) -> int:
        """Diagonals by which an alignment may leave its hits: a fifth of the template, two at least."""
        return max(2, len(self.ids[t]) // 5)

    def align(self, ids: np.ndarray, t: int, low: int, high: int) -> tuple[int, int, int] | None:
        """Best local alignment within the band: (matched words, first word, end) in the text."""
        own, band = self.ids[t], self.band(t)
        m = len(own)
        left = max(0, low - band)
        region = ids[left : high + band + m].tolist()
        # cells: (score, matched, first); a match adds 2, anything else takes 1
        nothing = (0, 0, -1)
        before: dict[int, tuple[int, int, int]] = {}
        best, end = nothing, 0
        for i, word in enumerate(region):
            now: dict[int, tuple[int, int, int]] = {}
            # template positions whose diagonal (i + left - j) is in [low - band, high + band]
            for j in range(max(0, i + left - high - band), min(m, i + left - low + band + 1)):
                s, k, f = before.get(j - 1, nothing)
                cell = (s + 2, k + 1, i if f < 0 else f) if word == own[j] else (s - 1, k, f)
                s, k, f = before.get(j, nothing)
                cell = max(cell, (s - 1, k, f))
                s, k, f = now.get(j - 1, nothing)
                cell = max(cell, (s - 1, k, f))
                if cell[0] <= 0:
                    continue
                now[j] = cell
                if cell > best:
                    best, end = cell, i + 1
            before = now
        return (best[1], left + best[2], left + end) if best[1] else None

    def coverage(self, matched: int, first: int, end: int, t: int) -> float:
        return matched / max(len(self.ids[t]), end - first)

    def agrees(self, span: list[str], t: int) -> bool:
        """Whether the marks of a span are those of the template."""
        said = marks(span)
        return said == self.marks[t] or self.lenient[t] and said < self.marks[t]

    def scan(self, text: str) -> list[dict]:
        """Matches of a text, in order of place."""
        found = split_words(text)
        get = self.numbers.get
        ids = np.fromiter([get(w, 0) for w in found], dtype=np.int64, count=len(found))
        rows = []
        for t, low, high in self.candidates(ids):
            aligned = self.align(ids, t, low, high)
            if aligned and self.coverage(*aligned, t) >= MIN_COVERAGE and self.agrees(found[aligned[1] : aligned[2]], t):
                rows.append((aligned[0], aligned[1], aligned[2], t))
        if not rows:
            return []
        rows.sort(key=lambda r: (-r[0], -self.coverage(*r), r[1], r[3]))
        kept: list[tuple[int, int, int, int]] = []
        for r in rows:
            if not any(a <= r[1] and r[2] <= b for _, a, b, _ in kept):
                kept.append(r)
        spans = [m.span() for m in _WORD.finditer(text.lower())] if len(text.lower()) == len(text) else None
        return [
            {
                "license": self.names[t].split("/")[0], "template": self.names[t], "matched_words": k,
                "template_words": len(self.ids[t]), "coverage": self.coverage(k, a, b, t), "first_word": a, "end_word": b,
                "first_char": spans[a][0] if spans else None, "end_char": spans[b - 1][1] if spans else None,
            }
            for k, a, b, t in sorted(kept, key=lambda r: (r[1], r[3]))
        ]


@lru_cache(maxsize=4)
def index_of(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(dict(templates))


_ROW = [
    ("license", pa.string(), "string"), ("template", pa.string(), "string"), ("matched_words", pa.int64(), "long"),
    ("template_words", pa.int64(), "long"), ("coverage", pa.float64(), "double"), ("first_word", pa.int64(), "long"),
    ("end_word", pa.int64(), "long"), ("first_char", pa.int64(), "long"), ("end_char", pa.int64(), "long"),
]


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per match: ``doc_id``, license, template, matched and template words, coverage, span in words and characters.

    Character offsets are null for the rare text whose lower case has another length.
    """
    given = tuple(sorted((templates or TEMPLATES).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index_of(given)
        for batch in slices(batches):
            place, rows = [], []
            for i, text in enumerate(texts_of(batch)):
                found = own.scan(text)
                place.extend([i] * len(found))
                rows.extend(found)
            ids = batch.column(0).take(pa.array(place, pa.int64()))
            columns = [pa.array([r[n] for r in rows], kind) for n, kind, _ in _ROW]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *(n for n, _, _ in _ROW)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{n} {ddl}" for n, _, ddl in _ROW)])
    return docs.select("doc_id", "text").transform(map_arrow, run, schema)
