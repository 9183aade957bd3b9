"""License scans by patience alignment.

Texts and templates are sequences of lower-cased words (letters, digits,
non-ASCII).  Places worth aligning are windows of ``1.25`` template lengths in
which enough words belong to the template's vocabulary at all: a bound that no
alignment can exceed.  There the text is aligned with the template: words that
occur once in both are anchors, their longest increasing subsequence is kept,
and the gaps between anchors are aligned the same way; a gap without anchor is
settled by the longest common subsequence.  Coverage is the share of template
words matched.  Templates of 30 words or more need ``threshold``, shorter ones
every word but those of ``FILLERS``, since one word tells one short notice from
another.  The words of ``SAME`` count as equal.  What tells a template from its
near-equals (``DECIDING``: kind and version) must stand in the text word by
word, at half of its places in the template or more.  A short notice with a word of
``NEGATIONS`` in it or right before it is no match.

Where matches overlap, the one with more matched words stays, then the one with
the higher coverage.

Defined results: null and empty texts have no match; several notices in one
text give a row each; repeated rows are scanned row by row; extra columns are
not read.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T

SHORT = 30
# Notices and license texts as their owners publish them.
TEMPLATES = {
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
               "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
               "GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
           "conditions: The above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
           "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
           "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
           "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
           "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}


_WARRANTY = ("is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
             "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the")
for _name, _thing, _kind, _version in (
        ("GPL-2.0", "program", "GNU General Public License", "2"), ("LGPL-2.0", "library", "GNU Library General Public License", "2"),
        ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "library", "GNU Lesser General Public License", "3"),
        ("AGPL-3.0", "program", "GNU Affero General Public License", "3")):
    _head = f"This {_thing} is free software: you can redistribute it and/or modify it under the terms of the {_kind} "
    TEMPLATES[_name] = (f"{_head}as published by the Free Software Foundation, either version {_version} of the License, or (at your "
                        f"option) any later version. This {_thing} {_WARRANTY} {_kind} for more details.")
    TEMPLATES[f"{_name}-only"] = f"{_head}version {_version} as published by the Free Software Foundation. This {_thing} {_WARRANTY} {_kind} for more details."
TEMPLATES["GPL-3.0-only"] = TEMPLATES["GPL-2.0-only"].replace("version 2", "version 3")
_BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
        "This product includes software developed by the organization.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."]
TEMPLATES |= {
    "BSD-2-Clause": f"{_BSD[0]} {_BSD[3]}",
    "BSD-3-Clause": f"{_BSD[0]} {_BSD[2]} {_BSD[3]}",
    "BSD-4-Clause": " ".join(_BSD),
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                 "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                 "purpose, commercial or non-commercial, and by any means.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
               "which is available at https://www.eclipse.org/legal/epl-2.0/",
    "EPL-1.0": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse "
               "Public License v1.0 which accompanies this distribution, and is available at "
               "http://www.eclipse.org/legal/epl-v10.html",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
            "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
            "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
            "following restrictions",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "GPL-2.0-notice": "Licensed under the GNU General Public License, version 2.",
    "LGPL-2.1-notice": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-notice": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "Licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "EPL-2.0-notice": "Licensed under the Eclipse Public License, version 2.0.",
    "BSD-2-Clause-notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
    "ISC-notice": "Licensed under the ISC License.",
    "Unlicense-notice": "Released under the Unlicense.",
    "CC0-1.0-notice": "Licensed under CC0 1.0.",
}
for _short, _long in (("", ""), ("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives"), ("NC-SA", "NonCommercial-ShareAlike"),
                      ("NC-ND", "NonCommercial-NoDerivatives")):
    _name = "-".join(filter(None, ("CC-BY", _short, "4.0")))
    TEMPLATES[_name] = f"This work is licensed under a Creative Commons {'-'.join(filter(None, ('Attribution', _long)))} 4.0 International License."
    TEMPLATES[f"{_name}-notice"] = f"Licensed under CC {'-'.join(filter(None, ('BY', _short)))} 4.0."
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
FILLERS = ("a", "is", "the", "this", "work", "version", "v")
NEGATIONS = ("not", "no", "never", "isn", "nor", "cannot")
SAME = {"released": "licensed", "distributed": "licensed", "licence": "license", "v1": "1", "v2": "2", "v3": "3"}
# Identifier lines: all words, one after another.
IDENTIFIERS = ("MIT", "MIT-0", "Apache-2.0", "ISC", "Zlib", "Unlicense", "BSL-1.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
               "EPL-1.0", "EPL-2.0", "MPL-1.1", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
               *(f"{x}{end}" for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("", "-only", "-or-later")))
_GNU = {"GPL": "gnu general public license", "LGPL": "gnu lesser general public license", "AGPL": "gnu affero general public license"}
DECIDING = {
    **{x: (_GNU[x.split("-")[0]], f"version {v} of") for x, v in (
        ("GPL-2.0", "2"), ("GPL-3.0", "3"), ("LGPL-2.1", "2.1"), ("LGPL-3.0", "3"), ("AGPL-3.0", "3"))},
    **{f"{x}-only": (f"{_GNU[x.split('-')[0]]} version {v} as",) for x, v in (
        ("GPL-2.0", "2"), ("GPL-3.0", "3"), ("LGPL-2.1", "2.1"), ("LGPL-3.0", "3"), ("AGPL-3.0", "3"))},
    **{f"{x}-notice": (_GNU[x.split("-")[0]], f"version {v}") for x, v in (
        ("GPL-2.0", "2"), ("GPL-3.0", "3"), ("LGPL-2.1", "2.1"), ("LGPL-3.0", "3"), ("AGPL-3.0", "3"))},
    "LGPL-2.0": ("gnu library general public license", "version 2 of"),
    "LGPL-2.0-only": ("gnu library general public license version 2 as",),
    "GPL-1.0-text": (_GNU["GPL"], "version 1 february 1989"), "GPL-2.0-text": (_GNU["GPL"], "version 2 june 1991"),
    "GPL-3.0-text": (_GNU["GPL"], "version 3 29 june 2007"), "LGPL-2.0-text": ("gnu library general public license", "version 2 june 1991"),
    "LGPL-2.1-text": (_GNU["LGPL"], "version 2.1 february 1999"), "LGPL-3.0-text": (_GNU["LGPL"], "version 3 29 june 2007"),
    "AGPL-3.0-text": (_GNU["AGPL"], "version 3 19 november 2007"),
    "MPL-1.1-text": ("version 1.1",), "MPL-2.0-text": ("version 2.0",), "MPL-2.0": ("mozilla public license v 2.0",),
    "BSD-3-Clause": ("endorse or promote products",), "BSD-4-Clause": ("advertising materials mentioning", "endorse or promote products"),
    "EPL-1.0": ("eclipse public license v1.0",), "EPL-2.0": ("eclipse public license 2.0",),
    "MIT-notice": ("mit license",), "ISC-notice": ("isc license",), "Apache-2.0-notice": ("apache license", "2.0"),
    "MPL-2.0-notice": ("mozilla public license", "2.0"), "EPL-2.0-notice": ("eclipse public license", "2.0"),
    "BSL-1.0-notice": ("boost software license", "1.0"), "CC0-1.0-notice": ("cc0 1.0",),
    "BSD-2-Clause-notice": ("bsd 2-clause license",), "BSD-3-Clause-notice": ("bsd 3-clause license",),
    **{x: (re.search(r"Attribution.* 4\.0|CC BY.* 4\.0", TEMPLATES[x])[0],) for x in TEMPLATES if x.startswith("CC-BY")},
}
TEMPLATES |= {f"{x}-identifier": f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS}
DECIDING |= {f"{x}-identifier": (f"SPDX-License-Identifier: {x}",) for x in IDENTIFIERS}


def all_templates() -> dict[str, str]:
    """``TEMPLATES`` and the full texts of ``TEXTS``; read by the driver, sent with the task.

    The AGPL's text is made from that of GPL-3.0, which it follows but for the
    name, the date and a few paragraphs.
    """
    full = {}
    for name in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, name), encoding="utf-8") as f:
            kind = name.removesuffix(".txt")
            kind += ".0" if re.search(r"GPL-\d$", kind) else ""
            full[f"{kind}-text"] = f.read()
    agpl = re.sub(r"(?i)gnu\s+general\s+public\s+license", "GNU Affero General Public License", full["GPL-3.0-text"])
    full["AGPL-3.0-text"] = agpl.replace("29 June 2007", "19 November 2007", 1)
    return TEMPLATES | full


def _common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    other = np.array(b)
    for i in range(len(a) - 1, -1, -1):
        hit = best[i + 1, 1:] + 1
        best[i, :-1] = np.maximum(best[i + 1, :-1], np.where(other == a[i], hit, 0))
        best[i] = np.maximum.accumulate(best[i, ::-1])[::-1]
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j] and best[i, j] == best[i + 1, j + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence with rising second part (pairs rise in the first)."""
    tops, at, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(j)
            at.append(n)
        else:
            tops[k], at[k] = j, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def patience_align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched index pairs of two word sequences, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        ca, cb = Counter(a[i0:i1]), Counter(b[j0:j1])
        place = {b[j]: j for j in range(j0, j1) if cb[b[j]] == 1}
        anchors = _increasing([(i, place[a[i]]) for i in range(i0, i1) if ca[a[i]] == 1 and a[i] in place])
        if not anchors:
            if ca.keys() & cb.keys():
                out += [(i0 + i, j0 + j) for i, j in _common_subsequence(a[i0:i1], b[j0:j1])]
            continue
        out += anchors
        edges = [(i0 - 1, j0 - 1), *anchors, (i1, j1)]
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
    return sorted(out)


def _hashes(text: str) -> np.ndarray:
    buf = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = T.find_words(buf, np.array([0, len(buf)]), T.IS_ALNUM)
    return _same(T.hash_words(buf, s, e))


def _same(w: np.ndarray) -> np.ndarray:
    for a, b in _SAME:
        w[w == a] = b
    return w


_SAME: list = []
_SAME = [(_hashes(a)[0], _hashes(b)[0]) for a, b in SAME.items()]


class Scanner:
    """Templates as word hashes, and the search in one block of texts."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.names = sorted(templates)
        self.words = [_hashes(templates[name]) for name in self.names]
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)
        self.member = [np.append(np.isin(self.vocabulary, w), False) for w in self.words]
        fillers = np.array([_hashes(x)[0] for x in FILLERS])
        core = [~np.isin(w, fillers) if len(w) < SHORT else np.ones(len(w), bool) for w in self.words]
        self.core = [np.append(np.isin(self.vocabulary, w[c]), False) for w, c in zip(self.words, core)]
        self.counts = [np.append(np.bincount(np.searchsorted(self.vocabulary, w[c]), minlength=len(self.vocabulary)), 0)
                       for w, c in zip(self.words, core)]
        self.need = [int(c.sum()) if len(c) < SHORT else int(np.ceil(threshold * len(c))) for c in core]
        self.must = [set(np.flatnonzero(c).tolist()) if len(c) < SHORT else set() for c in core]
        self.short = [len(w) < SHORT for w in self.words]
        self.negations = np.array([_hashes(x)[0] for x in NEGATIONS])
        self.deciding = [[self._places(w, _hashes(x)) for x in DECIDING.get(name, ())] for name, w in zip(self.names, self.words)]

    @staticmethod
    def _places(words: np.ndarray, phrase: np.ndarray) -> tuple[list[int], int]:
        n = len(phrase)
        return [j for j in range(len(words) - n + 1) if (words[j:j + n] == phrase).all()], n

    def _decided(self, t: int, pairs: list[tuple[int, int]]) -> bool:
        """The words that tell template ``t`` from its near-equals stand in the text one after another."""
        place = {j: i for i, j in pairs}
        if not self.must[t] <= place.keys():
            return False
        for at, n in self.deciding[t]:
            whole = sum(all(place.get(j + x, -n) == place.get(j, -2 * n) + x for x in range(n)) for j in at)
            if 2 * whole < len(at):
                return False
        return True

    def _negated(self, t: int, w: np.ndarray, rows: np.ndarray, a: int, b: int) -> bool:
        """A short notice with a negation in it or right before it."""
        if not self.short[t]:
            return False
        before = a - 1 if a > 0 and rows[a - 1] == rows[a] else a
        return bool(np.isin(w[before:b + 1], self.negations).any())

    def scan(self, buf, off):
        """Yield ``(row, name, matched, template words, first byte, end byte)``."""
        starts, ends, rows = T.find_words(buf, off, T.IS_ALNUM)
        if not len(starts) or not len(self.vocabulary):
            return
        w = _same(T.hash_words(buf, starts, ends))
        code = np.searchsorted(self.vocabulary, w)
        code[code == len(self.vocabulary)] = 0
        code[self.vocabulary[code] != w] = len(self.vocabulary)
        row_end = np.searchsorted(rows, rows, "right") if len(rows) < 2 else np.repeat(
            np.append(np.flatnonzero(rows[1:] != rows[:-1]) + 1, len(rows)),
            np.diff(np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1, [len(rows)]])))
        found: dict[int, list] = {}
        for t, name in enumerate(self.names):
            core = self.core[t][code]
            if core.sum() < self.need[t]:
                continue
            hit = self.member[t][code]
            width = int(np.ceil(1.25 * len(self.words[t]))) + 1
            sums = np.concatenate([[0], np.cumsum(core)])
            at = np.flatnonzero(hit)  # a match begins with a word of the template
            stop = np.minimum(at + width, row_end[at])
            at = at[sums[stop] - sums[at] >= self.need[t]]
            done, template = -1, self.words[t].tolist()
            for i in at.tolist():
                if i < done:
                    continue
                stop = min(i + width, int(row_end[i]))
                # words shared at most, repeats counted; a shift by n words can add n
                lack = self.need[t] - int(np.minimum(np.bincount(code[i:stop], minlength=len(self.vocabulary) + 1), self.counts[t]).sum())
                if lack > 0:
                    done = i + lack
                    continue
                pairs = patience_align(w[i:stop].tolist(), template)
                if len(pairs) >= self.need[t] and self._decided(t, pairs):
                    a, b = i + pairs[0][0], i + pairs[-1][0]
                    if not self._negated(t, w, rows, a, b):
                        found.setdefault(int(rows[i]), []).append((len(pairs), name, len(template), a, b))
                    done = b + 1
        for row in sorted(found):
            kept = []
            for m in sorted(found[row], key=lambda x: (-x[0], x[2], x[1], x[3])):
                if all(m[4] < k[3] or m[3] > k[4] for k in kept):
                    kept.append(m)
            for n, name, size, a, b in sorted(kept, key=lambda x: x[3]):
                yield row, name, n, size, int(starts[a]), int(ends[b])


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """Rows ``doc_id, license, coverage, n_matched, n_template, start, end`` (characters, end exclusive)."""
    templates = all_templates() if templates is None else templates

    def run(batches):
        scanner = Scanner(templates, threshold)
        for batch in batches:
            ids, out, taken = batch.column("doc_id"), [], []
            for lo, buf, off in T.text_blocks(batch.column("text")):
                for row, name, n, size, a, b in scanner.scan(buf, off):
                    chars = lambda x, y: int(((buf[x:y] & 0xC0) != 0x80).sum())
                    start = chars(off[row], a)
                    taken.append(lo + row)
                    out.append((name, n / size, n, size, start, start + chars(a, b)))
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(taken, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             ["doc_id", "license", "coverage", "n_matched", "n_template", "start", "end"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, license string, coverage double, n_matched int, n_template int, start int, end int")
