"""License texts found by patience alignment against templates.

A template can only be covered if enough of its distinct words stand in the text. Each occurrence of one of
its rarest words there marks a window, as wide as the template and half as much again; as many of the
rarest words are tried as a covered template cannot all lack. In a window, words that occur once in both
sides are anchors; their longest increasing subsequence is kept, and the gaps between anchors are aligned
in the same way, down to equal runs at their ends. The share of aligned template words is its coverage.

Templates are whole notices, and whole texts of the short licenses. Short templates may lack one word, longer
ones are covered to ``COVERAGE``; the phrases that tell licenses apart (``REQUIRED``) must stand unbroken. Words are runs of letters and digits,
compared in lower case. Texts are read whole, however often a license stands in them.

Defined cases: null and empty texts have no licenses; of windows that overlap, of one template or several,
the one with most aligned words, then the best covered, then the first, counts; repeated rows get the same
result each; other columns are carried; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import private, text_batches

COVERAGE, SHORT = 0.8, 12
BATCH_BYTES = 8 << 20

# Whole notices, and whole texts of the short licenses, as they are worded.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(thing: str, kind: str, version: str) -> str:
    """The notice that the GNU licenses give; that of LGPL-2.1 speaks of a library."""
    return (
        f"This {thing} is free software{';' if version < '3' else ':'} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version. "
        f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details. "
        f"You should have received a copy of the GNU {kind}General Public License along with this {thing}"
    )


def _cc(words: str) -> str:
    return f"This work is licensed under a Creative Commons {words} 4.0 International License."


TEMPLATES = {
    "AGPL-3.0-notice": _gnu("program", "Affero ", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": _BSD + _BSD_END,
    "BSD-3-Clause": _BSD + _BSD_NAMES + _BSD_END,
    "CC-BY-4.0": _cc("Attribution"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": _cc("Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _cc("Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _cc("Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _cc("Attribution-ShareAlike"),
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GPL-2.0-notice": _gnu("program", "", "2"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": _gnu("program", "", "3"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-2.1-notice": _gnu("library", "Lesser ", "2.1"),
    "LGPL-3.0-notice": _gnu("program", "Lesser ", "3"),
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org",
}

#: What tells a license from its kin: each of these phrases must stand unbroken at one of its places in the template.
REQUIRED = {
    "AGPL-3.0-notice": ("GNU Affero General Public License", "version 3 of"),
    "Apache-2.0": ("Apache", "2.0"),
    "Apache-2.0-notice": ("Apache License", "2.0"),
    "BSD-3-Clause": ("endorse or promote",),
    "CC-BY-4.0": ("Commons Attribution 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC-BY-NC-4.0-notice": ("Commons Attribution-NonCommercial 4.0",),
    "CC-BY-NC-ND-4.0": ("Commons Attribution-NonCommercial-NoDerivatives 4.0",),
    "CC-BY-NC-SA-4.0": ("Commons Attribution-NonCommercial-ShareAlike 4.0",),
    "CC-BY-ND-4.0": ("Commons Attribution-NoDerivatives 4.0",),
    "CC-BY-SA-4.0": ("Commons Attribution-ShareAlike 4.0",),
    "CC0-1.0": ("CC0",),
    "EPL-2.0": ("Eclipse Public License", "2.0"),
    "GPL-2.0-notice": ("GNU General Public License", "version 2 of"),
    "GPL-3.0": ("GNU General Public License", "version 3"),
    "GPL-3.0-notice": ("GNU General Public License", "version 3 of"),
    "LGPL-2.1-notice": ("GNU Lesser General Public License", "version 2.1 of"),
    "LGPL-3.0-notice": ("GNU Lesser General Public License", "version 3 of"),
    "MIT": ("MIT",),
    "MPL-2.0": ("Mozilla Public License", "2.0"),
}

_WORD = re.compile(r"[^\W_]+")


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of equal words, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once = [{w for w, n in Counter(x).items() if n == 1} for x in (a[a0:a1], b[b0:b1])]
        both = once[0] & once[1]
        where = {b[j]: j for j in range(b0, b1) if b[j] in both}
        anchors = _increasing([(i, where[a[i]]) for i in range(a0, a1) if a[i] in both])
        if anchors:
            out += anchors
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence of pairs (sorted by the first) whose second members increase."""
    tops: list[int] = []
    last: list[int] = []  # index of the pair on top of each pile
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(last[pile - 1] if pile else -1)
        tops[pile : pile + 1], last[pile : pile + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _disjoint(hits: Iterable[tuple]) -> list[tuple]:
    """The hits (first, last word, ...) that meet none taken before them, by first word."""
    firsts, taken = [], []
    for hit in hits:
        at = bisect_right(firsts, hit[1])  # taken ones are disjoint: only the last that starts by here can meet it
        if not at or taken[at - 1][1] < hit[0]:
            firsts.insert(at, hit[0])
            taken.insert(at, hit)
    return taken


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE, required: dict[str, tuple[str, ...]] = REQUIRED):
        self.templates = []
        for name in sorted(templates):
            t = [m[0].lower() for m in _WORD.finditer(templates[name])]
            if t:
                need = max(1, len(t) - 1) if len(t) <= SHORT else -(-len(t) * coverage // 1)
                phrases = [[m[0].lower() for m in _WORD.finditer(p)] for p in required.get(name, ())]
                places = [[range(k, k + len(p)) for k in range(len(t)) if t[k : k + len(p)] == p] for p in phrases]
                self.templates.append((name, t, set(t), int(need), [p for p in places if p]))

    def scan(self, text: str | None) -> list[tuple[int, str, int, float]]:
        """(start, name, end, coverage) of all licenses, by start; places count code points."""
        found = []
        words = [w.lower() for w in _WORD.findall(text or "")]
        have = set(words)
        spans = counts = None
        for name, t, distinct, need, phrases in self.templates:
            lacking = len(t) - need  # so many words may be missing
            if len(distinct - have) > lacking:
                continue
            if spans is None:
                spans, counts = [m.span() for m in _WORD.finditer(text)], Counter(words)
            found += [(-n, -n / len(t), i, name, j) for i, j, n in self._places(t, need, phrases, words, counts)]
        taken = _disjoint((i, j, name, -share) for _, share, i, name, j in sorted(found))
        return sorted((spans[i][0], name, spans[j][1], share) for i, j, name, share in taken)

    def _places(self, t, need, phrases, words, counts):
        rare = sorted((w for w in set(t) if counts[w]), key=lambda w: (counts[w], w))[: len(t) - need + 1]
        first = {w: t.index(w) for w in rare}
        slack = len(t) // 2 + 2
        starts = sorted({p - first[w] for p, w in enumerate(words) if w in first})
        best = []
        for s in starts:
            for wide in (0, slack):  # the tight window first: next to a second copy no word occurs once
                low = max(0, s - wide)
                pairs = patience(t, words[low : max(0, s) + len(t) + wide])
                at = dict(pairs)
                if len(pairs) >= need and all(any(all(k in at and at[k] - at.get(p[0], -1) == k - p[0] for k in p) for p in places) for places in phrases):
                    best.append((-len(pairs), low + pairs[0][1], low + pairs[-1][1]))
                if len(pairs) == len(t):
                    break
        return _disjoint((i, j, -n) for n, i, j in sorted(best))


def license_scan(df: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text", coverage: float = COVERAGE, drop_text: bool = False) -> DataFrame:
    """``df`` with licenses added: an array of start, name, upto and coverage, by start."""
    (row,) = private(df, "_row")
    kept = [c for c in df.columns if not (drop_text and c == text) and c.lower() != "licenses"]
    rows = df.select(F.struct(*kept).alias(row), F.col(text).cast("string").alias("_text"))
    hit = pa.struct([("start", pa.int64()), ("name", pa.string()), ("upto", pa.int64()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for batch in text_batches(batches, 1, BATCH_BYTES):
            found = [[dict(zip(("start", "name", "upto", "coverage"), x, strict=True)) for x in scanner.scan(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(hit))], names=[row, "licenses"])

    kind = "array<struct<start:bigint,name:string,upto:bigint,coverage:double>>"
    return rows.mapInArrow(run, f"{row} {rows.schema[row].dataType.simpleString()}, licenses {kind}").select(f"{row}.*", "licenses")
