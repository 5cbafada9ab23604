"""License scans by patience alignment of texts with license templates.

A word that occurs once in a stretch of text and once in a template is an anchor; the longest increasing subsequence of
anchors is kept and the gaps between them are aligned in the same way, after equal words at their ends. The aligned
share of a template's words is its coverage; at ``COVERAGE`` or more the license is reported, with the words it spans.

Where to align follows from the rule: a find of n template words spans n / ``DENSITY`` words at most and begins at one of
the template's words, so every such position whose following n / ``DENSITY`` words hold enough of the template's words,
counted with repeats, is aligned with that stretch. So many of the template's words (probes) are looked up first that a
text holding none of them cannot reach the coverage; texts without probes, nearly all, end there. Repeated notices are
found each by itself.

In templates of up to ``SHORT`` words the coverage alone would mix names. With ``named``, as op1 has it, all words of
such a template that are ``MARKS`` or numbers must be aligned, each next to its neighbours in the template that are
aligned, and no other mark may stand inside the find. Nor may a negation stand inside it, or before it in the same clause:
what is "not licensed under the MIT license" isn't found.

After ``SPDX-License-Identifier:`` stands an expression, whose first identifier is found like any template. Those that
follow it by AND or OR are found too with ``expressions``, as op1 has it, each as a whole; the suffixes "only" and "or later" and known exceptions are passed
over, and the first word that continues no expression ends it.

Each text is handled whole and by itself in Arrow batches, without a shuffle. Defined results: null and empty texts
have no words and no license; overlapping finds keep the one with most aligned words (then the greater coverage, then
the name that sorts first, then the narrower, then the first); repeated rows give repeated results; columns of the input are kept unless named as an added
one; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COVERAGE = 0.8
#: Least share of aligned words among the words that a find spans.
DENSITY = 0.6

#: SPDX identifiers looked for by themselves.
IDENTIFIERS = "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 EPL-2.0 BSL-1.0 Zlib Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0".split()
#: Public license notices, by SPDX identifier and form.
TEMPLATES = {
    **{f"{x}/identifier": f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS},
    "MIT/line": "Released under the MIT License",
    "MIT/terms": "This project is licensed under the terms of the MIT license",
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0/line": "This work is licensed under the GNU General Public License, version 2",
    "CC-BY-4.0/short": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0/line": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0/notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Proprietary/line": "All rights reserved",
    "MIT/text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC/text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause/text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
        IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "BSD-3-Clause/text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
        OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense/text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the
        author or authors of this software dedicate any and all copyright interest in the software to the public domain.""",
    "Zlib/text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that
        you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
        and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from
        any source distribution.""",
    "BSL-1.0/text": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
        distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
        third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in
        the Software and this entire statement, including the above license grant, this restriction and the following
        disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
        Software, unless such copies or derivative works are solely in the form of machine-executable object code
        generated by a source language processor.""",
    "EPL-2.0/header": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "Apache-2.0/header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under
        the License.""",
    "GPL-3.0/notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "GPL-2.0/notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "AGPL-3.0/notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        Affero General Public License for more details.""",
    "LGPL-2.1/notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or
        (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        Lesser General Public License for more details.""",
    "MPL-2.0/header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
#: Words too common to look a license up by.
COMMON = frozenset("the of and to in is a or for be any this that with by on at an as it all are if can you your from not but was which".split())

#: Words that deny what follows them in a clause ("isn't" gives the words isn and t).
DENIALS = frozenset("not never nor isn aren wasn weren cannot".split())
#: Denials are looked for among so many words before a find.
REACH = 4
#: SPDX exceptions that may follow WITH.
EXCEPTIONS = "Classpath-exception-2.0 GCC-exception-3.1 LLVM-exception Autoconf-exception-3.0 Bison-exception-2.2 Bootloader-exception Font-exception-2.0 Linux-syscall-note".split()

#: Templates of up to so many words are told apart by their marks.
SHORT = 20
#: Words that tell licenses apart.
MARKS = frozenset("mit apache gnu lesser affero library gpl lgpl agpl bsd isc mpl mozilla cc creative attribution nc noncommercial nd noderivatives noderivs sa sharealike rights reserved cc0 epl eclipse bsl zlib unlicense".split())

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, sorted by their first, whose seconds increase."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
        back.append(at[p - 1] if p else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned positions of ``a`` and ``b``, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        where = {w: k for k, w in enumerate(b[j:n], j) if in_b[w] == 1}
        anchors = _increasing([(k, where[w]) for k, w in enumerate(a[i:m], i) if in_a[w] == 1 and w in where])
        if anchors:
            out += anchors
            for (x, y), (z, w) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)], strict=True):
                if x + 1 < z and y + 1 < w:
                    todo.append((x + 1, z, y + 1, w))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, coverage: float = COVERAGE, named: bool = False):
        self.name, self.words, self.coverage = name, words_of(text), coverage
        n = len(self.words)
        self.span, self.count = int(n / DENSITY + 1e-9), Counter(self.words)
        self.least = next(k for k in range(n + 1) if k >= coverage * n)
        self.named = named and n <= SHORT
        self.marks = [k for k, w in enumerate(self.words) if w in MARKS or w.isdigit()]
        # words that may be missing; the probes' occurrences in the template exceed that
        missing, count = int((1 - coverage) * n + 1e-9), self.count
        self.probes: dict[str, int] = {}
        held = 0
        for w in sorted(count, key=lambda w: (w in COMMON, -len(w), w)):
            if held > missing:
                break
            self.probes[w] = self.words.index(w)
            held += count[w]

    def starts(self, words: list[str], at: dict[str, list[int]]) -> Iterator[int]:
        """Positions of template words from which ``span`` words hold as many of the template's words as a find needs;
        ``at`` has the positions of each word. Only template words are visited."""
        places = sorted(p for w in self.count for p in at.get(w, ()))
        held: Counter[str] = Counter()
        common = k = 0
        for p in places:
            while k < len(places) and places[k] < p + self.span:
                w = words[places[k]]
                held[w] += 1
                common += held[w] <= self.count[w]
                k += 1
            if common >= self.least:
                yield p
            w = words[p]
            common -= held[w] <= self.count[w]
            held[w] -= 1

    def best(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The longest run of ``pairs`` that is dense enough, the first of such, or none if it has too few."""
        for m in range(len(pairs), self.least - 1, -1):
            for k in range(len(pairs) - m + 1):
                if m >= DENSITY * (pairs[k + m - 1][1] - pairs[k][1] + 1):
                    return pairs[k : k + m]
        return []

    def is_named(self, pairs: list[tuple[int, int]], words: list[str]) -> bool:
        """Whether all marks of the template are aligned, next to their aligned neighbours, and no other mark or denial
        stands among the words spanned."""
        aligned, own = dict(pairs), {p for _, p in pairs}
        foreign = {words[p] for p in range(pairs[0][1], pairs[-1][1]) if p not in own}
        if not aligned.keys() >= set(self.marks) or not MARKS.isdisjoint(foreign) or not DENIALS.isdisjoint(foreign):
            return False
        return all(aligned[k + d] == aligned[k] + d for k in self.marks for d in (-1, 1) if k + d in aligned)

    def finds(self, words: list[str], at: dict[str, list[int]]) -> Iterator[tuple[int, int, int, float]]:
        """(begin, end, aligned words, coverage) in a text whose words stand ``at`` these positions."""
        if not any(w in at for w in self.probes):
            return
        seen = set()
        for low in self.starts(words, at):
            pairs = self.best([(i, low + p) for i, p in align(self.words, words[low : low + self.span])])
            if pairs and not (self.named and not self.is_named(pairs, words)):
                find = pairs[0][1], pairs[-1][1] + 1, len(pairs), len(pairs) / len(self.words)
                if find not in seen:
                    seen.add(find)
                    yield find


_HEAD = words_of("SPDX-License-Identifier")
#: Words of the parts of an expression, longest first, so that the longest that fits is taken.
_IDENTIFIERS, _PASSED = (
    sorted(((words_of(x), x) for x in known), key=lambda x: (-len(x[0]), x[1]))
    for known in (IDENTIFIERS, ["only", "or later", *(f"with {x}" for x in EXCEPTIONS)])
)


def _next(parts: list[tuple[list[str], str]], words: list[str], at: int) -> tuple[list[str], str] | None:
    return next((x for x in parts if words[at : at + len(x[0])] == x[0]), None)


def further_identifiers(words: list[str], heads: list[int]) -> Iterator[tuple[str, int, int]]:
    """(identifier, begin, end) of the second and later identifiers of each SPDX expression; ``heads`` are the places of the
    word that begins its mark."""
    for p in heads:
        if words[p : p + len(_HEAD)] != _HEAD:
            continue
        p, first = p + len(_HEAD), True
        while found := _next(_IDENTIFIERS, words, p):
            if not first:
                yield found[1], p, p + len(found[0])
            p, first = p + len(found[0]), False
            while passed := _next(_PASSED, words, p):
                p += len(passed[0])
            if words[p : p + 1] not in (["and"], ["or"]):
                break
            p += 1


def denied(lowered: str, spans: list[tuple[int, int]], begin: int, passed: set[str]) -> bool:
    """Whether a denial stands among the ``REACH`` words before the word position ``begin``, with only blanks and words of
    ``passed`` between. The end of a line or a clause separates."""
    for k in range(begin - 1, max(begin - 1 - REACH, -1), -1):
        (a, b), word = (spans[k][1], spans[k + 1][0]), lowered[slice(*spans[k])]
        if lowered[a:b].strip(" \t'\u2019"):
            return False
        if word in DENIALS or word not in passed:
            return word in DENIALS
    return False


class Scanner:
    def __init__(self, templates: dict[str, str] | None = None, coverage: float = COVERAGE, named: bool = False, expressions: bool = False):
        self.expressions = expressions
        self.templates = [Template(k, v, coverage, named) for k, v in sorted((templates or TEMPLATES).items())]
        self.probes = frozenset(w for t in self.templates for w in t.probes)
        self.words = frozenset(w for t in self.templates for w in t.words)

    def scan(self, text: str) -> tuple[int, list[tuple[str, int, int, float]]]:
        """Number of words and (license, first word, word after, coverage) by position."""
        words = words_of(text)
        if self.probes.isdisjoint(words):
            return len(words), []
        at: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.words:
                at.setdefault(w, []).append(i)
        finds = [(t, b, e, n, c) for t in self.templates for b, e, n, c in t.finds(words, at)]
        if any(t.named and not DENIALS.isdisjoint(words[max(b - REACH, 0) : b]) for t, b, *_ in finds):
            lowered = text.lower()
            spans = [m.span() for m in _WORD.finditer(lowered)]
            finds = [f for f in finds if not (f[0].named and denied(lowered, spans, f[1], {*f[0].words, "t", "yet"}))]
        found = [(-n, -c, t.name, e - b, b, e) for t, b, e, n, c in finds]
        if self.expressions:
            found += [(b - e, -1.0, f"{x}/identifier", e - b, b, e) for x, b, e in further_identifiers(words, at.get(_HEAD[0], []))]
        found.sort()
        taken: list[tuple[str, int, int, float]] = []
        free = bytearray(len(words))
        for _, c, name, _, b, e in found:
            if not any(free[b:e]):
                free[b:e] = b"\1" * (e - b)
                taken.append((name, b, e, -c))
        return len(words), sorted(taken, key=lambda x: x[1])


FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("begin", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("coverage", T.DoubleType()),
        ]
    )
)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, named: bool = False, expressions: bool = False) -> DataFrame:
    """``docs`` with n_words and licenses (array of struct license, begin, end, coverage; words, end exclusive)."""
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "licenses")]
    d = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_license_text"))
    schema = T.StructType([*d.schema.fields[:-1], T.StructField("n_words", T.LongType()), T.StructField("licenses", FOUND)])
    kind = pa.list_(pa.struct([("license", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage, named, expressions)
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            found = [[dict(zip(("license", "begin", "end", "coverage"), f, strict=True)) for f in r[1]] for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r[0] for r in rows], pa.int64()), pa.array(found, kind)], names=schema.names)

    return d.mapInArrow(run, schema)
