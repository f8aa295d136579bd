"""Licence scan: normalised text against licence templates by Dice coefficient over word bigrams.

A unit of text (the whole document, a paragraph, a line, or sentences in a row within a paragraph, however
its lines are broken) and a template are sets of word pairs. Twice
the shared pairs over the sum of both sizes must reach the threshold ``t``. That needs a unit of
``t / (2 - t)`` to ``(2 - t) / t`` times the template's size, so most pairs are settled by size alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right, insort
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from seriesloom.llm.common import batches, ship

ship(__name__)

# Notices and short licence texts as their publishers give them. Paragraphs of a
# template are templates too, since a document may hold them apart.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    ("all-rights-reserved", "All rights reserved."),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]
THRESHOLD = 0.9
BATCH_BYTES = 1 << 22
# Capitals become small letters; every other ASCII character but digits, letters and line feeds a space.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b == 10 or 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
GAP = re.compile(rb"\n(?:[ ]*\n)+")
WORD, FILLED, BREAK = re.compile(rb"\S+"), re.compile(rb"\S"), re.compile(rb"\n")
STOP = re.compile(rb"[.!?][\"')\]]*(?=\s)")


def pairs(unit: bytes) -> set[tuple[bytes, bytes]]:
    """The distinct word bigrams of normalised text."""
    words = unit.split()
    return set(zip(words, words[1:]))


def prepared(templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, frozenset]]:
    """(size, licence, bigrams) of every template and template paragraph, by size."""
    units = []
    for name, text in templates:
        plain = text.encode().translate(PLAIN)
        found = {frozenset(pairs(p)) for p in [plain, *GAP.split(plain)]}
        units += [(len(p), name, p) for p in found if len(p) > 1]
    return sorted(units, key=lambda u: (u[0], u[1], sorted(u[2])))


def paragraphs(plain: bytes) -> list[tuple[int, int, int]]:
    """(number of the first line, first and last+1 byte) of every paragraph."""
    found, at, line = [], 0, 0
    for m in GAP.finditer(plain):
        found.append((line, at, m.start()))
        line += plain.count(b"\n", at, m.end())
        at = m.end()
    return [*found, (line, at, len(plain))]


def units(plain: bytes, parts: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(number of the first line, first and last+1 byte) of the document, its paragraphs and its lines."""
    yield 0, 0, len(plain)
    if b"\n" not in plain:
        return
    if len(parts) > 1:
        yield from parts
    at = 0
    for line, text in enumerate(plain.split(b"\n")):
        yield line, at, at + len(text)
        at += len(text) + 1


def sentence_runs(raw: bytes, plain: bytes, part: tuple[int, int, int], template: frozenset, threshold: float) -> Iterator[tuple[float, int, int, int]]:
    """(coefficient, line, first and last+1 byte) of the sentences in a row of a paragraph that match.

    Of runs from one sentence with the same bigrams the shortest; the others overlap it and score alike. From
    the last sentence to the first, the bigrams are kept in order of their next place, so a start looks at each
    distinct bigram of its longest run once, however often sentences repeat.
    """
    line, start, end = part
    cuts = [start, *(m.end() for m in STOP.finditer(raw, start, end)), end]
    longest = len(template) * (2 - threshold) / threshold
    found = [(m.start(), m[0]) for m in WORD.finditer(plain, start, end)]
    of = [bisect_right(cuts, at) - 1 for at, _ in found]
    breaks = [m.start() for m in BREAK.finditer(plain, start, end)]
    following: OrderedDict[tuple[bytes, bytes], int] = OrderedDict()
    p = len(found) - 1
    for i in range(len(cuts) - 2, -1, -1):
        while p >= 0 and of[p] == i:
            if p + 1 < len(found):
                pair = found[p][1], found[p + 1][1]
                following[pair] = of[p + 1]
                following.move_to_end(pair, last=False)
            p -= 1
        ends: list[tuple[int, int, int]] = []
        have = shared = 0
        for pair, sentence in following.items():
            have += 1
            if have > longest:
                if ends and ends[-1][0] == sentence:
                    ends.pop()
                break
            shared += pair in template
            if ends and ends[-1][0] == sentence:
                ends.pop()
            ends.append((sentence, have, shared))
        for sentence, n, common in ends:
            if 2 * common >= threshold * (n + len(template)) - 1e-9:
                at = FILLED.search(raw, cuts[i]).start()
                yield 2 * common / (n + len(template)), line + bisect_left(breaks, at), at, cuts[sentence + 1]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans that do not touch, over the same bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def scan_text(text: str, templates: list, sizes: list[int], threshold: float) -> dict[str, tuple[float, int, set[int]]]:
    """Per licence the best coefficient, its first line, and the first lines of all matching units.

    Sentences count where no larger unit of that licence lies.
    """
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    # A unit's words outnumber its bigrams by repeats only, so few words rule a unit out, many do not;
    # but bytes bound the bigrams of short units from above.
    least = math.ceil(sizes[0] * low - 1e-9)
    longest = sizes[-1] * high
    found: dict[str, tuple[float, int, set[int]]] = {}
    covered: dict[str, list[tuple[int, int]]] = {}

    def take(name: str, dice: float, line: int, start: int, end: int) -> None:
        best, at, lines = found.get(name, (0.0, 0, set()))
        lines.add(line)
        found[name] = (dice, line, lines) if (-dice, line) < (-best, at) else (best, at, lines)
        covered.setdefault(name, []).append((start, end))

    raw = text.encode()
    plain = raw.translate(PLAIN)
    parts = paragraphs(plain)
    for line, start, end in units(plain, parts):
        if end - start < 2 * least:
            continue
        have = pairs(plain[start:end])
        n = len(have)
        if n < least or n > longest:
            continue
        first = bisect_left(sizes, math.floor(n * low + 1e-9))
        for size, name, template in templates[first : bisect_right(sizes, math.ceil(n * high - 1e-9))]:
            shared = len(have & template)
            if 2 * shared >= threshold * (n + size) - 1e-9:
                take(name, 2 * shared / (n + size), line, start, end)
    whole = pairs(plain)
    near = [t for t in templates if len(whole & t[2]) >= t[0] * low - 1e-9]
    for part in parts if near else ():
        have = pairs(plain[part[1] : part[2]])
        runs = [(-dice, line, a, b, name) for size, name, t in near if len(have & t) >= size * low - 1e-9 for dice, line, a, b in sentence_runs(raw, plain, part, t, threshold)]
        held = {name: merged(covered.get(name, [])) for name in {r[4] for r in runs}}
        for dice, line, a, b, name in sorted(runs):
            spans = held[name]
            before = bisect_left(spans, (b, b)) - 1
            if before < 0 or spans[before][1] <= a:
                take(name, -dice, line, a, b)
                insort(spans, (a, b))
    return found


def license_scan(
    docs: DataFrame, key: str, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per input row and licence found: ``dice``, the first line of the best unit, and units.

    ``n_places`` counts distinct first lines of matching units, so a notice on a line of its own counts
    once. The line is the smallest among equally good units. Null and empty texts and texts without a
    match give no row; texts of any length are read whole, in time that grows with their length; repeated rows give a row each; a null key is kept; other columns are left out.
    ``templates`` travel with the task and are meant to be some thousands at most.
    """
    ready = prepared(templates)
    sizes = [u[0] for u in ready]

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            table = pa.table([batch.column(0), batch.column(1)], names=["key", "text"])
            for a, b in batches(table, BATCH_BYTES, "text"):
                some = table.slice(a, b - a)
                of, names, scores, lines, places = [], [], [], [], []
                for i, value in enumerate(some.column("text").to_pylist()):
                    for name, (dice, line, seen) in sorted(scan_text(value, ready, sizes, threshold).items()) if value else ():
                        of.append(i)
                        names.append(name)
                        scores.append(dice)
                        lines.append(line)
                        places.append(len(seen))
                keys = some.column("key").combine_chunks().take(pa.array(of, pa.int64()))
                columns = [keys, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lines, pa.int64()), pa.array(places, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "license", "dice", "first_line", "n_places"])

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(key, text) if ready else docs.select(key, text).limit(0)
    return source.mapInArrow(run, f"`{key}` {kind}, license string, dice double, first_line long, n_places long")
