"""License scan by patience alignment of texts with license templates.

Words that occur once in both the text and a template are anchors; the longest increasing subsequence of
them is kept and the gaps between are aligned alike. The share of the template's words that is aligned is
its coverage. Only stretches of a text that hold enough of a template's words are aligned: a stretch of
twice the template's length that holds fewer than the coverage asks for can't reach it.

A text is gone through once for each template. Where its words come close to a template without being one, every
such word may begin an alignment with a window of twice the template, so the work is bounded by the words of the
text times the length of the template, and a worker holds one text at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.patience import align
from basketry.llm.tables import columns, map_batches

COVERAGE = 0.8
#: An aligned stretch may be so many times as long as the template.
STRETCH = 2

# Whole short licenses, and customary wordings of notices of long ones.
_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""
_BSD_START = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.
"""
_UNLICENSE = """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity
of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
        _MIT,
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        _BSD_START + _BSD_NAMES + _BSD_END,
    ],
    "BSD-2-Clause": [_BSD_START + _BSD_END],
    "ISC": [_ISC],
    "Zlib": [_ZLIB],
    "Unlicense": [_UNLICENSE],
    "LGPL-3.0": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ],
    "all-rights-reserved": ["All rights reserved."],
}
_WORD = re.compile(r"[^\W_]+")


def word_list(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    """Templates as numbers of words, ready to be aligned with texts."""

    def __init__(self, templates: dict[str, list[str]], coverage: float):
        self.coverage = coverage
        self.number: dict[str, int] = {}
        self.templates = []
        for license_id, wordings in sorted(templates.items()):
            for i, wording in enumerate(wordings):
                ids = [self.number.setdefault(w, len(self.number)) for w in word_list(wording)]
                least = int(np.ceil(coverage * len(ids) - 1e-9))
                self.templates.append((license_id, i, ids, np.unique(ids), least))
        # For each template and word whether it holds it; the last place is that of words in no template.
        self.holds = np.zeros((len(self.templates), len(self.number) + 1), bool)
        for row, (_, _, ids, _, _) in zip(self.holds, self.templates, strict=True):
            row[ids] = True

    def _stretches(self, hit: np.ndarray, width: int, least: int) -> Iterator[tuple[int, int]]:
        """Ranges of the text made of windows of ``width`` words that hold ``least`` hits."""
        sums = np.concatenate([[0], np.cumsum(hit)])
        starts = np.flatnonzero(hit)
        ends = np.minimum(starts + width, len(hit))
        enough = sums[ends] - sums[starts] >= least
        begin = end = -1
        for s, e in zip(starts[enough].tolist(), ends[enough].tolist(), strict=True):
            if s >= end:
                if end > 0:
                    yield begin, end
                begin = s
            end = e
        if end > 0:
            yield begin, end

    def scan(self, text: str) -> list[tuple[str, int, float, int, int]]:
        """(license, wording, coverage, first word, last word + 1) of each stretch that reaches the coverage."""
        number = self.number
        ids = np.array([number.get(w, -1) for w in word_list(text)], np.int64)
        there = np.zeros(len(number) + 1, bool)
        there[ids] = True
        found = []
        for (license_id, wording, template, own, least), holds in zip(self.templates, self.holds, strict=True):
            if np.count_nonzero(there[own]) < self.coverage * len(own) - (len(template) - len(own)):
                continue
            width = STRETCH * len(template)
            hit = holds[ids]
            for begin, end in self._stretches(hit, width, least):
                found += self._notices(ids, hit, begin, end, license_id, wording, template, least, width)
        return found

    @staticmethod
    def _common(ids: list[int], hits: list[int], template: list[int], width: int) -> list[int]:
        """How many words of the template the window at each hit holds, each as often as both do: no more can be aligned."""
        left, out, common, behind = Counter(template), [], 0, 0
        for start in hits:
            while behind < len(hits) and hits[behind] < start + width:
                word = ids[behind]
                common += left[word] > 0
                left[word] -= 1
                behind += 1
            out.append(common)
            word = ids[len(out) - 1]  # leaves the window
            left[word] += 1
            common -= left[word] > 0
        return out

    def _best(self, ids: np.ndarray, starts: list[int], limit: int, end: int, template: list[int]) -> tuple[int, int, int]:
        """(aligned words, minus the stretch's length, its start) of the best window at these starts.

        The stretch itself starts before ``limit``, or the notice after this one would win over it.

        A short window comes nearer to a whole notice, a long one takes in words that were put into it.
        """
        best = (0, 0, 0)
        for start in starts:
            for width in (len(template), STRETCH * len(template)):
                aligned = align(template, ids[start : min(start + width, end)].tolist())
                if aligned and start + aligned[0][1] < limit:
                    first, last = aligned[0][1], aligned[-1][1] + 1
                    best = max(best, (len(aligned), first - last, start + first))
        return best

    def _notices(self, ids, hit, begin, end, license_id, wording, template, least, width):
        """The stretch is searched window by window, since a word is seldom unique in a long one."""
        places = begin + np.flatnonzero(hit[begin:end])
        hits = places.tolist()
        common = self._common(ids[places].tolist(), hits, template, width)
        at = 0
        while at < len(hits):
            if common[at] < least:
                at += 1
                continue
            n, minus, first = self._best(ids, [hits[at]], end, end, template)
            if n >= least:
                limit = first + max(1, len(template) // 2)
                near = hits[at : bisect_left(hits, limit)]
                n, minus, first = self._best(ids, near, limit, end, template)
                yield license_id, wording, n / len(template), first, first - minus
                at = bisect_left(hits, first - minus)
            else:
                at += 1


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``notices``, an array of struct (license, wording, coverage, start, end).

    ``start`` and ``end`` count words. A NULL or empty text has no notices. A license found in several
    wordings or places is there several times.
    """
    kinds = [("license", pa.string()), ("wording", pa.int32()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]
    scanner = Scanner(templates if templates is not None else TEMPLATES, coverage)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scanner.scan(t.as_py() or "") for t in batch.column("text")]
        notices = pa.array(found, pa.list_(pa.struct(kinds)))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), notices], ["doc_id", "notices"])

    rows = columns(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    notice = "struct<license: string, wording: int, coverage: double, start: bigint, end: bigint>"
    return map_batches(rows, apply, f"doc_id long, notices array<{notice}>")
