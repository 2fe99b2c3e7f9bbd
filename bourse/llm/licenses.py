"""License scans by conditional compression.

Sentences that speak of licences, what stands between two of them that are
close, and a few that follow make a candidate block. Windows of each block are compressed alone and
with each template as a raw zstandard dictionary. Every template that saves
MIN_SAVING of its own compressed size in some window is aligned word by word
with the whole block, wherever it stands and however often, with its exact
differences: words of the template that the block lacks and words it has
besides. Spans that overlap compete; the one with most words found, less its
differences, stays.

Blocks are proposed by a Spark expression that sorts out texts without any
licence word; the rest runs in Arrow batches over whole texts.

One row per licence found: ``doc_id start end`` (code points, end exclusive, from
the first to the last word found and the punctuation after it) ``license
status`` (``exact`` or ``modified``) ``size_alone size_with saving lacks besides``
(bytes of the window that saves most, what it saves of the template's own
compressed size, and the differing words, space-joined). A template counts as found
with MATCH of its words, where a word it lacks costs as much as LACK words
besides and all differences at most HALF of lacking everything.

Results for odd rows: a null or empty text has no blocks; a null id is kept;
repeated rows are scanned each; of equal savings the template that sorts first
wins; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_TWO = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THREE = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission.")

_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_LIABILITY = (
    " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
    "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of "
    "the License, or (at your option) any later version.")
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies.")
_UNLICENSE = "This is free and unencumbered software released into the public domain."
#: Identifiers of the SPDX licence list for which a tag is a template.
SPDX = ("0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only "
        "GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib").split()

#: Public licence texts and notices, fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "BSD-2-Clause": _BSD_HEAD + _BSD_TWO,
    "BSD-3-Clause": _BSD_HEAD + _BSD_TWO + _BSD_THREE,
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "AGPL-notice": _GNU.format(what="program", name="Affero General Public License", version="3"),
    "BSD-2-Clause-text": _BSD_HEAD + _BSD_TWO + _BSD_DISCLAIMER,
    "BSD-3-Clause-text": _BSD_HEAD + _BSD_TWO + _BSD_THREE + _BSD_DISCLAIMER,
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
        "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this "
        "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or "
        "derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/"),
    "GPL-2.0-notice": _GNU.format(what="program", name="General Public License", version="2").replace("is free software:", "is free software;"),
    "ISC": _ISC_GRANT,
    "ISC-text": _ISC_GRANT + (
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "LGPL-2.1-notice": _GNU.format(what="library", name="Lesser General Public License", version="2.1").replace("is free software:", "is free software;"),
    "LGPL-3.0-notice": _GNU.format(what="program", name="Lesser General Public License", version="3"),
    "MIT-full": _MIT_GRANT + _MIT_LIABILITY,
    "MIT": "Released under the MIT License.",
    "MIT-text": _MIT_GRANT,
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."),
    "Unlicense": _UNLICENSE,
    "Unlicense-text": _UNLICENSE + (
        " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software "
        "to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented "
        "as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    **{f"{i}-tag": f"SPDX-License-Identifier: {i}" for i in SPDX},
}

#: Words that propose a sentence, and how many sentences may lie between two or
#: follow the last one.
TRIGGER = r"(?i)licen[sc]e|copyright|spdx|redistribut|permission|public domain|free software|warrant(?:y|ies)|liab(?:le|ility)|disclaim|misrepresent|mozilla"
GAP = 2
#: Least share of a template's compressed size saved, least share of its words found.
MIN_SAVING, MATCH = 0.2, 0.85
#: Words besides that cost as much as one lacking, most cost as a share of lacking all.
LACK, HALF = 4, 0.5
#: Words in a window that is compressed; each window starts at half the one before.
WINDOWS = (32, 256)

_TRIGGER = re.compile(TRIGGER)
_SENTENCE = re.compile(r"[^\n.]+(?:\.(?!\s|$)[^\n.]*)*\.?")
_WORD = re.compile(r"\w+(?:[.-]\w+)*")
_AFTER = re.compile(r"[^\w\s]*")


def blocks(text: str) -> list[tuple[int, int, int]]:
    """Candidate blocks as (start, end, reach): ``end`` after the last sentence
    that speaks of licences, ``reach`` after those that follow."""
    out: list[list[int]] = []
    for i, m in enumerate(_SENTENCE.finditer(text)):
        if _TRIGGER.search(m[0]):
            start = m.start() + len(m[0]) - len(m[0].lstrip())
            if out and i - out[-1][3] <= GAP + 1:
                out[-1][1:] = [m.end(), m.end(), i]
            else:
                out.append([start, m.end(), m.end(), i])
        elif out and i - out[-1][3] <= GAP:
            out[-1][2] = m.end()
    return [(a, b, c) for a, b, c, _ in out]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _costs(want: np.ndarray, got: np.ndarray, anywhere: bool) -> np.ndarray:
    """Least cost of the wanted words against words that end at each place:
    begun ``anywhere``, of all wanted words; begun at the first place, one row
    for the first ``i`` of them each."""
    at = np.arange(len(got) + 1, dtype=np.int32)
    row = np.zeros_like(at) if anywhere else at.copy()
    rows = [row]
    for w in want:
        new = row + LACK
        hit = np.flatnonzero(got == w)
        new[hit + 1] = np.minimum(new[hit + 1], row[hit])
        row = np.minimum.accumulate(new - at) + at
        if not anywhere:
            rows.append(row)
    return row if anywhere else np.stack(rows)


def _pairs(want: np.ndarray, got: np.ndarray) -> list[tuple[int, int]]:
    """The matched words (wanted, got) of a best alignment that ends with the
    last word of ``got`` and begins at its cheapest place."""
    back = _costs(want[::-1], got[::-1], False)
    i, j, out = len(want), int(back[-1].argmin()), []
    n, k = len(got), len(want)
    while i and j:
        if want[k - i] == got[n - j] and back[i, j] == back[i - 1, j - 1]:
            out.append((k - i, n - j))
            i, j = i - 1, j - 1
        elif back[i, j] == back[i - 1, j] + LACK:
            i -= 1
        else:
            j -= 1
    return out


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = {n: words(templates[n]) for n in self.names}
        self.number = {w: i for i, w in enumerate(sorted({w for v in self.words.values() for w in v}))}
        self.want = {n: np.array([self.number[w] for w in v], np.int32) for n, v in self.words.items()}
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.own = {n: len(self.alone.compress(templates[n].lower().encode())) for n in self.names}
        self.given = {n: zstandard.ZstdCompressor(level=3, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
            templates[n].lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for n in self.names}

    def savings(self, block: str, at: list[tuple[int, int]]) -> dict[str, tuple]:
        """``(saving, size_alone, size_with)`` of each template where it saves most."""
        best: dict[str, tuple] = {}
        for size in WINDOWS:
            for i in range(0, max(1, len(at) - size // 2), size // 2):
                data = block[at[i][0]:at[min(i + size, len(at)) - 1][1]].lower().encode()
                alone = len(self.alone.compress(data))
                for n in self.names:
                    given = len(self.given[n].compress(data))
                    best[n] = max(best.get(n, (-1.0, 0, 0)), ((alone - given) / self.own[n], alone, given))
            if len(at) <= size:
                break
        return best

    def spans(self, name: str, got: np.ndarray):
        """``(first, last, matched)`` of every place where a template is found."""
        want, taken = self.want[name], np.zeros(len(got), bool)
        cost = _costs(want, got, True)[1:]
        most = int(HALF * LACK * len(want))
        ends = np.flatnonzero((cost <= most) & (cost < np.append(most + LACK + 1, cost[:-1])) & (cost <= np.append(cost[1:], most + LACK + 1)))
        for end in ends[np.argsort(cost[ends], kind="stable")].tolist():
            low = max(0, end + 1 - len(want) - most)
            if taken[end]:
                continue
            matched = [(a, b + low) for a, b in _pairs(want, got[low:end + 1])]
            if len(matched) < MATCH * len(want) or taken[matched[0][1]:end + 1].any():
                continue
            taken[matched[0][1]:matched[-1][1] + 1] = True
            yield matched[0][1], matched[-1][1], matched

    def scan(self, block: str, end: int | None = None) -> list[tuple]:
        """Rows of the licences in a block, in text order; what follows ``end``
        is read where a licence is aligned, but not compressed."""
        at = [m.span() for m in _WORD.finditer(block)]
        core = [x for x in at if end is None or x[1] <= end]
        if not core:
            return []
        plain = [block[a:b].lower() for a, b in at]
        got = np.array([self.number.get(w, -1) for w in plain], np.int32)
        found = []
        for name, (saving, alone, given) in self.savings(block, core).items():
            if saving < MIN_SAVING:
                continue
            want = self.words[name]
            for first, last, matched in self.spans(name, got):
                in_want, in_got = {a for a, _ in matched}, {b for _, b in matched}
                lacks = [w for k, w in enumerate(want) if k not in in_want]
                besides = [plain[k] for k in range(first, last + 1) if k not in in_got]
                # the most words found less the differences, then the larger saving
                rank = (len(lacks) + len(besides) - len(matched), -saving, name, first)
                close = _AFTER.match(block, at[last][1]).end()
                found.append((rank, first, last, (at[first][0], close, name, "modified" if lacks or besides else "exact", alone, given, round(saving, 6), " ".join(lacks), " ".join(besides))))
        taken, out = np.zeros(len(got), bool), []
        for _, first, last, row in sorted(found):
            if not taken[first:last + 1].any():
                taken[first:last + 1] = True
                out.append(row)
        return sorted(out)


FIELDS = [("start", pa.int32()), ("end", pa.int32()), ("license", pa.string()), ("status", pa.string()), ("size_alone", pa.int32()), ("size_with", pa.int32()),
          ("saving", pa.float64()), ("lacks", pa.string()), ("besides", pa.string())]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    kind, templates = dict(docs.dtypes)[id_col], templates or TEMPLATES

    def scan(batches):
        scanner = Scanner(templates)
        for batch in slices(batches):
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for start, end, reach in blocks(text):
                    for first, last, *found in scanner.scan(text[start:reach], end - start):
                        at.append(i)
                        rows.append((start + first, start + last, *found))
            cols = list(zip(*rows)) or [()] * len(FIELDS)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, (_, t) in zip(cols, FIELDS)]], ["doc_id", *[n for n, _ in FIELDS]])

    likely = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").rlike(TRIGGER))
    return likely.mapInArrow(scan, f"doc_id {kind}, start int, end int, license string, status string, size_alone int, size_with int, saving double, lacks string, besides string")
