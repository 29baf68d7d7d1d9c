"""Licence texts and notices in documents: Dice coefficient of word bigrams against templates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import U, arrow_schema, mix, ship, span_hashes, text_pieces, word_spans

# Least Dice coefficient of a match.
THRESHOLD = 0.8
# Letters, digits and all bytes of longer characters make words; case and marks do not count.
NO_WORD = np.ones(256, dtype=bool)
NO_WORD[48:58] = False
NO_WORD[97:123] = False
NO_WORD[128:] = False

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GPL = """This program is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License
as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""

# Fixed values: (licence, template), public licence texts, the notices that refer to them, and common short forms.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("BSD-2-Clause", f"{_BSD_2} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_2} 3. {_BSD_3} {_BSD_END}"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "ISC",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided '
        'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0-or-later", _GPL.format(colon=";", kind="", version=2)),
    ("GPL-3.0-or-later", _GPL.format(colon=":", kind="", version=3)),
    ("LGPL-2.1-or-later", _GPL.format(colon=";", kind="Lesser ", version="2.1").replace("program", "library")),
    ("AGPL-3.0-or-later", _GPL.format(colon=":", kind="Affero ", version=3)),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
        "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, "
        "and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


def bigrams(column: pa.Array) -> Iterator[np.ndarray]:
    """For every text the 64-bit hashes of its word bigrams, in order. Lines do not part bigrams."""
    for i, j, data, offsets in text_pieces(pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))):
        starts, ends, first = word_spans(data, offsets, NO_WORD)
        words = span_hashes(data, starts, ends)
        pairs = mix(words[:-1] * U(0x9FB21C651E98DF25) + words[1:]) if len(words) > 1 else np.empty(0, U)
        for k in range(j - i):
            yield pairs[first[k] : max(first[k], first[k + 1] - 1)]


@dataclass
class Template:
    licence: str
    counts: dict[int, int]
    size: int
    least: int  # bigrams of the shortest and longest stretch that can match, by size alone
    most: int


def compile_templates(templates=TEMPLATES, threshold: float = THRESHOLD) -> tuple[list[Template], np.ndarray]:
    """Templates, and all their bigrams sorted. A stretch of b bigrams shares at most min(b, size) with a template, so
    2 * min / (b + size) bounds its coefficient from above; that gives the bounds of b."""
    out = []
    for (licence, _), found in zip(templates, bigrams(pa.array([t for _, t in templates])), strict=True):
        n = len(found)
        least, most = int(np.ceil(n * threshold / (2 - threshold) - 1e-9)), int(n * (2 - threshold) / threshold + 1e-9)
        out.append(Template(licence, dict(Counter(found.tolist())), n, least, most))
    every = np.unique(np.array([b for t in out for b in t.counts], dtype=U))
    return out, every


def _best_stretches(hits: np.ndarray, values: list[int], template: Template, threshold: float) -> list[tuple[float, int, int]]:
    """(coefficient, first bigram, bigrams) of stretches that reach the threshold: of each place where one can
    start, the best. A best stretch starts and ends with a bigram of the template."""
    out = []
    n = len(hits)
    if n < template.least:
        return out
    # A start needs `least` hits within `most` bigrams.
    for i in range(n - template.least + 1):
        if hits[i + template.least - 1] - hits[i] + 1 > template.most:
            continue
        left = dict(template.counts)
        shared, best = 0, (0.0, 0, 0)
        for k in range(i, n):
            length = int(hits[k] - hits[i]) + 1
            if length > template.most:
                break
            v = values[k]
            if left[v]:
                left[v] -= 1
                shared += 1
            if length >= template.least:
                dice = 2 * shared / (length + template.size)
                if dice > best[0]:
                    best = (dice, int(hits[i]), length)
        if best[0] >= threshold:
            out.append(best)
    return out


def scan(pairs: np.ndarray, templates: list[Template], every: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(first word, words, licence, coefficient) of a text's licence passages, in order; of those that overlap the
    one with the highest coefficient stays, then the longer, then the earlier one."""
    if not len(pairs):
        return []
    at = np.minimum(np.searchsorted(every, pairs), len(every) - 1)
    places = np.flatnonzero(every[at] == pairs)
    if not len(places):
        return []
    values = pairs[places].tolist()
    present = Counter(values)
    found = []
    for t in templates:
        if sum(min(n, present.get(b, 0)) for b, n in t.counts.items()) < t.least:
            continue  # too little of it in the whole text
        own = [k for k, v in enumerate(values) if v in t.counts]
        for dice, first, length in _best_stretches(places[own], [values[k] for k in own], t, threshold):
            found.append((-dice, -length, first, t.licence))
    taken: list[tuple[int, int, str, float]] = []
    for dice, length, first, licence in sorted(found):
        if all(first - length <= a or first >= a + n - 1 for a, n, *_ in taken):
            taken.append((first, -length + 1, licence, -dice))
    return sorted(taken)


RESULT = "doc_id long, n_matches int, licences string, best_dice double, passages string"


def _scanned(threshold: float, known):
    schema = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, every = compile_templates(known, threshold)
        for batch in batches:
            rows = []
            for pairs in bigrams(batch.column("text")):
                found = scan(pairs, templates, every, threshold)
                rows.append(
                    (
                        len(found),
                        ",".join(sorted({x[2] for x in found})),
                        max((x[3] for x in found), default=0.0),
                        ";".join(f"{licence}@{first}+{words}" for first, words, licence, _ in found),
                    )
                )
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema
            )

    return run


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Per row of `docs` (doc_id, text): n_matches, licences (sorted names, comma-separated), best_dice, and passages
    as licence@first word+words, in order.

    The whole text is compared, wherever a licence passage stands in it: lower-cased words without marks, their
    bigrams, and stretches of them whose length can reach `threshold` with a template at all. The coefficient
    is 2 * shared / (bigrams of the stretch + of the template), with repeated bigrams counted as often as both have
    them. `templates` are pairs of a licence's name and a text of it; they go along with the code, so they have to be
    few enough for every task. Null and empty texts, and texts without a match, have 0, '', 0.0, ''. Rows stay as they are,
    repeated ones too; other columns are not read. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scanned(threshold, tuple(templates)), RESULT)
