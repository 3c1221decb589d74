"""License scan: normalised text against licence templates by Dice over word bigrams.

A text and the templates become words of letters and digits in lower case. Where bigrams of a template
stand in a text, all windows that can reach the threshold are scored by

    dice = 2 * common bigrams / (bigrams of the window + bigrams of the template)

on multisets. Sizes bound it: a window with c of the template's bigrams in it can't score over
2c / (c + m) for a template of m bigrams, so a template is left aside unless a text has enough of its
bigrams, and a window is unless it has; one of s bigrams can't score over 2m / (s + m), so at 0.8 windows
have 2m/3 to 3m/2. Only windows that begin and end at a hit count: others score less than the one of these
within them. Of a template's windows that overlap the best stands, and of templates whose windows overlap the
one with more common bigrams, so a text isn't reported for a part of a longer licence as well. Templates are
a fixed list, with whole texts where these are short and headers and notices elsewhere; each text is scored
in its own row, so nothing is shuffled and a hot source costs no more than its own texts.

Defined results: a null or empty text has no licence; of equal windows the first, then the template that
comes first, is reported; a text may bear several licences that don't overlap; a repeated row gives
repeated results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
for more details."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_EPL = """This program and the accompanying materials are made available under the terms of the Eclipse Public License
2.0 which is available at https://www.eclipse.org/legal/epl-2.0/."""
#: Licence id, kind of text, text. Full grants, file headers and one-line notices.
TEMPLATES = (
    ("MIT", "text", _PERMISSION),
    ("BSD-2-Clause", "full", f"{_BSD_2} {_BSD_END}"),
    ("BSD-3-Clause", "full", f"{_BSD_2} {_BSD_NAMES} {_BSD_END}"),
    ("ISC", "full", f"{_ISC} {_ISC_END}"),
    ("Unlicense", "header", _UNLICENSE),
    ("Zlib", "full", _ZLIB),
    ("MPL-2.0", "header", _MPL),
    ("EPL-2.0", "header", _EPL),
    ("LGPL-3.0", "header", _GPL.replace("GNU General", "GNU Lesser General")),
    ("AGPL-3.0", "header", _GPL.replace("GNU General", "GNU Affero General")),
    ("BSD-2-Clause", "text", _BSD_2),
    ("BSD-3-Clause", "text", f"{_BSD_2} {_BSD_NAMES}"),
    ("ISC", "text", _ISC),
    ("Apache-2.0", "header", _APACHE),
    ("GPL-3.0", "header", _GPL),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "notice", "Released into the public domain under CC0 1.0."),
)
_WORD = re.compile(r"[^\W_]+")


def normalised(text: str) -> list[str]:
    """Words of letters and digits in lower case."""
    return _WORD.findall(text.lower())


class Templates:
    """The templates' bigrams, numbered over all of them."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.names = [(i, kind) for i, kind, _ in templates]
        self.counts = [Counter(zip(w, w[1:], strict=False)) for w in (normalised(t) for _, _, t in templates)]
        self.sizes = np.array([sum(c.values()) for c in self.counts])
        self.number = {g: k for k, g in enumerate(dict.fromkeys(g for c in self.counts for g in c))}
        self.held = np.zeros((len(self.counts), len(self.number)), np.int64)
        for t, c in enumerate(self.counts):
            for g, n in c.items():
                self.held[t, self.number[g]] = n
        self.threshold = threshold
        # 2c / (c + m) >= threshold, the window being at best the common bigrams alone.
        self.least = np.ceil(threshold * self.sizes / (2 - threshold) - 1e-9).astype(np.int64)
        self.first_words = {a for a, _ in self.number}

    def scan(self, text: str) -> list[tuple[int, float, int, int]]:
        """(template, dice, first word, end word) of the windows at or above the threshold."""
        words = normalised(text)
        number = self.number.get
        # Most words begin no bigram of any template.
        first = self.first_words
        hits = [(i, k) for i, w in enumerate(words[:-1]) if w in first and (k := number((w, words[i + 1]))) is not None]
        if not hits:
            return []
        place, gram = np.array(hits).T
        total = np.bincount(gram, minlength=len(self.number))
        out: list[tuple[int, int, float, int, int]] = []
        for t in np.flatnonzero(np.minimum(self.held, total).sum(1) >= self.least).tolist():
            own = self.held[t, gram] > 0
            if not (parts := self._windows(t, place[own], gram[own])):
                continue
            dice, common, start, end = np.concatenate(parts, axis=1)
            order = np.lexsort((end, start, -dice))
            dice, common, start, end = dice[order], common[order], start[order], end[order]
            # The best goes out and those that overlap it go, until none is left.
            while len(dice):
                out.append((-int(common[0]), t, float(dice[0]), int(start[0]), int(end[0])))
                apart = (end <= start[0]) | (start >= end[0])
                dice, common, start, end = dice[apart], common[apart], start[apart], end[apart]
        kept: list[tuple[int, float, int, int]] = []
        for _, t, dice, start, end in sorted(out, key=lambda f: (f[0], -f[2], f[3], f[1])):
            if all(end <= k[2] or k[3] <= start for k in kept):
                kept.append((t, dice, start, end))
        return sorted(kept, key=lambda f: (f[2], f[0]))

    def _windows(self, t: int, place: np.ndarray, gram: np.ndarray) -> list[np.ndarray]:
        """dice, common bigrams, first word, end word of all windows of one template at or above the threshold."""
        m, least, found = int(self.sizes[t]), int(self.least[t]), []
        widest = int(m * (2 - self.threshold) / self.threshold + 1e-9)
        # Windows begin at a hit; those with too few hits within the widest are passed over.
        ends = np.searchsorted(place, place + widest)
        starts = np.flatnonzero(ends - np.arange(len(place)) >= least)
        if not len(starts):
            return found
        # A hit counts unless the template's number of this bigram stands before it in the window.
        before, seen = np.full(len(place), -1), {}
        for i, g in enumerate(gram.tolist()):
            own = seen.setdefault(g, [])
            if len(own) >= (h := int(self.held[t, g])):
                before[i] = own[-h]
            own.append(i)
        for i in starts.tolist():
            common = np.cumsum(before[i : ends[i]] < i)
            dice = 2 * common / (place[i : ends[i]] - place[i] + 1 + m)
            good = np.flatnonzero(dice >= self.threshold)
            if len(good):
                found.append(np.stack([dice[good], common[good], np.full(len(good), place[i]), place[i + good] + 2]))
        return found


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """A row per licence found: doc_id, license_id, kind, dice (6 digits), start_word, end_word; docs: doc_id, text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for t, dice, a, b in known.scan(text or ""):
                    found.append((doc_id, *known.names[t], round(dice, 6), a, b))
            columns = list(zip(*found, strict=True)) or [[]] * 6
            kinds = ("int64", "string", "string", "float64", "int64", "int64")
            names = ("doc_id", "license_id", "kind", "dice", "start_word", "end_word")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, license_id string, kind string, dice double, start_word long, end_word long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, schema)
