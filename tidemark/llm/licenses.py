"""Licence scan: Dice coefficient over word bigrams between parts of a text and licence templates.

A text's parts are the whole text, its paragraphs (between blank lines), its lines and its sentences. A part is
normalised (lower case, letters and digits only) and compared to a template only if their sizes allow the least
coefficient: Dice = 2|A and B| / (|A| + |B|) >= d needs |A| >= d / (2 - d) * |B|, and the other way round. A match
holds one at least of a few of the template's bigrams (so many as may miss, and one more: those of the longest words);
a part without any of these is not compared. With Params.windows, notices within parts are found too: all runs of
words of up to a template's size bound are compared, wherever they start and end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, in_arrow, mix64, slices, word_hashes

#: Public licence notices, (name, wording).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
        "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and "
        "to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
        "following:",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("Artistic-2.0", "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


@dataclass(frozen=True)
class Params:
    least_dice: float = 0.85
    #: Compare all windows over the words as well.
    windows: bool = False
    #: Report the best of licences whose parts overlap only: notices of one family are alike, and some hold others.
    resolve: bool = True
    templates: tuple[tuple[str, str], ...] = field(default=TEMPLATES)


_CLEAN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_PARAGRAPH = re.compile(rb"\n[ \t\r\x0b\x0c]*\n")
_SENTENCE = re.compile(rb"[.!?](?=[ \t\n\r\x0b\x0c])")


def _bigrams(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bigram hashes and the byte where each one's first word starts."""
    wh, _, ws, we = word_hashes([raw.translate(_CLEAN)])
    h = mix64(wh[:-1] * np.uint64(0x9E3779B97F4A7C15) + wh[1:])
    return h, np.column_stack((ws[:-1], we[1:])) if len(ws) > 1 else np.zeros((0, 2), np.int64)


class Templates:
    def __init__(self, p: Params):
        self.p = p
        sets = [np.unique(_bigrams(t.encode())[0]) for _, t in p.templates]
        self.names = [n for n, _ in p.templates]
        self.size = np.array([len(s) for s in sets])
        h, k = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(h, kind="stable")
        self.hash, self.of = h[order], k[order]
        ratio = p.least_dice / (2 - p.least_dice)
        # a match has at least ratio * |B| of a template's bigrams, so one at least of any |B| - that + 1: the longest
        self.signs = np.unique(np.concatenate([self._signs(t.encode(), ratio) for _, t in p.templates]))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.signs >> np.uint64(44)).astype(np.int64)] = True
        self.sets = sets
        #: Bigrams, repeated ones included, of the longest window for each template.
        self.reach = [int(len(_bigrams(t.encode())[0]) / ratio + 1e-9) for _, t in p.templates]
        self.least, self.most = np.ceil(self.size * ratio - 1e-9), np.floor(self.size / ratio + 1e-9)

    @staticmethod
    def _signs(raw: bytes, ratio: float) -> np.ndarray:
        h, span = _bigrams(raw)
        own, at = np.unique(h, return_index=True)
        length = (span[:, 1] - span[:, 0])[at]
        return own[np.argsort(-length, kind="stable")[: len(own) - int(np.ceil(ratio * len(own) - 1e-9)) + 1]]


def parts(raw: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the text and of its paragraphs, lines and sentences."""
    out = [("text", 0, len(raw))]
    for kind, cuts in (
        ("paragraph", [(m.start(), m.end()) for m in _PARAGRAPH.finditer(raw)]),
        ("line", [(m.start(), m.end()) for m in re.finditer(rb"\n", raw)]),
        ("sentence", [(m.end(), m.end()) for m in _SENTENCE.finditer(raw)] + [(m.start(), m.end()) for m in re.finditer(rb"\n", raw)]),
    ):
        at = 0
        for a, b in [*sorted(cuts), (len(raw), len(raw))]:
            if a > at:
                out.append((kind, at, a))
            at = max(at, b)
    return out


def windows(h: np.ndarray, t: Templates, hit: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
    """(template, Dice, first and last bigram) of the best windows over the bigrams h, the shortest and first of equals.
    hit: the places of all templates' bigrams. The best windows start and end with a bigram of their template: without
    another at the edge, the coefficient is no less."""
    prior = None
    for k, own in enumerate(t.sets):
        q = hit[np.isin(h[hit], own)]
        if not len(q):
            continue
        n = np.searchsorted(q, q + t.reach[k]) - np.arange(len(q))
        best = None
        for i in np.flatnonzero(2 * n >= t.p.least_dice * (t.size[k] + t.least[k]) - 1e-9).tolist():
            if prior is None:
                order = np.argsort(h, kind="stable")
                prior = np.full(len(h), -1)
                again = h[order[1:]] == h[order[:-1]]
                prior[order[1:][again]] = order[:-1][again]
            a, at = q[i], q[i : i + n[i]]
            size = np.cumsum(prior[a : at[-1] + 1] < a)[at - a]  # different bigrams up to each end
            dice = 2 * np.cumsum(prior[at] < a) / (size + t.size[k])
            j = int(dice.argmax())
            if dice[j] >= t.p.least_dice and (best is None or (-dice[j], at[j] - a) < (-best[1], best[3] - best[2])):
                best = (k, float(dice[j]), int(a), int(at[j]))
        if best:
            yield best


def scan_text(raw: bytes, bounds: list | None, h: np.ndarray, span: np.ndarray, t: Templates) -> list[tuple[str, float, str, int, int]]:
    """(licence, Dice, kind of part, start, end): the best part for each licence, the first and smallest of several."""
    best: dict[str, tuple] = {}
    sign, hit = np.flatnonzero(np.isin(h, t.signs)), np.flatnonzero(np.isin(h, t.hash))
    if not len(sign):
        return []
    for kind, a, b in bounds or parts(raw):
        lo, hi = np.searchsorted(span[:, 0], a), np.searchsorted(span[:, 1], b, "right")
        if np.searchsorted(sign, lo) == np.searchsorted(sign, hi):
            continue
        near = hit[np.searchsorted(hit, lo) : np.searchsorted(hit, hi)]
        if not len(near) or hi - lo < t.least.min():
            continue
        size = len(np.unique(h[lo:hi]))
        fits = (t.least <= size) & (size <= t.most)
        if not fits.any():
            continue
        own = np.unique(h[near])
        left, right = np.searchsorted(t.hash, own, "left"), np.searchsorted(t.hash, own, "right")
        both = np.bincount(np.concatenate([t.of[x:y] for x, y in zip(left, right, strict=True)]), minlength=len(t.size))
        dice = np.where(fits, 2 * both / (size + t.size), 0)
        for k in np.flatnonzero(dice >= t.p.least_dice):
            rank = (-dice[k], b - a, a)
            if t.names[k] not in best or rank < best[t.names[k]][0]:
                best[t.names[k]] = (rank, (t.names[k], float(dice[k]), kind, a, b))
    for k, dice, i, j in windows(h, t, hit) if t.p.windows else ():
        a, b = int(span[i, 0]), int(span[j, 1])
        if t.names[k] not in best or (-dice, b - a, a) < best[t.names[k]][0] and dice > best[t.names[k]][1][1]:
            best[t.names[k]] = ((-dice, b - a, a), (t.names[k], dice, "window", a, b))
    found = [v for _, v in best.values()]
    return sorted(resolved(found) if t.p.resolve else found)


def resolved(found: list[tuple[str, float, str, int, int]]) -> list[tuple[str, float, str, int, int]]:
    """The matches without those of which half lies in a better one: of a higher coefficient, or as high and longer."""
    kept: list[tuple[str, float, str, int, int]] = []
    for x in sorted(found, key=lambda x: (-x[1], x[3] - x[4], x[0])):
        if all(2 * (min(x[4], y[4]) - max(x[3], y[3])) <= min(x[4] - x[3], y[4] - y[3]) for y in kept):
            kept.append(x)
    return kept


def scan(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each document and licence found: doc_id, license, dice, part (text, paragraph, line, sentence or window) and
    the part's byte range start, end (exclusive). Of overlapping matches the best stays (Params.resolve).

    Null and empty texts give nothing. Repeated rows, and those of null and shared ids, give their rows each. An empty
    table gives an empty result. Whole texts are scanned; other columns of docs, whatever their names, don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(p)
        for batch in (x for whole in batches for x in slices(whole)):
            for ids, raws in chunks(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                lows = [r.translate(_CLEAN) for r in raws]
                wh, doc, ws, we = word_hashes(lows)
                if len(wh) < 2:
                    continue
                h = mix64(wh[:-1] * np.uint64(0x9E3779B97F4A7C15) + wh[1:])
                same = doc[1:] == doc[:-1]
                maybe = same & t.seen[(h >> np.uint64(44)).astype(np.int64)]
                rows = []
                ends = np.cumsum([len(r) + 1 for r in raws])
                for d in np.unique(doc[:-1][maybe]).tolist():
                    lo, hi = np.searchsorted(doc, d), np.searchsorted(doc, d, "right") - 1
                    at = ends[d] - len(raws[d]) - 1
                    span = np.column_stack((ws[lo:hi], we[lo + 1 : hi + 1])) - at
                    rows += [(ids[d], *x) for x in scan_text(raws[d], None, h[lo:hi], span, t)]
                if rows:
                    c = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int64()), pa.array(c[1]), pa.array(c[2], pa.float64()), pa.array(c[3]), pa.array(c[4], pa.int64()), pa.array(c[5], pa.int64())],
                        ["doc_id", "license", "dice", "part", "start", "end"],
                    )

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, license string, dice double, part string, start long, end long")
