"""License scan: lines, paragraphs and whole texts against licence templates.

A text is normalised (lower case, only letters, digits and the full stops and dashes
inside words) and becomes a multiset of word bigrams. It is compared with templates by
the Dice coefficient, twice the shared bigrams over the sum of both sizes. A coefficient
of ``t`` needs sizes within ``t / (2 - t)`` of each other, so only templates of about the
text's size are looked at, and a text beyond the largest template's bound is none's. Units
of a document are its lines, its paragraphs (lines up to a blank one) if they have several
lines, the whole, and the sentences of lines that have several. Where no unit is near a
template, windows of each template's size slide over the words of the whole document. Each row is judged by itself: nothing is shuffled.

Defined cases: NULL and blank texts have no units and no licence; a unit of one word is
compared by that word alone; of equal coefficients the template least by name counts;
repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import accumulate
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.8
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_WARRANTY = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_TWO = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_THREE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: Names of licences and texts that stand for them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("BSD", "Licensed under the BSD License."),
    ("BSD", "This project is licensed under the BSD License."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", _MIT_GRANT + " " + _MIT_WARRANTY),
    ("MIT", _MIT_GRANT),
    ("BSD", _BSD_START + _BSD_TWO + _BSD_WARRANTY),
    ("BSD", _BSD_START + _BSD_TWO + _BSD_THREE + _BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    *[(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))],
]
#: Where a sentence ends inside a line.
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+")
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(found: Sequence[str]) -> Counter:
    return Counter(zip(found, found[1:], strict=False)) if len(found) > 1 else Counter((w,) for w in found)


def dice(left: Counter, right: Counter) -> float:
    sizes = left.total() + right.total()
    return 2 * (left & right).total() / sizes if sizes else 0.0


class Scanner:
    """Templates in order of size."""

    def __init__(self, templates: Sequence[tuple[str, str]], least: float) -> None:
        made = sorted(((b.total(), name, b) for name, text in templates for b in [bigrams(words(text))]), key=lambda x: x[:2])
        self.made, self.sizes, self.least = made, [m[0] for m in made], least
        self.known: dict[tuple[str, ...], list[int]] = defaultdict(list)
        for k, (_, _, b) in enumerate(made):
            for g in b:
                self.known[g].append(k)
        # Sizes for which a coefficient of ``least`` is possible; a touch wider, for rounding.
        self.bound = least / (2 - least) * (1 - 1e-9)
        self.largest = (self.sizes[-1] if made else 0) / self.bound

    def best(self, found: Sequence[str]) -> tuple[str, float] | None:
        """The nearest template of a unit's words, if any is near enough."""
        size = max(1, len(found) - 1)
        if not found or size > self.largest:
            return None
        low, high = bisect_left(self.sizes, size * self.bound), bisect_right(self.sizes, size / self.bound)
        if low == high:
            return None
        # No more bigrams can be shared than are in any template at all.
        pairs = zip(found, found[1:], strict=False) if len(found) > 1 else [(w,) for w in found]
        shared = sum(g in self.known for g in pairs)
        if 2 * shared < self.least * (size + self.sizes[low]) * (1 - 1e-9):
            return None
        mine = bigrams(found)
        near = [
            (-dice(mine, b), name)
            for n, name, b in self.made[low:high]
            if 2 * min(shared, n) >= self.least * (size + n) * (1 - 1e-9)
        ]
        score, name = min(near, default=(0.0, ""))
        return (name, -score) if -score >= self.least else None

    def windows(self, found: Sequence[str], taken: list[tuple[int, int]]) -> list[tuple[str, float]]:
        """Templates near windows of their size in a text's words, outside places taken.

        A window that begins at a bigram of the template shares as many as any later one
        of it; of windows that overlap, the nearest and then the largest counts.
        """
        at: dict[int, list[int]] = defaultdict(list)
        grams = list(zip(found, found[1:], strict=False))
        for i, g in enumerate(grams):
            for k in self.known.get(g, ()):
                at[k].append(i)
        near = []
        for k, places in at.items():
            size, name, b = self.made[k]
            if len(places) < self.bound * size:
                continue
            inside, shared, last = Counter(), 0, 0
            for i in places:
                while last < len(places) and places[last] < i + size:
                    g = grams[places[last]]
                    inside[g] += 1
                    shared += inside[g] <= b[g]
                    last += 1
                score = 2 * shared / (size + min(size, len(grams) - i))
                if score >= self.least:
                    near.append((-score, -size, name, i, min(i + size, len(grams)) + 1))
                g = grams[i]
                shared -= inside[g] <= b[g]
                inside[g] -= 1
        hits, taken = [], list(taken)
        for score, _, name, start, end in sorted(near):
            if all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                hits.append((name, -score))
        return hits

    def scan(self, text: str) -> tuple[int, list[tuple[str, float]]]:
        """Units of a text, and the licences found in them, in order; then those of windows."""
        lines = [words(x) for x in text.split("\n")]
        starts = list(accumulate(map(len, lines), initial=0))
        everything = [w for x in lines for w in x]
        spans = [(i, i + len(x)) for i, x in zip(starts, lines, strict=False) if x]
        n_lines = len(spans)
        paragraphs, block = [], []
        for i, line in zip(starts, [*lines, []], strict=True):
            if line:
                block.append((i, i + len(line)))
                continue
            if len(block) > 1:
                paragraphs.append((block[0][0], block[-1][1], len(block)))
            block = []
        whole = len(paragraphs) > 1 or (bool(paragraphs) and n_lines > paragraphs[0][2])
        spans += [p[:2] for p in paragraphs]
        if whole:
            spans.append((0, len(everything)))
        for i, line in zip(starts, text.split("\n"), strict=False):
            parts = [len(x) for x in map(words, _SENTENCE.split(line)) if x]
            if len(parts) > 1:
                ends = list(accumulate(parts, initial=i))
                spans += zip(ends, ends[1:], strict=False)
        found = [(hit, span) for span in spans for hit in [self.best(everything[slice(*span)])] if hit]
        return len(spans), [h for h, _ in found] + self.windows(everything, [s for _, s in found])


def _scan(batches: Iterator[pa.RecordBatch], templates: Sequence[tuple[str, str]], least: float) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(templates, least)
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            units, hits = scanner.scan(text or "")
            name, score = min(((-s, n) for n, s in hits), default=(0.0, None))[::-1]
            rows.append((units, len(hits), ",".join(sorted({n for n, _ in hits})), name, -score))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]],
            ["doc_id", "n_units", "n_matches", "licenses", "license", "score"],
        )


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id``, ``n_units``, ``n_matches`` (units near a template), ``licenses`` (their names
    in order, with commas), ``license`` (the nearest) and ``score`` (its coefficient, or 0)."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        partial(_scan, templates=templates, least=least),
        "doc_id bigint, n_units bigint, n_matches bigint, licenses string, license string, score double",
    )
