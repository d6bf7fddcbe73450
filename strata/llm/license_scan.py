"""License scans by patience alignment against templates.

Text and template are aligned as patience diff does: match equal ends, anchor on
words that occur once on both sides, keep the longest increasing subsequence of
the anchors, and align the gaps between them the same way.  Coverage is the
share of the template's words that are matched.  A template's naming phrases
(``NAMING``) must be matched word by word without a gap, whatever the coverage.

A whole text may hold several notices, or one notice twice, so that no word is
unique to it.  Texts are therefore aligned region by region: a region is a
longest stretch in which none of the template's own anchor words (unique in the
template and not a function word) repeats and neighbouring anchor words are at
most a template's length apart.  Regions that lack too many anchors for the
coverage are not aligned.  Texts without any word that a template needs (of its
naming phrases, or an anchor) are passed over by one pattern match, which loses none.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, small_batches

LEAST_COVERAGE = 0.8
WORD = re.compile(r"\w+")

_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
_BSD_NAME = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission."
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
# Public license notices and texts, by SPDX-style name.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "bsd": "Released under the BSD License.",
    "isc": "Released under the ISC License.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": _CC.format("Attribution-ShareAlike"),
    "cc-by-nc-4.0-notice": _CC.format("Attribution-NonCommercial"),
    "cc-by-nd-4.0-notice": _CC.format("Attribution-NoDerivatives"),
    "cc-by-nc-sa-4.0-notice": _CC.format("Attribution-NonCommercial-ShareAlike"),
    "cc-by-nc-nd-4.0-notice": _CC.format("Attribution-NonCommercial-NoDerivatives"),
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "gpl-2.0-notice": _GNU.format("General Public License", "2"),
    "lgpl-2.1-notice": _GNU.format("Lesser General Public License", "2.1"),
    "lgpl-3.0-notice": _GNU.format("Lesser General Public License", "3"),
    "agpl-3.0-notice": _GNU.format("Affero General Public License", "3"),
    "mit-text": _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.",
    "bsd-2-clause-text": f"{_BSD} {_BSD_END}",
    "bsd-3-clause-text": f"{_BSD} {_BSD_NAME} {_BSD_END}",
    "isc-text": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}",
    "0bsd-text": f"{_ISC}. {_ISC_END}",
}
# Phrases that tell a license from its look-alikes, as they stand in its template.
NAMING = {
    "apache-2.0": ("apache license version 2 0",),
    "apache-2.0-notice": ("apache license version 2 0",),
    "mit": ("mit",),
    "mit-notice": ("person obtaining a copy",),
    "mit-text": ("person obtaining a copy", "above copyright notice and this permission notice shall be included"),
    "bsd": ("bsd",),
    "isc": ("isc",),
    "bsd-notice": ("redistribution and use",),
    "bsd-2-clause-text": ("redistribution and use", "redistributions in binary form must reproduce"),
    "bsd-3-clause-text": ("redistribution and use", "redistributions in binary form must reproduce", "endorse or promote products"),
    "isc-text": ("this permission notice appear in all copies",),
    "0bsd-text": ("with or without fee is hereby granted the software is provided",),
    "mpl-2.0-notice": ("mozilla public license v 2 0",),
    "cc-by-4.0": ("creative commons attribution 4 0",),
    "cc-by-4.0-short": ("cc by 4 0",),
    "all-rights-reserved": ("rights",),
    "gpl-3.0": ("gnu general public license", "version 3"),
    "gpl-3.0-notice": ("gnu general public license", "version 3 of"),
    "gpl-2.0": ("gnu general public license", "version 2"),
    "gpl-2.0-notice": ("gnu general public license", "version 2 of"),
    "lgpl-2.1": ("gnu lesser general public license", "version 2 1"),
    "lgpl-2.1-notice": ("gnu lesser general public license", "version 2 1 of"),
    "lgpl-3.0": ("gnu lesser general public license", "version 3"),
    "lgpl-3.0-notice": ("gnu lesser general public license", "version 3 of"),
    "agpl-3.0": ("gnu affero general public license", "version 3"),
    "agpl-3.0-notice": ("gnu affero general public license", "version 3 of"),
    **{f"cc-{x}-4.0": (f"cc {x.replace('-', ' ')} 4 0",) for x in ("by-nc", "by-nd", "by-sa", "by-nc-sa", "by-nc-nd")},
    "cc-by-sa-4.0-notice": ("commons attribution sharealike 4 0",),
    "cc-by-nc-4.0-notice": ("commons attribution noncommercial 4 0",),
    "cc-by-nd-4.0-notice": ("commons attribution noderivatives 4 0",),
    "cc-by-nc-sa-4.0-notice": ("commons attribution noncommercial sharealike 4 0",),
    "cc-by-nc-nd-4.0-notice": ("commons attribution noncommercial noderivatives 4 0",),
}
# A place of the first that overlaps one of the second is a part of it.
PART_OF = {"bsd-2-clause-text": "bsd-3-clause-text"}
# English function words, no anchors of a region.
FUNCTION_WORDS = frozenset("a all an and any are as at be by for from if in is it may not of on or that the this to under use with without you your".split())


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence (patience piles)."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        tops[pile : pile + 1] = [v]
        ends[pile : pile + 1] = [i]
        before.append(ends[pile - 1] if pile else -1)
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text place, template place), both ascending."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, z, b, y = gaps.pop()
        while a < z and b < y and text[a] == template[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < z and b < y and text[z - 1] == template[y - 1]:
            z, y = z - 1, y - 1
            out.append((z, y))
        if a == z or b == y:
            continue
        here, there = Counter(text[a:z]), Counter(template[b:y])
        once = {w: i for i, w in enumerate(template[b:y], b) if there[w] == 1 and here.get(w) == 1}
        pairs = [(i, once[w]) for i, w in enumerate(text[a:z], a) if w in once]
        kept = [pairs[i] for i in increasing([j for _, j in pairs])]
        out += kept
        if kept:
            marks = [(a - 1, b - 1), *kept, (z, y)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(marks, marks[1:])]
    return sorted(out)


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    anchors: frozenset
    naming: tuple[tuple[str, ...], ...] = ()

    @staticmethod
    def of(name: str, text: str, naming: tuple[str, ...] = ()) -> Template:
        words = tuple(words_of(text))
        uses = Counter(words)
        own = frozenset(w for w in words if uses[w] == 1 and w not in FUNCTION_WORDS)
        phrases = tuple(tuple(words_of(x)) for x in naming)
        return Template(name, words, own or frozenset(w for w in words if uses[w] == 1), phrases)

    def needed(self) -> frozenset:
        """Words of which a text with the template has one at least."""
        return frozenset([max((w for x in self.naming for w in x), key=len)]) if self.naming else self.anchors

    def named(self, pairs: list[tuple[int, int]]) -> bool:
        """Whether each naming phrase is matched without a gap."""
        at = {j: i for i, j in pairs}
        return all(
            any(self.words[j : j + len(x)] == x and j in at and all(at.get(j + k) == at[j] + k for k in range(len(x))) for j in range(len(self.words)))
            for x in self.naming
        )

    def regions(self, text: list[str], places: list[int]) -> list[tuple[int, int]]:
        """(first, stop) of the stretches to align; ``places``: of anchor words."""
        out, reach, lo, last = [], len(self.words), 0, {}
        for hi, p in enumerate(places):
            cut = lo
            if hi and p - places[hi - 1] > reach:
                cut = hi
            elif last.get(text[p], -1) >= lo:
                cut = last[text[p]] + 1
            if cut > lo:
                out.append((lo, hi))
                lo = cut
            last[text[p]] = hi
        if places:
            out.append((lo, len(places)))
        spans = []
        for i, j in out:
            first = max(places[i] - reach, places[i - 1] + 1 if i else 0)
            stop = min(places[j - 1] + reach, places[j] - 1 if j < len(places) else len(text) - 1) + 1
            spans.append((first, stop))
        return spans

    def places(self, text: list[str], where: dict[str, list[int]], least: float, stretch: float = 2.0) -> list[tuple[float, int, int]]:
        """(coverage, first, stop) of the covered places, of overlapping ones the
        best, of equals the first.  Only matches within ``stretch`` template
        lengths count together."""
        if any(w not in where for x in self.naming for w in x):
            return []
        places = sorted(p for w in self.anchors if w in where for p in where[w])
        found, most, size = [], stretch * len(self.words), len(self.words)
        for first, stop in self.regions(text, places):
            here = bisect_left(places, stop) - bisect_left(places, first)
            if size - (len(self.anchors) - here) < least * size:
                continue
            pairs = align(text[first:stop], list(self.words))
            lo, top = 0, None
            for hi in range(len(pairs)):
                while pairs[hi][0] - pairs[lo][0] >= most:
                    lo += 1
                coverage = (hi - lo + 1) / size
                if coverage >= least and (top is None or coverage > top[0]) and self.named(pairs[lo : hi + 1]):
                    top = (coverage, first + pairs[lo][0], first + pairs[hi][0] + 1)
            if top:
                found.append(top)
        out: list[tuple[float, int, int]] = []
        for x in sorted(found, key=lambda x: (-x[0], x[1])):
            i = bisect_left(out, x[1], key=lambda y: y[1])
            if (i == 0 or out[i - 1][2] <= x[1]) and (i == len(out) or x[2] <= out[i][1]):
                out.insert(i, x)
        return out


class Scanner:
    def __init__(self, templates: dict[str, str], least: float = LEAST_COVERAGE, naming: dict[str, tuple[str, ...]] | None = None):
        self.least = least
        if naming is None:
            naming = NAMING if templates is TEMPLATES else {}
        self.templates = [t for t in (Template.of(n, x, naming.get(n, ())) for n, x in sorted(templates.items())) if t.words]
        self.kept = frozenset().union(*(t.anchors.union(*t.naming) for t in self.templates))
        needed = frozenset().union(*(t.needed() for t in self.templates))
        self.pattern = "|".join(re.escape(w) for w in sorted(needed)) or r"[^\s\S]"

    def places(self, text: str) -> list[tuple[str, list[tuple[float, int, int]]]]:
        """(template, its covered places by first word) of every template that is covered."""
        words = words_of(text)
        where: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.kept:
                where.setdefault(w, []).append(i)
        out = {}
        for t in self.templates:
            if where and not t.anchors.isdisjoint(where) and (places := t.places(words, where, self.least)):
                out[t.name] = places
        for part, whole in PART_OF.items():
            if part in out and whole in out:
                out[part] = [x for x in out[part] if all(x[2] <= y[1] or y[2] <= x[1] for y in out[whole])]
        return [x for x in out.items() if x[1]]

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, stop) of every template that is covered,
        at its best place; of equals the first."""
        return [(name, *min(places, key=lambda x: (-x[0], x[1]))) for name, places in self.places(text)]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """doc_id and ``licenses`` (name, coverage, first, stop: word places; one for
    each covered place) of each row of ``docs`` (doc_id, text), by name and place;
    naming phrases hold for the built-in templates only; templates without words match
    nothing.  Null and empty texts have no license; repeated rows repeat."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Scanner(TEMPLATES if templates is None else templates, least))
    kind = pa.list_(pa.struct([("name", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("stop", pa.int64())]))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        scanner, texts = shared.value, pc.fill_null(b.column(1), "")
        likely = np.asarray(pc.match_substring_regex(texts, scanner.pattern, ignore_case=True).to_numpy(zero_copy_only=False), bool)
        found: list[list] = [[] for _ in range(len(texts))]
        for i, text in zip(np.flatnonzero(likely).tolist(), texts.filter(pa.array(likely)).to_pylist()):
            found[i] = [dict(zip(("name", "coverage", "first", "stop"), (name, *x))) for name, places in scanner.places(text) for x in places]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["doc_id", "licenses"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, licenses array<struct<name:string,coverage:double,first:long,stop:long>>")
