"""License scan by patience alignment.

Text and template are word sequences. Words that are unique in both are
anchors; the longest increasing subsequence of their places aligns them, and
the gaps between anchors are aligned the same way, with equal words at a gap's
ends taken first. Coverage is the share of the template's words that are
aligned.

A text longer than a template is aligned in passages: places where rare words
of the template crowd together. Each passage and template is aligned by
itself, so a license that a text holds twice, or beside other words, is found.

Coverage alone does not tell versions and families apart, as they share most
words. So a template may name words that must be among the aligned ones (the
license's name and version) and words that must not stand between them.

Defined results: null and wordless texts match nothing; an empty table gives an
empty table, repeated rows equal results; texts count whole, whatever their
length. Of overlapping finds the one with more aligned words stays, then the
one of higher coverage, then the first name. A column ``licenses`` is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import with_arrow

MIN_COVERAGE = 0.8
#: Templates are broadcast; more text than this is refused.
MAX_TEMPLATE_CHARS = 4 << 20
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")

#: Notices by which texts state their license, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
    "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
    "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
    "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-body": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
    "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at https://mozilla.org/MPL/2.0/.",
}

#: Words of a template that must be aligned, and words that must not stand between the aligned ones.
REQUIRED = {
    "Apache-2.0": ("apache", "2.0"),
    "Apache-2.0-notice": ("apache", "2.0"),
    "AGPL-3.0-notice": ("affero", "3"),
    "CC-BY-4.0": ("commons", "attribution", "4.0"),
    "CC-BY-4.0-short": ("cc", "by", "4.0"),
    "CC-BY-NC-4.0": ("cc", "by-nc", "4.0"),
    "CC-BY-SA-4.0": ("commons", "attribution-sharealike", "4.0"),
    "CC-BY-SA-4.0-short": ("cc", "by-sa", "4.0"),
    "GPL-2.0": ("gnu", "general", "2"),
    "GPL-2.0-notice": ("gnu", "general", "2"),
    "GPL-3.0": ("gnu", "general", "3"),
    "GPL-3.0-notice": ("gnu", "general", "3"),
    "LGPL-2.1-notice": ("lesser", "2.1"),
    "LGPL-3.0-notice": ("lesser", "3"),
    "MIT": ("mit",),
    "MPL-2.0": ("mozilla", "2.0"),
}
EXCLUDED = {
    "CC-BY-4.0": ("noncommercial", "sharealike", "noderivatives", "noderivs"),
    "CC-BY-4.0-short": ("nc", "sa", "nd"),
    "GPL-2.0": ("lesser", "library", "affero"),
    "GPL-2.0-notice": ("lesser", "library", "affero"),
    "GPL-3.0": ("lesser", "library", "affero"),
    "GPL-3.0-notice": ("lesser", "library", "affero"),
}

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()), T.StructField("aligned", T.LongType()),
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        ]
    )
)


def words(text: str) -> list[tuple[str, int, int]]:
    """Words in lower case with their places in code points."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given in the order of the first place, whose second places increase too."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, b) in enumerate(pairs):
        i = bisect_left(tails, b)
        before[k] = ends[i - 1] if i else -1
        tails[i : i + 1] = [b]
        ends[i : i + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places in a and b of aligned words, in order. Gaps are handled from a list, so depth does not matter."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, j, k, m = gaps.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {w: x for x, w in enumerate(b[k:m], k) if in_b[w] == 1}
        anchors = increasing([(x, place[w]) for x, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in place])
        if not anchors:
            continue
        out += anchors
        ends = [(i - 1, k - 1), *anchors, (j, m)]
        gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends[:-1], ends[1:], strict=True)]
    return sorted(out)


class Scanner:
    """Templates ready for alignment."""

    def __init__(self, templates: dict[str, str], required: dict[str, tuple] = REQUIRED, excluded: dict[str, tuple] = EXCLUDED) -> None:
        self.templates = {n: [w for w, _, _ in words(t)] for n, t in templates.items() if words(t)}
        holders = Counter(w for t in self.templates.values() for w in set(t))
        # the words that tell a template apart: those that the fewest templates have, and long ones
        self.rare = {n: set(sorted(set(t), key=lambda w: (holders[w], -len(w), w))[: max(2, len(set(t)) // 3)]) for n, t in self.templates.items()}
        self.required = {n: {*required.get(n, ())} for n in self.templates}
        self.excluded = {n: {*excluded.get(n, ())} for n in self.templates}
        for n, least in self.required.items():
            if strange := least - set(self.templates[n]):
                raise ValueError(f"{n}: {sorted(strange)} are no words of the template")
        self.any = {w: [n for n in self.templates if w in self.rare[n]] for r in self.rare.values() for w in r}

    def scan(self, text: str | None, least: float) -> list[dict]:
        found = words(text or "")
        sites: dict[str, list[int]] = {}
        for x, (w, _, _) in enumerate(found):
            for name in self.any.get(w, ()):
                sites.setdefault(name, []).append(x)
        out = []
        for name, places in sites.items():
            template = self.templates[name]
            out += self._passages(found, name, template, places, least)
        kept: list[dict] = []
        for f in sorted(out, key=lambda f: (-f["aligned"], -f["coverage"], f["license"], f["start"])):
            if all(f["end"] <= k["start"] or k["end"] <= f["start"] for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f["start"])

    def _passages(self, found, name: str, template: list[str], places: list[int], least: float) -> list[dict]:
        """Each place opens a passage as wide as the template on both sides; overlapping finds keep the best."""
        n, out = len(template), []
        need = max(1, int(least * len(self.rare[name]) / 2))
        last = -1
        for x, place in enumerate(places):
            if place <= last or bisect_left(places, place + n) - x < need:
                continue
            i, j = max(last + 1, place - n), min(len(found), place + n + n // 4)
            pairs = align([w for w, _, _ in found[i:j]], template)
            pairs = _dense(pairs, n)
            if pairs and len(pairs) >= least * n:
                a, b = i + pairs[0][0], i + pairs[-1][0]
                if not self.required[name] <= {template[y] for _, y in pairs} or any(w in self.excluded[name] for w, _, _ in found[a : b + 1]):
                    continue  # another version or family
                out.append({"license": name, "coverage": len(pairs) / n, "aligned": len(pairs), "start": found[a][1], "end": found[b][2]})
                last = b
        return out


def _dense(pairs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The run of aligned words inside a stretch of the text not much longer than the template that aligns most."""
    best: list[tuple[int, int]] = []
    i = 0
    for j in range(len(pairs)):
        while pairs[j][0] - pairs[i][0] >= n + n // 4 + 2:
            i += 1
        if j - i + 1 > len(best):
            best = pairs[i : j + 1]
    return best


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    text_col: str = "text",
    least: float = MIN_COVERAGE,
    required: dict[str, tuple] | None = None,
    excluded: dict[str, tuple] | None = None,
) -> DataFrame:
    """All columns and ``licenses``: each notice found, with its coverage, aligned words and place in code points.

    Own ``templates`` come with their own ``required`` and ``excluded`` words (default: none).
    """
    chosen = TEMPLATES if templates is None else templates
    required = (REQUIRED if templates is None else {}) if required is None else required
    excluded = (EXCLUDED if templates is None else {}) if excluded is None else excluded
    if sum(map(len, chosen.values())) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"over {MAX_TEMPLATE_CHARS} characters of templates; scan in several calls")
    shared = docs.sparkSession.sparkContext.broadcast(chosen)
    scanners: list[Scanner] = []
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("aligned", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def compute(texts: pa.Array) -> dict[str, pa.Array]:
        if not scanners:
            scanners.append(Scanner(shared.value, required, excluded))
        return {"licenses": pa.array([scanners[0].scan(t, least) for t in texts.to_pylist()], kind)}

    return with_arrow(docs, text_col, [T.StructField("licenses", FOUND)], compute)


def best_license(found):
    """Of a ``licenses`` column the one of most aligned words; null if none."""
    order = F.transform(found, lambda f: F.struct((-f["aligned"]).alias("a"), (-f["coverage"]).alias("c"), f["license"].alias("license"), f["start"].alias("start"), f["end"].alias("end")))
    return F.get(F.array_sort(order), F.lit(0))
