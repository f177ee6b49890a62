"""Licence scan by patience alignment of notices and texts.

A notice is aligned with a stretch of the text: words that occur once in both are anchors, the
longest increasing run of anchors is kept, and the gaps between anchors are aligned in the same way.
The share of the notice's words that found a partner is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from barograph.llm.common import by_batch, documents, rows_to_batch

# Wording of common licence notices.
NOTICES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT line": "Released under the MIT License",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "GPL-3.0 line": "licensed under the GNU General Public License, version 3",
    "GPL-2.0 line": "licensed under the GNU General Public License, version 2",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version."
    ),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met"
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
        " MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License,"
        " or (at your option) any later version. This program is distributed in the hope that it will be useful,"
        " but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version. This program is distributed in the hope that it will be useful,"
        " but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-2.1 notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the"
        " License, or (at your option) any later version."
    ),
    "LGPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version."
    ),
    "AGPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Affero General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version."
    ),
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\","
        " WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,"
        " TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
        " IN THE SOFTWARE."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all"
        " copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS"
        " SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR"
        " BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
        " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER"
        " TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE"
        " COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
    ),
    "BSD-3-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. 3. Neither the name of the"
        " copyright holder nor the names of its contributors may be used to endorse or promote products derived"
        " from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE"
        " COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
    ),
    "Unlicense text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "EPL-2.0 notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "Zlib text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors"
        " be held liable for any damages arising from the use of this software. Permission is granted to anyone to"
        " use this software for any purpose, including commercial applications, and to alter it and redistribute"
        " it freely, subject to the following restrictions"
    ),
    "CC-BY-4.0 line": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0",
}
# Words too common to point at a notice.
COMMON = frozenset(
    "a an and any are as at be by can do either for if in is it not of on one or that the this to under use was"
    " with you".split()
)

_WORD = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class LicenseRules:
    #: Least share of a notice's words that must find a partner.
    coverage: float = 0.8
    #: Words that may lie between two words that point at a notice in the same stretch.
    gap: int = 12
    #: Least share of aligned words in the stretch from the first to the last.
    density: float = 0.5


DEFAULT_RULES = LicenseRules()


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def rising(values: Sequence[int]) -> list[int]:
    """Positions of a longest increasing subsequence."""
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        k = bisect_left(ends, value)
        if k:
            before[i] = at[k - 1]
        if k == len(ends):
            ends.append(value)
            at.append(i)
        else:
            ends[k], at[k] = value, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def aligned(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Partners (i, j) of equal words of a and b, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {w: k for k, w in enumerate(b[j:j_end], j) if in_b[w] == 1}
        anchors = [(k, place[w]) for k, w in enumerate(a[i:i_end], i) if in_a[w] == 1 and w in place]
        chain = [anchors[k] for k in rising([q for _, q in anchors])]
        if not chain:
            continue
        out += chain
        corners = [(i - 1, j - 1), *chain, (i_end, j_end)]
        todo += [(p + 1, p2, q + 1, q2) for (p, q), (p2, q2) in zip(corners, corners[1:], strict=False)]
    return sorted(out)


@dataclass(frozen=True)
class Notice:
    name: str
    words: tuple[str, ...]

    @cached_property
    def vocabulary(self) -> frozenset[str]:
        return frozenset(self.words)

    @cached_property
    def pointers(self) -> frozenset[str]:
        return self.vocabulary - COMMON or self.vocabulary

    def reachable(self, words: frozenset[str] | set[str]) -> float:
        """The largest coverage that a text of these words can have."""
        return sum(w in words for w in self.words) / len(self.words)

    def best_run(self, words: Sequence[str], first: int, last: int, rules: LicenseRules) -> tuple | None:
        """(coverage, start, end) of the alignment with words[first:last], if it is close enough."""
        pairs = aligned(self.words, words[first:last])
        # loose partners far from the others are no part of the notice
        runs: list[list[tuple[int, int]]] = []
        for pair in pairs:
            if runs and pair[1] - runs[-1][-1][1] <= rules.gap + pair[0] - runs[-1][-1][0]:
                runs[-1].append(pair)
            else:
                runs.append([pair])
        run = max(runs, key=len, default=[])
        if not run or len(run) < rules.coverage * len(self.words):
            return None
        start, end = first + run[0][1], first + run[-1][1] + 1
        if len(run) < rules.density * (end - start):
            return None
        return len(run) / len(self.words), start, end

    def find(self, words: Sequence[str], rules: LicenseRules) -> list[tuple[float, int, int]]:
        """All places of the notice in a text, without overlap."""
        points = [j for j, w in enumerate(words) if w in self.pointers]
        stretches: list[list[int]] = []
        for j in points:
            if stretches and j - stretches[-1][1] <= rules.gap:
                stretches[-1][1] = j
            else:
                stretches.append([j, j])
        found: list[tuple[float, int, int]] = []
        for low, high in stretches:
            found += self.walked(words, max(0, low - rules.gap), min(len(words), high + 1 + rules.gap), rules)
        return found

    def walked(self, words: Sequence[str], first: int, last: int, rules: LicenseRules) -> list[tuple[float, int, int]]:
        """Places in words[first:last], from left to right. A match is at most 1 / density times as long as
        the notice, so windows of that length and a step more hold every one; the walk goes on after a
        match, and looks once more at what lies before it. Several notices in a window hide each
        other's unique words, so a window without a match is tried again in halves that overlap."""
        found: list[tuple[float, int, int]] = []
        size = len(self.words)
        at, width = first, int(size / rules.density) + size + 2
        while at < last:
            end = min(last, at + width)
            places = self.inside(words, at, end, rules)
            found += places
            at = places[-1][2] if places else at + max(1, size)
        return found

    def inside(self, words: Sequence[str], first: int, last: int, rules: LicenseRules) -> list[tuple[float, int, int]]:
        """Places in one window."""
        if last - first < rules.coverage * len(self.words):
            return []
        if self.reachable(set(words[first:last])) < rules.coverage:
            return []
        run = self.best_run(words, first, last, rules)
        step, width = max(1, len(self.words) // 2), len(self.words) * 3 // 2 + 2
        at = first
        while not run and at < last and last - first > width:
            run = self.best_run(words, at, min(last, at + width), rules)
            at += step
        return [*self.inside(words, first, run[1], rules), run] if run else []


def notices(templates: Mapping[str, str]) -> list[Notice]:
    out = [Notice(name, tuple(words_of(text))) for name, text in templates.items()]
    return [n for n in out if n.words]


def scan_words(words: Sequence[str], known: Sequence[Notice], rules: LicenseRules) -> list[tuple[str, float, int, int]]:
    """(notice, coverage, first word, end) of the notices in a text, in the order of the text. Of two
    that share words the one with more aligned words stays, then the better covered, then the name."""
    present = set(words)
    found = [
        ((-round(place[0] * len(notice.words)), -place[0], notice.name), (notice.name, *place))
        for notice in known
        if notice.reachable(present) >= rules.coverage
        for place in notice.find(words, rules)
    ]
    kept: list[tuple[str, float, int, int]] = []  # in the order of the text, without overlap
    for _, match in sorted(found):
        at = bisect_left(kept, match[2], key=lambda other: other[2])
        if (at == 0 or kept[at - 1][3] <= match[2]) and (at == len(kept) or match[3] <= kept[at][2]):
            kept.insert(at, match)
    return kept


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, str] = NOTICES,
    rules: LicenseRules = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, matches, license, coverage) of every whole text.

    ``matches`` has the notice, its coverage, its first word and the word after its last; ``license``
    is the match with most words, then the best coverage, then the name. Row by row: a null or empty
    text has no matches and a null licence, repeated rows and null ids stay, other columns are not
    read, no rows give no rows.
    """
    match = pa.struct(
        [("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("matches", pa.list_(match)), ("license", pa.string()), ("coverage", pa.float64())]
    )

    def make():
        known = notices(templates)
        sizes = {n.name: len(n.words) for n in known}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [scan_words(words_of(text), known, rules) for text in batch.column("text").to_pylist()]
            names = [f.name for f in match]
            best = [min(f, key=lambda m: (-sizes[m[0]] * m[1], -m[1], m[0]), default=(None, None)) for f in found]
            return rows_to_batch(
                schema,
                [
                    batch.column("doc_id"),
                    [[dict(zip(names, m, strict=True)) for m in f] for f in found],
                    [b[0] for b in best],
                    [b[1] for b in best],
                ],
            )

        return step

    return by_batch(
        documents(docs, id_col, text_col),
        make,
        "doc_id long, matches array<struct<license: string, coverage: double, first_word: long, end_word: long>>,"
        " license string, coverage double",
    )
