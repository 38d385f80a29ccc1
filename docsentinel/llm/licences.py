"""Licence scan: a generalised suffix automaton of licence tokens.

Documents stream through the automaton one word at a time. Every position gets its
matching statistics (the longest licence fragment that ends there). Fragments that
cannot grow further become anchors; anchors of one template that follow each other in
the same order are chained into covered spans.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import map_rows, table, utf8, words_alnum

# Phrases whose every occurrence is reported, and their labels.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Texts and notices of public licences, by label.
TEMPLATES = (
    # First sentences, as they are quoted alone.
    ("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    # Notices and whole texts.
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License v2"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution."""),
    ("bsd", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission."""),
    ("bsd", """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
        OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "available under the Creative Commons Attribution-ShareAlike License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
        for more details. You should have received a copy of the GNU General Public License along with this program."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version."""),
    ("agpl", """under the terms of the GNU Affero General Public License as published by the Free Software Foundation"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mit", "Released under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mit", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
        SOFTWARE."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions"""),
) + tuple(
    (label, f"SPDX-License-Identifier: {name}") for name, label in (
        ("MIT", "mit"), ("Apache-2.0", "apache-2.0"), ("BSD-2-Clause", "bsd"), ("BSD-3-Clause", "bsd"), ("ISC", "isc"),
        ("GPL-2.0", "gpl"), ("GPL-3.0", "gpl"), ("LGPL-2.1", "lgpl"), ("LGPL-3.0", "lgpl"), ("AGPL-3.0", "agpl"),
        ("MPL-2.0", "mpl-2.0"), ("CC0-1.0", "cc0"), ("CC-BY-4.0", "cc-by"), ("CC-BY-SA-4.0", "cc-by-sa"),
        ("Unlicense", "unlicense"), ("Zlib", "zlib"),
    )
)


@dataclass
class SuffixAutomaton:
    """States of a generalised suffix automaton over word ids."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set] = field(default_factory=lambda: [set()])

    def add(self, words: list[int], template: int) -> None:
        last, path = 0, []
        for w in words:
            last = self._extend(last, w)
            path.append(last)
        for at, state in enumerate(path):
            while state > 0:
                self.ends[state].add((template, at))
                state = self.link[state]

    def _state(self, length: int, link: int, nxt: dict[int, int], ends: set) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(ends)
        return len(self.next) - 1

    def _split(self, parent: int, old: int, w: int) -> int:
        """A copy of ``old`` for the shorter strings that reach it from ``parent``."""
        new = self._state(self.length[parent] + 1, self.link[old], dict(self.next[old]), set(self.ends[old]))
        self.link[old] = new
        while parent >= 0 and self.next[parent].get(w) == old:
            self.next[parent][w] = new
            parent = self.link[parent]
        return new

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:  # another template has this string already
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, w)
        state = self._state(self.length[last] + 1, 0, {}, set())
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            old = self.next[p][w]
            self.link[state] = old if self.length[old] == self.length[p] + 1 else self._split(p, old, w)
        return state


@dataclass
class LicenceModel:
    """Automaton, vocabulary and what its states mean."""

    vocabulary: dict[bytes, int]
    automaton: SuffixAutomaton
    names: list[str]
    sizes: list[int]
    n_base: int
    base_at: list[tuple]

    @staticmethod
    def build(base=BASE_PHRASES, templates=TEMPLATES) -> LicenceModel:
        vocabulary: dict[bytes, int] = {}
        automaton, names, sizes, coded = SuffixAutomaton(), [], [], []
        for text, label in [*base, *[(t, x) for x, t in templates]]:
            coded.append([vocabulary.setdefault(w, len(vocabulary)) for w in words_alnum(text.encode())])
            names.append(label)
            sizes.append(len(coded[-1]))
        for k, ids in enumerate(coded):
            automaton.add(ids, k)
        ending = {}
        for k, ids in enumerate(coded[: len(base)]):
            state = 0
            for w in ids:
                state = automaton.next[state][w]
            ending.setdefault(state, []).append((k, len(ids)))
        base_at = []
        for state in range(len(automaton.next)):
            found = []
            while state > 0:
                found += ending.get(state, [])
                state = automaton.link[state]
            base_at.append(tuple(found))
        return LicenceModel(vocabulary, automaton, names, sizes, len(base), base_at)


def matching_statistics(model: LicenceModel, ids: list) -> list[tuple[int, int, int]]:
    """(position, length, state) wherever some licence fragment ends; ``None`` ids match nothing."""
    nxt, link, length = model.automaton.next, model.automaton.link, model.automaton.length
    out, state, size, before = [], 0, 0, -2
    for at in [j for j, w in enumerate(ids) if w is not None]:
        if at != before + 1:
            state = size = 0
        before, w = at, ids[at]
        while state and w not in nxt[state]:
            state = link[state]
            size = length[state]
        state = nxt[state].get(w, 0)
        size = size + 1 if state else 0
        out.append((at, size, state))
    return out


def chain_matches(model: LicenceModel, stats, min_match: int, max_gap: int) -> list[tuple[str, int, int, float, int]]:
    """Covered template spans (label, first word, end word, covered share and words of the template)."""
    chains: dict[int, list[list]] = defaultdict(list)  # template: [doc start, doc end, template end, covered]
    for k, (at, size, state) in enumerate(stats):
        if size < min(min_match, *model.sizes[model.n_base:]):
            continue
        if k + 1 < len(stats) and stats[k + 1][:2] == (at + 1, size + 1):
            continue  # the fragment goes on
        for template, end in sorted(model.automaton.ends[state]):
            if template < model.n_base or size < min(min_match, model.sizes[template]):
                continue
            begin, t_begin = at - size + 1, end - size + 1
            last = chains[template][-1] if chains[template] else None
            if last and begin - last[1] <= max_gap and t_begin > last[2] and begin >= last[1]:
                last[1], last[2], last[3] = at + 1, end, last[3] + size
            elif not last or last[1] <= begin or size > last[3]:
                chains[template].append([begin, at + 1, end, size])
    return [
        (model.names[t], c[0], c[1], min(1.0, c[3] / model.sizes[t]), c[3]) for t, found in sorted(chains.items()) for c in found
    ]


def scan_licences(
    docs: DataFrame,
    base=BASE_PHRASES,
    templates=TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
    min_match: int = 4,
    max_gap: int = 12,
    min_cover: float = 0.8,
    min_words: int = 16,
) -> DataFrame:
    """Base phrase places and covered licence spans of every whole text.

    Columns: ``doc_id``, ``n_words``, ``base_label``/``base_start`` (one entry a place),
    ``span_label``/``span_start``/``span_end``/``span_score`` (spans that cover at least
    ``min_cover`` of a template, or ``min_words`` of its words), ``best_cover`` (highest share of any span). Word
    positions count from 0. Null and empty texts have no words and empty arrays; repeated
    rows are scanned one by one; extra columns are ignored; an empty table gives none.
    """
    schema = (
        "doc_id long, n_words long, base_label array<string>, base_start array<long>, span_label array<string>, "
        "span_start array<long>, span_end array<long>, span_score array<double>, best_cover double"
    )
    model = LicenceModel.build(base, templates)

    def scan(data: bytes) -> tuple:
        words = words_alnum(data)
        stats = matching_statistics(model, list(map(model.vocabulary.get, words)))
        places = [
            (model.names[k], at - m + 1) for at, size, state in stats for k, m in model.base_at[state] if m <= size
        ]
        spans = chain_matches(model, stats, min_match, max_gap)
        kept = [s[:4] for s in spans if s[3] >= min_cover or s[4] >= min_words]
        return len(words), places, kept, max((s[3] for s in spans), default=0.0)

    def make():
        def batch(cols):
            rows = [scan(x) for x in cols[1]]
            return {
                "doc_id": cols[0],
                "n_words": [r[0] for r in rows],
                "base_label": [[p[0] for p in r[1]] for r in rows],
                "base_start": [[p[1] for p in r[1]] for r in rows],
                "span_label": [[s[0] for s in r[2]] for r in rows],
                "span_start": [[s[1] for s in r[2]] for r in rows],
                "span_end": [[s[2] for s in r[2]] for r in rows],
                "span_score": [[s[3] for s in r[2]] for r in rows],
                "best_cover": [r[3] for r in rows],
            }

        return batch

    return map_rows(docs.select(F.col(key).cast("long"), utf8(text).alias("data")), schema, make)


def op8_licences(spark, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    found = scan_licences(table(spark, sf_dir, "documents"))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("base_start").cast("long").alias("n_base"),
        F.array_min("base_start").alias("first_word"), F.array_max("base_start").alias("last_word"),
        joined(F.col("base_label")).alias("base_labels"),
        joined(F.concat("base_label", "span_label")).alias("labels"),
        F.when(F.size("base_start") > 0, 1.0).otherwise(F.col("best_cover")).alias("score"),
    )
