"""License scan: patience alignment of documents with license templates.

A scan for three-word shingles of any template finds where a license may stand;
with ``everywhere`` so does a count of single words, which misses no place whose
window could reach the coverage. There, words that are unique both in the text and in the template are anchors;
their longest increasing subsequence fixes the alignment, and the gaps between
anchors are aligned in the same way, after common beginnings and ends, which
need not be unique. The share of template words that were aligned is the
coverage, so inserted, dropped or changed words cost only themselves.

Defined results. A-Z are lower-cased and ASCII punctuation parts words. Null and
empty texts and templates have no words and match nothing; a template without an
id is left out; of templates with one id all count. Words of a column
``required`` must be aligned, and words of ``refused`` may not stand between the
first and the last aligned word. Of equally covered licenses
the first id, of equally covered places the first one is reported. Repeated rows
have a result each. Extra columns are ignored; texts are read whole; empty
tables give no rows or no licenses.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailrisk.llm.hashing import chunks, mix, word_hashes
from mailrisk.session import ship_with_tasks

ship_with_tasks(__name__)

# License notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    "mit-line": "Released under the MIT License.",
}
_GNU = """{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} Public License
    as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later
    version. {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
    warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} Public License for more details."""
_GNU_LINE = "This work is licensed under the GNU {name} Public License, version {version}."
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
    this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution. {third} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
    IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
    SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY
    OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
    OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
    THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
    {holders} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
    ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
TEMPLATES |= {
    "agpl-3.0": _GNU.format(what="This program", name="Affero General", version="3"),
    "agpl-3.0-line": _GNU_LINE.format(name="Affero General", version="3"),
    "bsd-2-clause": _BSD.format(third=""),
    "bsd-3-clause": _BSD.format(third="""3. Neither the name of the copyright holder nor the names of its contributors may be
        used to endorse or promote products derived from this software without specific prior written permission."""),
    "gpl-2.0": _GNU.format(what="This program", name="General", version="2"),
    "gpl-2.0-line": _GNU_LINE.format(name="General", version="2"),
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
        OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    "lgpl-2.1": _GNU.format(what="This library", name="Lesser General", version="2.1"),
    "lgpl-3.0": _GNU.format(what="This library", name="Lesser General", version="3"),
    "mit-whole": TEMPLATES["mit"] + " " + _WARRANTY.format(holders="OR COPYRIGHT HOLDERS"),
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author
        or authors of this software dedicate any and all copyright interest in the software to the public domain. We make
        this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend
        this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
        under copyright law. """ + _WARRANTY.format(holders=""),
}
_CC = {"by", "nc", "sa", "nd"}
for _parts in ("by", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd"):
    TEMPLATES[f"cc-{_parts}-4.0-line"] = f"Licensed under CC {_parts.upper()} 4.0."
#: Words that tell a license from its kin: aligned ones, and ones that may not stand between them.
REQUIRED = {
    "agpl-3.0": "affero 3", "agpl-3.0-line": "affero 3", "apache-2.0": "apache 2", "apache-2.0-line": "apache 2",
    "bsd-3-clause": "endorse promote", "gpl-2.0": "2", "gpl-2.0-line": "2", "gpl-3.0": "3", "gpl-3.0-line": "3",
    "isc": "fee", "lgpl-2.1": "lesser 2 1", "lgpl-3.0": "lesser 3", "mit-line": "mit", "mit-whole": "liable",
    "mpl-2.0": "mozilla 2", "unlicense": "unencumbered",
}
REFUSED = {name: "affero lesser library" for name in ("gpl-2.0", "gpl-2.0-line", "gpl-3.0", "gpl-3.0-line")}
REFUSED["bsd-2-clause"] = "endorse promote"
for _name in [name for name in TEMPLATES if name.startswith("cc-")]:
    _own = set(_name.split("-")) & _CC
    REQUIRED[_name], REFUSED[_name] = " ".join(sorted(_own | {"cc", "4"})), " ".join(sorted(_CC - _own))
_PARTING = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)) + _PARTING, bytes(range(0x61, 0x7B)) + b" " * len(_PARTING))


@dataclass(frozen=True)
class Match:
    """Shingle length, lowest coverage, whether all places that single words leave
    possible are aligned besides those that share a shingle, and the most template words that are
    sent to the tasks; more templates than that are refused, none is dropped."""

    shingle: int = 3
    coverage: float = 0.75
    everywhere: bool = False
    most_words: int = 1_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given in order of the first number, in which the
    second increases too (patience sorting)."""
    tops: list[int] = []
    at_top: list[int] = []
    before: list[int] = []
    for place, (_, value) in enumerate(pairs):
        pile = bisect_left(tops, value)
        before.append(at_top[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            at_top.append(place)
        else:
            tops[pile], at_top[pile] = value, place
    run, place = [], at_top[-1] if at_top else -1
    while place >= 0:
        run.append(pairs[place])
        place = before[place]
    return run[::-1]


def align(left: list[bytes], right: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places of two word lists, in order."""
    aligned = []
    gaps = [(0, len(left), 0, len(right))]
    while gaps:
        a, a_end, b, b_end = gaps.pop()
        while a < a_end and b < b_end and left[a] == right[b]:
            aligned.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and left[a_end - 1] == right[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            aligned.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        own, other = Counter(left[a:a_end]), Counter(right[b:b_end])
        places = {word: at for at, word in enumerate(right[b:b_end], b) if other[word] == 1}
        pairs = [(at, places[word]) for at, word in enumerate(left[a:a_end], a) if own[word] == 1 and word in places]
        for x, y in _increasing(pairs):
            aligned.append((x, y))
            gaps.append((a, x, b, y))
            a, b = x + 1, y + 1
        if pairs:
            gaps.append((a, a_end, b, b_end))
    return sorted(aligned)


class Templates:
    """Template words, a sorted index of their shingles, and how often a template
    has each word."""

    def __init__(self, rows: list[tuple[str, str, str, str]], rule: Match):
        size = rule.shingle
        self.names = [row[0] for row in rows]
        self.words, self.required, self.refused = ([words_of(row[at].encode()) for row in rows] for at in (1, 2, 3))
        self.least = np.array([math.ceil(len(words) * rule.coverage - 1e-9) for words in self.words])
        self.known = np.unique(word_hashes([word for words in self.words for word in words]))
        self.held = np.zeros((len(rows), len(self.known)), np.int64)
        for number, words in enumerate(self.words):
            np.add.at(self.held[number], np.searchsorted(self.known, word_hashes(words)), 1)
        entries = []
        self.sizes = sorted({min(size, len(words)) for words in self.words if words})
        for number, words in enumerate(self.words):
            length = min(size, len(words))
            if length:
                keys = shingle_keys(word_hashes(words), length)
                entries += [(int(key), number, at) for at, key in enumerate(keys)]
        entries.sort()
        self.keys = np.array([key for key, _, _ in entries], np.uint64)
        self.places = [(number, at) for _, number, at in entries]

    def hits(self, hashes: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Per template the ``(place, template place)`` of shared shingles."""
        found: dict[int, list[tuple[int, int]]] = {}
        for size in self.sizes:
            keys = shingle_keys(hashes, size)
            first = np.searchsorted(self.keys, keys)
            held = np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == keys)
            for place in held.tolist():
                at = int(first[place])
                while at < len(self.keys) and self.keys[at] == keys[place]:
                    number, offset = self.places[at]
                    found.setdefault(number, []).append((place, offset))
                    at += 1
        return found

    def windows(self, hashes: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Per template the ``(words, place)`` of all windows that hold enough of
        its words for the coverage, most words first.

        A window holds as many of a word as both have. The word at a place counts
        for the windows that begin after the one which, within them, would be one
        too many, so adding up where such stretches begin and end counts all.
        """
        found: dict[int, list[tuple[int, int]]] = {}
        if not (len(hashes) and len(self.known)):
            return found
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        places = np.flatnonzero(self.known[at] == hashes)
        own = at[places]
        whole = np.minimum(np.bincount(own, minlength=len(self.known)), self.held).sum(axis=1)
        for number in np.flatnonzero((whole >= self.least) & (self.least > 0)).tolist():
            often = self.held[number][own]
            order = np.argsort(own[often > 0], kind="stable")
            word, place, most = own[often > 0][order], places[often > 0][order], often[often > 0][order]
            earlier = np.arange(len(word)) - most
            same = (earlier >= 0) & (word[np.maximum(earlier, 0)] == word)
            first = np.where(same, place[np.maximum(earlier, 0)] + 1, 0)
            first = np.maximum(first, place - self.length(number) + 1)
            change = np.bincount(first, minlength=len(hashes) + 1) - np.bincount(place + 1, minlength=len(hashes) + 1)
            counts = np.cumsum(change)[: len(hashes)]
            enough = np.flatnonzero(counts >= self.least[number])
            if len(enough):
                ranked = enough[np.argsort(-counts[enough], kind="stable")]
                found[number] = list(zip(counts[ranked].tolist(), ranked.tolist()))
        return found

    def length(self, number: int) -> int:
        """Words of a window: the template's and slack at both ends."""
        return len(self.words[number]) + 2 * (len(self.words[number]) // 4 + 3)

    def accepts(self, number: int, words: list[bytes], start: int, aligned: list[tuple[int, int]]) -> bool:
        """Whether the words that tell this license from others are as they must."""
        if not aligned:
            return False
        held = {words[start + at] for at, _ in aligned} if self.required[number] else set()
        between = words[start + aligned[0][0] : start + aligned[-1][0] + 1] if self.refused[number] else []
        return held.issuperset(self.required[number]) and not set(self.refused[number]).intersection(between)

    def best(
        self, words: list[bytes], number: int, hits: list[tuple[int, int]], windows: list[tuple[int, int]] = []
    ) -> tuple[int, int, int]:
        """``(aligned, start, end)`` of the best place of a template in a text.

        Hits are read in text order; where they jump back in the template, or
        leave a gap longer than it, another occurrence begins. Windows are
        aligned as long as they hold more words than the best place.
        """
        template = self.words[number]
        runs: list[list[tuple[int, int]]] = []
        for place, offset in hits:
            if runs and offset > runs[-1][-1][1] and place - runs[-1][-1][0] <= len(template):
                runs[-1].append((place, offset))
            elif not (runs and place == runs[-1][-1][0]):
                runs.append([(place, offset)])
        slack = len(template) // 4 + 3
        best = (0, 0, 0)
        for run in runs:
            start = max(0, run[0][0] - run[0][1] - slack)
            end = run[-1][0] + len(template) - run[-1][1] + slack
            aligned = align(words[start:end], template)
            if len(aligned) > best[0] and self.accepts(number, words, start, aligned):
                best = (len(aligned), start + aligned[0][0], start + aligned[-1][0] + 1)
        for count, start in windows:
            if count <= best[0]:
                break
            aligned = align(words[start : start + self.length(number)], template)
            if len(aligned) > best[0] and self.accepts(number, words, start, aligned):
                best = (len(aligned), start + aligned[0][0], start + aligned[-1][0] + 1)
        return best


def shingle_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    count = max(len(hashes) - size + 1, 0)
    keys = np.full(count, size, np.uint64)
    for ahead in range(size):
        keys = mix(keys) + hashes[ahead : ahead + count]
    return mix(keys)


def template_rows(templates: DataFrame, rule: Match) -> list[tuple[str, str, str, str]]:
    """Id, text, required and refused words of the templates on the driver, after their size has been checked."""
    known = templates.filter(F.col("template_id").isNotNull()).select(
        F.col("template_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"),
        *(
            (F.coalesce(name, F.lit("")) if name in templates.columns else F.lit("")).alias(name)
            for name in ("required", "refused")
        ),
    )
    size = known.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if size > rule.most_words:
        raise ValueError(f"{size} template words are more than the {rule.most_words} that may be sent to tasks")
    return sorted(tuple(row) for row in known.collect())


def default_templates(spark) -> DataFrame:
    rows = [(name, text, REQUIRED.get(name, ""), REFUSED.get(name, "")) for name, text in TEMPLATES.items()]
    return spark.createDataFrame(rows, "template_id string, text string, required string, refused string")


def scan_documents(documents: DataFrame, templates: DataFrame, rule: Match = Match()) -> DataFrame:
    """``doc_id, n_words, licenses`` for every row: structs ``(template_id,
    coverage, start, end)`` in words, best first, of sufficient coverage."""
    rows = template_rows(templates, rule)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(rows, rule)
        for batch, texts in chunks(batches, "text"):
            split = [words_of(text) for text in texts]
            hashes = word_hashes([word for words in split for word in words])
            found, place = [], 0
            for words in split:
                own = hashes[place : place + len(words)]
                place += len(words)
                best: dict[str, tuple] = {}
                hits = known.hits(own) if len(known.keys) else {}
                windows = known.windows(own) if rule.everywhere else {}
                for number in {**hits, **windows}:
                    aligned, start, end = known.best(words, number, hits.get(number, []), windows.get(number, []))
                    name, share = known.names[number], aligned / len(known.words[number])
                    if share >= rule.coverage and (name not in best or share > best[name][1]):
                        best[name] = (name, share, start, end)
                ordered = sorted(best.values(), key=lambda match: (-match[1], match[0]))
                found.append([dict(zip(("template_id", "coverage", "start", "end"), match)) for match in ordered])
            kind = pa.list_(pa.struct([
                ("template_id", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())
            ]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(words) for words in split], pa.int64()), pa.array(found, kind)],
                names=["doc_id", "n_words", "licenses"],
            )

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(
        scan,
        "doc_id long, n_words long, licenses array<struct<template_id:string,coverage:double,start:long,end:long>>",
    )
