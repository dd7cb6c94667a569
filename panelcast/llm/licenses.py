"""License scan by conditional compression, confirmed by exact wording differences."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wordings of public licenses and license notices: (name, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
)
# Stems of license language; every line of a wording to be found is at most ``GAP`` lines from one that has a stem.
STEMS = ("licen", "copyright", "permission", "redistribut", "public domain", "warrant", "merchantab", "software", "liab")
GAP, LONG_LINE, AROUND = 3, 1_200, 600
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_STEM = re.compile("|".join(STEMS))
_EDGES = "\"'`.,;:!?()[]{}<>*#/|-_"


@dataclass(frozen=True)
class Template:
    name: str
    text: str
    words: tuple

    @classmethod
    def of(cls, name: str, text: str) -> "Template":
        return cls(name, text, tuple(w for w, _, _ in wording(text)))


def wording(text: str, start: int = 0) -> list[tuple[str, int, int]]:
    """Words as compared: lower case, without punctuation at their ends; with their place in the text."""
    found = ((m.group().lower().strip(_EDGES), start + m.start(), start + m.end()) for m in _WORD.finditer(text))
    return [w for w in found if w[0]]


def candidate_blocks(text: str) -> list[tuple[int, int]]:
    """Spans of the text around license language: the lines with a stem and ``GAP`` lines on either side,
    joined where they meet. Of a very long line only ``AROUND`` characters next to a stem or to the rest
    of the block are taken."""
    low = text.lower()
    if len(low) != len(text):  # lower case of another length would shift all places
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    if not any(stem in low for stem in STEMS):
        return []
    lines, at = [], 0
    for line in low.split("\n"):
        lines.append((at, at + len(line), [at + m.start() for m in _STEM.finditer(line)]))
        at += len(line) + 1
    spans = []
    for i, (_, _, hits) in enumerate(lines):
        if not hits:
            continue
        for start, end, own in lines[max(0, i - GAP) : i + GAP + 1]:
            if end - start <= LONG_LINE:
                spans.append((start, end))
            elif own:
                spans += [(max(start, h - AROUND), min(end, h + AROUND)) for h in own]
            elif start > hits[-1]:
                spans.append((start, start + AROUND))
            else:
                spans.append((end - AROUND, end))
    joined = []
    for start, end in sorted(set(spans)):
        if joined and start <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


class Scanner:
    """Templates as compressors: one plain, one per template with its text as raw dictionary."""

    def __init__(self, templates: tuple = TEMPLATES, tolerance: float = 0.1):
        self.templates = [Template.of(*t) for t in templates]
        self.tolerance = tolerance
        self.counts = [Counter(t.words) for t in self.templates]
        data = [t.text.lower().encode() for t in self.templates]
        self.lengths = [len(d) for d in data]
        # The same parameters with and without a dictionary, so that only its content makes a difference.
        same = zstandard.ZstdCompressionParameters.from_level(3, source_size=2 * max(self.lengths, default=1))
        self.plain = zstandard.ZstdCompressor(compression_params=same)
        self.conditional = [
            zstandard.ZstdCompressor(
                compression_params=same, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            )
            for d in data
        ]

    def ranked(self, block: str, found: list) -> list[tuple[float, int]]:
        """Share of the compressed size that each template saves in the best window of the block, the largest first.

        Windows have twice the template's length and overlap by half. The share only ranks; left out are
        templates alone of whose words too few occur in ``found`` at all, in whatever order.
        """
        data, have = block.lower().encode("utf-8", "replace"), Counter(w for w, _, _ in found)
        gains = []
        for i, (compressor, length) in enumerate(zip(self.conditional, self.lengths)):
            if (self.counts[i] & have).total() < (1 - self.tolerance) * len(self.templates[i].words):
                continue
            windows = (data[k : k + 2 * length] for k in range(0, max(1, len(data) - length), length))
            gains.append((max(1 - len(compressor.compress(w)) / len(self.plain.compress(w)) for w in windows), i))
        return sorted(gains, key=lambda g: (-g[0], g[1]))

    def differences(self, template: Template, found: list) -> tuple[int, list[str], int, int] | None:
        """Exact differences between the template's words and the best run of words, or None if too many."""
        words = [w for w, _, _ in found]
        longest = SequenceMatcher(None, template.words, words, autojunk=False).find_longest_match()
        # The rest of the wording lies around its longest run that is found word for word.
        slack, at = int(self.tolerance * len(template.words)) + 1, longest.b - longest.a
        lo, hi = max(0, at - slack), max(0, at + len(template.words) + slack)
        blocks = [m for m in SequenceMatcher(None, template.words, words[lo:hi], autojunk=False).get_matching_blocks() if m.size]
        if not blocks or sum(m.size for m in blocks) < (1 - self.tolerance) * len(template.words):
            return None
        begin, end = lo + blocks[0].b, lo + blocks[-1].b + blocks[-1].size
        out = []
        for tag, i1, i2, j1, j2 in SequenceMatcher(None, template.words, words[begin:end], autojunk=False).get_opcodes():
            if tag != "equal":
                out += [f"-{w}" for w in template.words[i1:i2]] + [f"+{w}" for w in words[begin + j1 : begin + j2]]
        if len(out) > self.tolerance * len(template.words):
            return None
        return len(out), out, begin, end

    def scan(self, text: str | None) -> list[tuple]:
        """``(license, start, end, reduction, n_differences, differences)`` in the order of the text."""
        results = []
        for start, end in candidate_blocks(text or ""):
            block, left = text[start:end], wording(text[start:end], start)
            while left:
                confirmed = None
                for gain, i in self.ranked(block, left):
                    if near := self.differences(self.templates[i], left):
                        # Of templates within reach, the closest wording wins; ties go to the larger reduction.
                        share = near[0] / len(self.templates[i].words)
                        rank = (-(len(self.templates[i].words) - near[0]), share, -gain)
                        if confirmed is None or rank < confirmed[0]:
                            confirmed = (rank, gain, i, near)
                if confirmed is None:
                    break
                _, gain, i, (n, out, a, b) = confirmed
                results.append((self.templates[i].name, left[a][1], left[b - 1][2], gain, n, " ".join(out)))
                left = left[:a] + left[b:]
                block = " ".join(w for w, _, _ in left)
        return sorted(results, key=lambda r: (r[1], r[2], r[0]))


RESULT = "license string, start int, end int, reduction double, n_differences int, differences string"


def scan_licenses(docs: DataFrame, templates: tuple = TEMPLATES, tolerance: float = 0.1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per license wording found in ``docs``: its id (``doc_id``) and the columns of ``RESULT``.

    Windows of the candidate blocks are compressed with and without each template as a zstandard raw dictionary;
    templates are tried by the size they save, whatever it is, and one is confirmed by its exact differences in words: at most
    ``tolerance`` of its length (so none in a notice of under ten words). The confirmed words are taken out
    and the rest of the block is tried again, so a block may hold several wordings. ``start`` and ``end``
    are places in the whole text.

    Rows are independent, so nothing is shuffled. Null and empty texts and those without a license give no
    row; repeated rows give repeated results; an empty table gives no rows.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, tolerance)
        columns = ["doc_id", *(c.split()[0] for c in RESULT.split(", "))]
        for rows in batches:
            found = [(doc, *hit) for doc, t in zip(rows["doc_id"], rows["text"]) for hit in scanner.scan(t)]
            yield pd.DataFrame(found, columns=columns)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(scan, f"doc_id {docs.schema[key].dataType.simpleString()}, {RESULT}")
