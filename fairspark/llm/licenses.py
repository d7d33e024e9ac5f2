"""Licence notices by conditional compression, confirmed word by word.

Every template gives a few opening words, one of which stands in any wording close enough to it
(``openers``).  An opening word starts a candidate block: the text around it, line breaks or not, wide
enough for every notice that holds it or one of the next opening words.  The block is compressed alone
and with each template as a raw zstandard dictionary, and the templates are ranked by the bytes they
take off.  In that order, the place of a block that agrees best with the template is compared with it
word by word.  The place found is then a block of its own: it is compressed with every template again,
and the winner, of those whose words differ by at most ``MAX_DIFFERENT`` of the template's, is the notice.
What lies before and after it in the block is ranked anew, until no template that takes anything off is found.
Templates are taken by size, the longest first, each size with blocks of its own width, so that a short
notice is not lost in a long block.

A word of ``HINTS`` near no confirmed notice of its line gives a row too, not confirmed: its line and those
after it, up to the longest template, with the template that saves the largest share of it.

Defined results: null and empty texts and texts without an opening word give no row; each notice gives
one row, so repeated lines and repeated documents are reported each; templates whose reductions of a place
are within ``TIE`` bytes go by fewest different words, then by name; a template without a word is
never found; other columns are ignored.  A notice stretched (by blanks or comment marks) to more than twice
the characters of its size may be missed.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: fixed values: wording of common public notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: fixed values: identifiers that stand in short tags, and full wordings of short licences
SPDX_IDS = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "MIT", "MPL-2.0"]
FULL_TEXTS = {
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}
TEMPLATES |= FULL_TEXTS | {f"{k}-spdx": f"SPDX-License-Identifier: {k}" for k in SPDX_IDS}

#: Words that ask for a row even where no notice is found.
HINTS = r"(?i)licen[sc]|copyright|permission is|redistribut|creative commons|spdx"
#: Share of the template's words that may differ in a confirmed notice.
MAX_DIFFERENT = 0.15
#: Reductions (bytes) that count as equal, and characters of the smallest size of templates (each next one: four times).
TIE, LEAST_SIZE = 3, 128

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def openers(templates: Mapping[str, str]) -> list[str]:
    """Words of which every confirmed notice holds one.

    A notice may lack ``int(MAX_DIFFERENT * size)`` of a template's words, so one more different word than
    that is enough: long ones before short ones, and those that open most templates first.
    """
    words = {k: words_of(v) for k, v in templates.items()}
    uses = Counter(w for v in words.values() for w in set(v))
    out: set[str] = set()
    for k, v in sorted(words.items()):
        once = sorted(set(v), key=lambda w: (w not in out, len(w) < 6, len(w) < 4, w.isdigit(), -uses[w], -len(w), w))
        # a word that stands often costs a difference for each place, so distinct words are on the safe side
        out.update(once[:int(MAX_DIFFERENT * len(v)) + 1])
    return sorted(out)


def folded(text: str) -> str:
    """Lower case, with every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


class TemplateScanner:
    def __init__(self, templates: Mapping[str, str] = TEMPLATES):
        self.words = {k: words_of(v) for k, v in sorted(templates.items())}
        self.words = {k: v for k, v in self.words.items() if v}
        self.sizes: dict[int, list[str]] = {}  # characters: names of the templates up to that long
        for k in self.words:
            size = LEAST_SIZE
            while size < len(templates[k]):
                size *= 4
            self.sizes.setdefault(size, []).append(k)
        self.press = {k: zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
            templates[k].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k in self.words}
        self.plain = zstandard.ZstdCompressor(level=3)
        self.hints = re.compile(HINTS)
        self.openers = [(w, re.compile(re.escape(w))) for w in openers(templates)]
        self.longest = max([len(v) for v in templates.values()], default=0) + 40

    def notices(self, text: str) -> list[tuple]:
        """Result rows of the confirmed notices of a text, in its order."""
        low = folded(text)
        # a plain search for each word: most texts hold none
        starts = sorted({m.start() for w, find in self.openers if w in low for m in find.finditer(low)})
        out: list[tuple] = []
        for size in sorted(self.sizes, reverse=True) if starts else ():
            taken = [(r[0], r[0] + r[1]) for r in out]
            free = zip([0, *[b for _, b in taken]], [*[a for a, _ in taken], len(text)])
            found = [row for a, b in free if a < b
                     for row in self.of_size(text, a, b, starts[bisect_left(starts, a):bisect_left(starts, b)], size)]
            out = sorted(out + found)
        return out

    def of_size(self, text: str, a: int, b: int, starts: list[int], size: int) -> Iterator[tuple]:
        """The notices of the templates of one size in ``text[a:b]``, block by block."""
        reach = 2 * (size + 40)
        done, served = a, 0
        for start in starts:
            if start < max(done, served):
                continue
            # every notice with an opening word in [start, start + reach) lies in this block
            served = start + reach
            for row in sorted(self.in_block(text, max(done, start - reach), min(b, served + reach), self.sizes[size])):
                if row[0] < served:
                    done = row[0] + row[1]
                    yield row

    def in_block(self, text: str, a: int, b: int, names: list[str]) -> Iterator[tuple]:
        parts = [(a, b)]
        while parts:
            a, b = parts.pop()
            at = [x.span() for x in _WORD.finditer(text, a, b)]
            words = [text[i:j].lower() for i, j in at]
            for reduction, name in self.reductions(text[a:b], names):
                place = self.place(words, name) if reduction > 0 else None
                if place is not None:
                    start, end = at[place[0]][0], at[place[1] - 1][1]
                    yield self.winner(start, text[start:end])
                    parts += [(a, start), (end, b)]
                    break

    def reductions(self, block: str, names: Iterable[str] | None = None) -> list[tuple[int, str]]:
        """Templates (all, or ``names``) by the bytes they take off the compressed block, best first."""
        data = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        return sorted(((alone - len(self.press[k].compress(data)), k) for k in names or self.press), key=lambda x: (-x[0], x[1]))

    def place(self, words: list[str], name: str) -> tuple[int, int] | None:
        """First and end of the words that agree best with a template, if close enough to it."""
        want = self.words[name]
        size, slack = len(want), int(MAX_DIFFERENT * len(want))
        where: dict[str, list[int]] = {}
        for j, w in enumerate(want):
            where.setdefault(w, []).append(j)
        votes = Counter(i - j for i, w in enumerate(words) for j in where.get(w, ()))  # where it would start
        best = None
        for s in sorted(votes):
            # missing and extra words move the others by at most ``slack`` in all
            if sum(votes.get(s + d, 0) for d in range(slack + 1)) >= size - slack:
                first, last, same, different = self.align(words, max(0, s), s + slack + size, name)
                if different <= MAX_DIFFERENT * size and (best is None or (different, first) < best[:2]):
                    best = different, first, last
        return best and best[1:]

    def winner(self, start: int, block: str) -> tuple:
        """The row of a confirmed place: of the templates close enough to it, the one that takes off most."""
        near = []
        for reduction, name in self.reductions(block):
            missing, extra = self.differences(block, name)
            outside = len(words_of(block)) - (len(self.words[name]) - len(missing)) - len(extra)
            different = len(missing) + len(extra) + outside
            if different <= MAX_DIFFERENT * len(self.words[name]):
                near.append((reduction, different, name, missing, extra))
        best = max(x[0] for x in near)
        reduction, _, name, missing, extra = min((x for x in near if x[0] >= best - TIE), key=lambda x: x[1:3])
        return (start, len(block), name, self.saving(block, name), (len(missing) + len(extra)) / len(self.words[name]),
                missing, extra, True)

    def align(self, words: list[str], a: int, b: int, name: str) -> tuple[int, int, int, int]:
        """The words of ``words[a:b]`` that fit the template best: first, end, how many agree and differ."""
        got, want = words[a:b], self.words[name]
        runs = [m for m in difflib.SequenceMatcher(None, got, want, autojunk=False).get_matching_blocks() if m.size]
        best = (len(want), a, a, 0)
        for i in range(len(runs)):
            same = 0
            for m in runs[i:]:
                same += m.size
                extra = m.a + m.size - runs[i].a - same
                best = min(best, (len(want) - same + extra, a + runs[i].a, a + m.a + m.size, same))
        different, first, last, same = best
        return first, last, same, different

    def blocks(self, text: str, known: list[tuple]) -> Iterator[tuple[int, str]]:
        """Start (characters) and text of the blocks of hints without a notice near."""
        done = 0
        spans = sorted((r[0], r[0] + r[1]) for r in known)
        k = 0
        for m in self.hints.finditer(text):
            if m.start() < done:
                continue
            head = text.rfind("\n", 0, m.start()) + 1
            tail = text.find("\n", m.start())
            tail = len(text) if tail < 0 else tail
            # a very long line is read around its opening word
            near = max(head, m.start() - self.longest)
            far = min(tail, m.start() + self.longest)
            while k < len(spans) and spans[k][1] <= near:
                k += 1
            if k < len(spans) and spans[k][0] < far:
                done = max(m.end(), min(spans[k][1], tail))
                continue
            done = far
            size = tail - head
            yield near, text[near:near + 2 * self.longest] if size > 2 * self.longest else text[near:near + max(size, self.longest)]

    def rank(self, block: str) -> list[tuple[float, str]]:
        """Templates by the share of the compressed size that they save, best first."""
        alone = len(self.plain.compress(block.encode("utf-8", "surrogatepass")))
        return [(reduction / alone, k) for reduction, k in self.reductions(block)]

    def saving(self, block: str, name: str) -> float:
        data = block.encode("utf-8", "surrogatepass")
        return 1 - len(self.press[name].compress(data)) / len(self.plain.compress(data))

    def differences(self, block: str, name: str) -> tuple[list[str], list[str]]:
        """Words of the template that are missing, and words that stand between those found."""
        got, want = [w.lower() for w in _WORD.findall(block)], self.words[name]
        runs = [m for m in difflib.SequenceMatcher(None, got, want, autojunk=False).get_matching_blocks() if m.size]
        if not runs:
            return want, []
        found = {i for m in runs for i in range(m.b, m.b + m.size)}
        inside = {i for m in runs for i in range(m.a, m.a + m.size)}
        first, last = min(inside), max(inside)
        return [w for i, w in enumerate(want) if i not in found], [got[i] for i in range(first, last) if i not in inside]

    def scan(self, text: str) -> Iterator[tuple]:
        known = self.notices(text)
        yield from known
        if not self.words:
            return
        for start, block in self.blocks(text, known):
            # a block may be a short notice followed by text: its first line is a candidate of its own
            best = max(((*self.rank(part)[0], part) for part in dict.fromkeys((block.split("\n", 1)[0], block))),
                       key=lambda x: x[0])
            saving, name, part = best
            missing, extra = self.differences(part, name)
            yield (start, len(part), name, saving, (len(missing) + len(extra)) / len(self.words[name]), missing, extra, False)


SCHEMA = ("doc_id long, start long, length long, license string, saving double, different double, "
          "missing array<string>, extra array<string>, confirmed boolean")


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row per notice and per other candidate block of ``docs`` (doc_id, text)."""
    templates = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = TemplateScanner(templates)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(),
                 pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for b in batches:
            rows = [(doc.as_py(), *found) for doc, text in zip(b.column(0), b.column(1)) if text.is_valid
                    for found in scanner.scan(text.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
