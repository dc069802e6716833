"""License scans by conditional compression, confirmed by wording.

1. **Candidate blocks.**  A text's lines and sentences that hold a licensing word, with
   ``GAP`` more units on both sides, are joined where they touch.  Whole texts are
   searched; a text without any such word is passed over by a JVM-side test.
2. **Stretches.**  Every template of which a block holds enough words for ``min_share``
   (an exact bound, whatever the block's length) is aligned with it: a word found in
   order counts ``FOUND``, a word of the template left out ``-LOST``, a
   word put in ``-EXTRA``, a word in place of fill-ins ``-FILL``.  A stretch that can be the template's notice is a
   best alignment with a count above 0 and at least ``min_share`` of the template's words
   found, so its other words are fewer than twice the words found less those left out.
   Long blocks are aligned in windows that overlap by the longest possible notice.
   A template keeps its best stretches that don't overlap.
3. **Conditional compression.**  Every stretch is compressed with zstandard alone, and with
   its template as a raw-content dictionary.  The bytes that the template saves rank all
   stretches of the block, and decide between templates where stretches overlap: a template that
   holds a stretch's wording as it stands saves more than one that shares its words.
4. **Confirmation.**  Winners are taken in that order, with their exact differences; then what is
   left between the notices is searched again, until nothing more is confirmed.  Every
   notice of a block is a row with its own span.

A run of fill-in words of a template (``<year> <owner>``) matches any non-empty run of
words: up to ``FOUND / FILL`` words for every template word found less those left out.
The exact differences (words left out, put in, or replaced) are reported.

The templates are short public notices and can be replaced.

Edge cases: null and empty texts have no blocks; a block that no template explains
gives no row; equal savings go to the larger count, then to the template that comes
first; repeated rows give repeated results; null ids are kept; an empty table gives an
empty result; other columns aren't read.
"""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import slices, string_column

GAP = 2
MIN_SHARE = 0.8
LEVEL = 19
FOUND, LOST, EXTRA, FILL = 16, 16, 8, 1
WINDOW = 1 << 16
ANCHOR = r"(?i)licen[cs]e|copyright|spdx|permission is hereby|redistribution|warrant(?:y|ies)|public domain|creative commons"
UNIT = re.compile(r"[^\n]+?(?:[.;!?](?=\s)|$)|[^\n]+", re.M)

# Public notices (fixed values): name and wording.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
                "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
                "included in all copies or substantial portions of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                         "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
                         "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                      "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
                      "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                      "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                    "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work. Public domain.",
    "Copyright": "Copyright (c) <year> <owner>. All rights reserved.",
}
WORD = re.compile(r"[^\W_]+(?:\.\d+)*|<\w+>")


def tokens(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def blocks(text: str) -> list[tuple[int, int]]:
    """The candidate blocks of a text: its hits with ``GAP`` more units on both sides
    (for notices whose ends hold no such word), joined where they touch."""
    anchors = [m.start() for m in _ANCHOR.finditer(text)]
    if not anchors:
        return []
    units = [m.span() for m in UNIT.finditer(text)]
    begins = np.array([a for a, _ in units])
    hits = np.unique(np.searchsorted(begins, anchors, "right") - 1)
    cut = np.flatnonzero(np.diff(hits) > 2 * GAP + 1)
    return [(units[max(0, hits[a] - GAP)][0], units[min(len(units) - 1, hits[b] + GAP)][1])
            for a, b in zip(np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(hits) - 1]]))]


_ANCHOR = re.compile(ANCHOR)
# an alignment is one number: its count, then the words found, then its first word
_COUNT, _WORDS, _LOW = 40, 20, (1 << 20) - 1


class Templates:
    def __init__(self, templates: dict[str, str]):
        import zstandard

        self.names = list(templates)
        self.words = [tokens(t) for t in templates.values()]
        self.ids = {w: k for k, w in enumerate(dict.fromkeys(w for t in self.words for w in t if w[0] != "<"))}
        # (word, 1), or (None, length) of a run of fill-ins
        self.items = [[x for blank, run in groupby(t, lambda w: w[0] == "<")
                       for x in ([(None, len(list(run)))] if blank else [(self.ids[w], 1) for w in run])] for t in self.words]
        self.times = [np.bincount([self.ids[w] for w in t if w[0] != "<"], minlength=len(self.ids)) for t in self.words]
        self.blanks = [sum(w[0] == "<" for w in t) for t in self.words]
        plain = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.alone = zstandard.ZstdCompressor(compression_params=plain)
        self.given = [zstandard.ZstdCompressor(compression_params=plain, dict_data=zstandard.ZstdCompressionDict(
            t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for t in templates.values()]

    def sizes(self, notice: str, i: int) -> tuple[int, int]:
        """Compressed bytes of a notice alone and given template ``i``."""
        data = notice.lower().encode("utf-8", "surrogatepass")
        return len(self.alone.compress(data)), len(self.given[i].compress(data))

    def align(self, i: int, have: np.ndarray) -> list[np.ndarray]:
        """Best alignments of the template's first words that end before each word:
        one row per item of the template, after a row of the possible first words."""
        at = np.arange(len(have) + 1, dtype=np.int64)
        one, step = (FOUND << _COUNT) + (1 << _WORDS), at * (EXTRA << _COUNT)
        rows = [at]
        for word, k in self.items[i]:
            row, new = rows[-1], rows[-1] - (k * LOST << _COUNT)
            if word is None:
                fill = at * (FILL << _COUNT)
                new[1:] = np.maximum(new[1:], np.maximum.accumulate(row + fill)[:-1] - fill[1:] + k * one)
            else:
                new[1:] = np.where(have == word, np.maximum(new[1:], row[:-1] + one), new[1:])
            rows.append(np.maximum.accumulate(new + step) - step)
        return rows

    def differences(self, i: int, words: list[str]) -> list[str]:
        """Exact differences of a notice from its template."""
        have = np.array([self.ids.get(w, -1) for w in words], np.int64)
        rows, want = self.align(i, have), list(self.words[i])
        one, j, r = (FOUND << _COUNT) + (1 << _WORDS), len(words), len(rows) - 1
        lost, extra, notes = [], [], []

        def note():
            if lost or extra:
                notes.append(f"-{' '.join(reversed(lost))} +{' '.join(reversed(extra))}")
            lost.clear(), extra.clear()

        while r:
            word, k = self.items[i][r - 1]
            v, before = rows[r][j], rows[r - 1]
            starts = np.flatnonzero(before[:j] - ((j - np.arange(j)) * FILL << _COUNT) + k * one == v) if word is None else ()
            if len(starts):
                note()
                r, j = r - 1, int(starts[-1])
                del want[-k:]
            elif word is not None and j and have[j - 1] == word and v == before[j - 1] + one:
                note()
                r, j = r - 1, j - 1
                del want[-1]
            elif v == before[j] - (k * LOST << _COUNT):
                lost.extend(reversed(want[-k:]))
                r -= 1
                del want[-k:]
            else:
                j -= 1
                extra.append(words[j])
        note()
        return notes[::-1]

    def candidates(self, have: np.ndarray, min_share: float) -> list[tuple[int, int, int, int, int]]:
        """(-count, template, first word, end, words found) of all confirmed alignments."""
        out, held = [], np.bincount(have[have >= 0], minlength=len(self.ids))
        for i, want in enumerate(self.words):
            need = min_share * len(want) - 1e-9
            if np.minimum(held, self.times[i]).sum() + self.blanks[i] < need:
                continue
            longest = len(want) * (1 + FOUND // (FILL if self.blanks[i] else EXTRA))  # words of a notice whose count is above 0
            for a in range(0, len(have), WINDOW):
                v = self.align(i, have[a:a + WINDOW + longest])[-1]
                count, found = v >> _COUNT, (v >> _WORDS) & _LOW
                ok = (count > 0) & (found >= need)
                ok[1:] &= v[1:] > v[:-1] - (EXTRA << _COUNT)  # ends with a word that isn't put in
                out += [(-int(count[j]), i, a + int(v[j] & _LOW), a + int(j), int(found[j])) for j in np.flatnonzero(ok)]
        return sorted(set(out))

    def notices(self, block: str, min_share: float):
        """(name, begin, end, reduction, share, differences) of every notice of a block."""
        spans = [m.span() for m in WORD.finditer(block)]
        words = [block[a:b].lower() for a, b in spans]
        have = np.array([self.ids.get(w, -1) for w in words], np.int64)
        parts, out = [(0, len(words))], []
        while parts:
            lo, hi = parts.pop()
            taken, ranked = [], []
            for i, own in groupby(sorted(self.candidates(have[lo:hi], min_share), key=lambda c: c[1]), lambda c: c[1]):
                used = np.zeros(hi - lo, bool)          # a template's best stretches, larger counts first
                for count, _, a, b, found in own:
                    if not used[a:b].any():
                        used[a:b] = True
                        begin, end = spans[lo + a][0], spans[lo + b - 1][1]
                        alone, given = self.sizes(block[begin:end], i)
                        ranked.append((given - alone, count, i, a, b, begin, end, found, 1 - given / alone))
            used = np.zeros(hi - lo, bool)
            for _, _, i, a, b, begin, end, found, reduction in sorted(ranked):       # most bytes saved first
                if not used[a:b].any():
                    used[a:b] = True
                    taken.append((lo + a, lo + b))
                    out.append((self.names[i], begin, end, reduction, found / len(self.words[i]), self.differences(i, words[lo + a:lo + b])))
            if taken:  # what is left is searched again
                edges = [lo, *(x for pair in sorted(taken) for x in pair), hi]
                parts += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
        return sorted(out, key=lambda x: x[1])


SCHEMA = "license string, begin int, length int, reduction double, share double, n_differences int, differences array<string>, block string"


def scan(docs: DataFrame, id_col: str, text_col: str, templates: dict[str, str] | None = None, min_share: float = MIN_SHARE) -> DataFrame:
    """(key, license, begin, length, reduction, share, n_differences, differences,
    block): one row per confirmed notice of every text (``block`` is its wording); positions in characters."""
    templates = templates or TEMPLATES
    own = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).filter(F.col("text").rlike(ANCHOR))

    def run(batches):
        known = None
        for batch in batches:
            known = known or Templates(templates)
            col, rows = string_column(batch.column("text")), []
            for a, b in slices(col):
                for i, text in enumerate(col.slice(a, b - a).to_pylist(), a):
                    for at, stop in blocks(text):
                        for name, begin, end, reduction, share, notes in known.notices(text[at:stop], min_share):
                            rows.append((i, name, at + begin, end - begin, reduction, share, len(notes), notes, text[at + begin:at + end]))
            cols = list(zip(*rows)) or [()] * 9
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], kinds))],
                                             ["key", "license", "begin", "length", "reduction", "share", "n_differences", "differences", "block"])

    return own.mapInArrow(run, f"key {own.schema['key'].dataType.simpleString()}, {SCHEMA}")
