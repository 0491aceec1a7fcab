"""Licence texts and notices in documents, by word bigrams they share with templates."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from pursewatch.llm import words

LEAST = 0.85

# Notices and licence texts as their publishers word them, without holders' names.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:"
)
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software."
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
    "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
#: (licence, text); a licence may have several templates.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", f"{_MIT_GRANT} {_MIT_NOTICE} {_MIT_WARRANTY}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-2-Clause", f"{_BSD_TERMS} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_WARRANTY}"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("all-rights-reserved", "All rights reserved."),
)

_OTHER = re.compile(r"[\W_]+")
UNITS = ("text", "paragraph", "line")
#: A match inside another is not told again if so much of its template is in the other's too.
RELATED = 0.5


def normal(word: str) -> str:
    return _OTHER.sub("", word.lower())


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words of all texts, and where each text's begin."""
    found, starts = words.split(texts)
    coded = found.dictionary_encode()
    known = [normal(w) for w in coded.dictionary.to_pylist()]
    hashed = np.fromiter((words.xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
    if not len(found):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    full = np.array([bool(w) for w in known])[coded.indices.to_numpy()]
    word = hashed[coded.indices.to_numpy()[full]]
    return word, np.concatenate([[0], np.cumsum(full)])[starts]


def _bigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word bigrams of each text in order, and where each text's begin.

    A single word counts as a bigram of its own.
    """
    word, starts = _words(texts)
    at, text = words.run_starts(starts, 2)
    pair = words.runs(word, 2)[at] if len(at) else np.zeros(0, np.uint64)
    single = np.flatnonzero(np.diff(starts) == 1)
    pair = np.concatenate([pair, words.mix(word[starts[single]])])
    text = np.concatenate([text, single])
    order = np.lexsort((pair, text))
    pair, text = pair[order], text[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])
    pair, text = pair[new], text[new]
    return pair, np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(starts) - 1))]).astype(np.int64)


class _Kept:
    """Matches of one text by the stretches of words they lie in: a match is about as long as its
    template, so it lies in few, and only neighbours are looked at."""

    STRETCH = 64

    def __init__(self) -> None:
        self.of: dict[int, list[tuple[int, int, int]]] = defaultdict(list)

    def add(self, template: int, first: int, last: int) -> None:
        for k in range(first // self.STRETCH, last // self.STRETCH + 1):
            self.of[k].append((template, first, last))

    def near(self, first: int, last: int) -> Iterator[tuple[int, int, int]]:
        for k in range(first // self.STRETCH, last // self.STRETCH + 1):
            yield from self.of.get(k, ())


@dataclass
class Templates:
    """Bigram sets of the templates, in the order of their sizes, and which templates hold a bigram."""

    names: list[str]
    sizes: np.ndarray
    pairs: np.ndarray  # every bigram of a template, sorted
    owner: np.ndarray
    of_template: list[set[int]]

    @staticmethod
    def of(templates: Sequence[tuple[str, str]]) -> Templates:
        pair, starts = _bigrams(pa.array([t for _, t in templates], pa.large_string()))
        size = np.diff(starts)
        order = np.argsort(size, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        owner = np.repeat(rank, size)
        by_pair = np.argsort(pair, kind="stable")
        own = [set(pair[starts[k] : starts[k + 1]].tolist()) for k in order]
        return Templates([templates[k][0] for k in order], size[order], pair[by_pair], owner[by_pair], own)

    def match(self, units: pa.Array, least: float) -> tuple[np.ndarray, np.ndarray]:
        """For each unit its best Dice coefficient (0 if under ``least``) and that template.

        Dice of sets of a and b bigrams is 2 x shared / (a + b), so b must lie between
        a x least / (2 - least) and a x (2 - least) / least: only units whose size some template
        allows are looked at, and of those only templates within the bounds.
        """
        pair, starts = _bigrams(units)
        size = np.diff(starts)
        best, which = np.zeros(len(size)), np.full(len(size), -1)
        small = np.searchsorted(self.sizes, np.ceil(size * least / (2 - least) - 1e-9))
        large = np.searchsorted(self.sizes, np.floor(size * (2 - least) / least + 1e-9), "right")
        unit = np.repeat(np.arange(len(size)), size)
        open_ = ((large > small) & (size > 0))[unit]
        pair, unit = pair[open_], unit[open_]
        begin = np.searchsorted(self.pairs, pair)
        count = np.searchsorted(self.pairs, pair, "right") - begin
        hit_unit = np.repeat(unit, count)
        nth = np.arange(len(hit_unit)) - np.repeat(np.cumsum(count) - count, count)
        template = self.owner[np.repeat(begin, count) + nth]
        inside = (template >= small[hit_unit]) & (template < large[hit_unit])
        both, shared = np.unique(hit_unit[inside] * len(self.sizes) + template[inside], return_counts=True)
        u, t = both // max(len(self.sizes), 1), both % max(len(self.sizes), 1)
        dice = 2 * shared / (size[u] + self.sizes[t])
        # of a unit's templates the last one written stays: highest Dice, then first by size
        order = np.lexsort((-t, dice))
        order = order[dice[order] >= least]
        best[u[order]], which[u[order]] = dice[order], t[order]
        return best, which

    def _windows(self, pairs: list[int], starts: list[int], t: int, least: float) -> Iterator[tuple]:
        """For each start the best window of bigrams: Dice, template, first and last word.

        The best window begins and ends with bigrams of the template. One that holds its first
        bigram again is no better than the one that begins there, and ``2 n (1 - least) / least``
        foreign bigrams are the most that n of the template can make up for.
        """
        own, n = self.of_template[t], int(self.sizes[t])
        most = 2 * n * (1 - least) / least + 1e-9
        for a in starts:
            shared, foreign, best = {pairs[a]}, set(), (0.0, 0)
            for b in range(a, len(pairs)):
                pair = pairs[b]
                if pair in own:
                    if b > a and pair == pairs[a]:
                        break
                    shared.add(pair)
                    dice = 2 * len(shared) / (len(shared) + len(foreign) + n)
                    if dice > best[0]:
                        best = (dice, b)
                else:
                    foreign.add(pair)
                    if len(foreign) > most:
                        break
            if best[0] >= least:
                yield best[0], t, a, best[1] + 1

    def passages(self, texts: pa.Array, least: float) -> dict[int, list[tuple]]:
        """Windows of words anywhere in a text that match a template: Dice, template, first and last word.

        Only texts that hold enough of a template's bigrams are read: Dice of ``least`` takes
        n x least / (2 - least) of its n. Templates of one word are left to the units.
        """
        word, starts = _words(texts)
        at, doc = words.run_starts(starts, 2)
        if not len(at):
            return {}
        pair = words.runs(word, 2)[at]
        begin = np.searchsorted(self.pairs, pair)
        hits = np.flatnonzero(self.pairs[np.minimum(begin, len(self.pairs) - 1)] == pair) if len(self.pairs) else at[:0]
        begin = begin[hits]
        count = np.searchsorted(self.pairs, pair[hits], "right") - begin
        hit = np.repeat(hits, count)
        entry = np.arange(len(hit)) + np.repeat(begin - np.cumsum(count) + count, count)
        n, size = len(self.sizes), len(self.pairs)
        each = np.unique(doc[hit] * size + entry)
        both, shared = np.unique(each // size * n + self.owner[each % size], return_counts=True)
        both = both[shared >= self.sizes[both % n] * least / (2 - least) - 1e-9]
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        found: dict[int, list[tuple]] = {}
        for d, t in zip((both // n).tolist(), (both % n).tolist(), strict=True):
            pairs = pair[first[d] : first[d + 1]].tolist()
            own = [k for k, p in enumerate(pairs) if p in self.of_template[t]]
            found.setdefault(d, []).extend(self._windows(pairs, own, t, least))
        return found

    def _told(self, kept: _Kept, t: int, first: int, last: int) -> bool:
        """Whether a match lies by half or more in one of a template with much of the same words."""
        own = self.of_template[t]
        return any(
            2 * (min(last, z) - max(first, a) + 1) >= last - first + 1
            and len(own & self.of_template[u]) >= RELATED * len(own)
            for u, a, z in kept.near(first, last)
        )

    def scan(self, texts: pa.Array, least: float) -> list[list[dict]]:
        """For each text its matches in order: the whole text, paragraphs, lines, other passages."""
        found: list[list[dict]] = [[] for _ in range(len(texts))]
        kept: dict[int, _Kept] = defaultdict(_Kept)
        lists = {
            "paragraph": pc.split_pattern_regex(texts, r"\n[ \t\r]*\n"),
            "line": pc.split_pattern(texts, "\n"),
        }
        for kind in UNITS:
            if kind == "text":
                units, doc = texts, np.arange(len(texts))
                before = doc
            else:
                at = lists[kind].offsets.to_numpy().astype(np.int64)
                units = lists[kind].values[at[0] : at[-1]]
                # a text that is one unit has been compared whole
                count = np.diff(at)
                doc = np.repeat(np.arange(len(texts)), count)
                several = (count > 1)[doc]
                units, doc = units.filter(pa.array(several)), doc[several]
                # the first unit of each unit's text
                before = np.searchsorted(doc, doc)
            dice, which = self.match(units, least)
            word_at = _words(units)[1]
            for k in np.flatnonzero(which >= 0):
                found[doc[k]].append({"license": self.names[which[k]], "dice": float(dice[k]), "unit": kind})
                begin = word_at[before[k]]
                kept[int(doc[k])].add(int(which[k]), int(word_at[k] - begin), int(word_at[k + 1] - begin) - 1)
        for d, windows in self.passages(texts, least).items():
            new = []
            # the best first, of equal ones the longer template, then the earlier place
            for dice, t, first, last in sorted(windows, key=lambda w: (-w[0], -w[1], w[2])):
                if not self._told(kept[d], t, first, last):
                    kept[d].add(t, first, last)
                    new.append((first, last, {"license": self.names[t], "dice": dice, "unit": "passage"}))
            found[d] += [match for *_, match in sorted(new, key=lambda m: m[:2])]
        return found


MATCHES = T.ArrayType(
    T.StructType(
        [T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("unit", T.StringType())]
    )
)


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    text_col: str = "text",
    least: float = LEAST,
) -> DataFrame:
    """The rows with a column ``licenses``: licence, Dice coefficient and unit of each match.

    A unit is the whole text, a paragraph or a line; its best template counts if the Dice
    coefficient over distinct word bigrams is ``least`` or more. Unit ``passage`` is any other run
    of words with such a coefficient, across lines and paragraphs or inside one: the best of those
    that overlap, unless a match of a similar template already covers half of it. Words are lower
    case, letters and digits only; one word alone counts as a unit's bigram. Every unit of every text is compared; nothing
    is shuffled. The templates are a fixed list that goes to the tasks. Null, empty and wordless
    texts match nothing. A column named licenses is replaced; other columns stay as they are.
    """
    index = Templates.of([t for t in templates if any(normal(w) for w in t[1].split())])
    rows = docs.drop("licenses")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]).add("licenses", MATCHES)
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("unit", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text_col):
                texts = pc.fill_null(part.column(text_col).cast(pa.large_string()), "")
                yield part.append_column("licenses", pa.array(index.scan(texts, least), kind))

    return rows.mapInArrow(run, schema)
