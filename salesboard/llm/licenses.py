"""License scan by patience alignment.

Texts and license templates are cut into words (lower case, letters and digits).
A stretch that covers at least ``COVERAGE`` of a template must contain one of the
template's few rarest words in that text; around each such word the stretch is
aligned with the template: words that are unique to both sides are anchors, the
longest increasing run of anchors is kept, and the gaps between anchors are
aligned the same way, down to gaps with no unique word, where equal ends match.
The share of template words aligned is the coverage.  In notices and headers the
name and version are the license: their words must stand in the stretch one after
the other, and a version must not go on (2 is not 2.1); coverage speaks for the rest.
Of templates of one kind that fit the same stretch (versions, clauses), the best fit
is reported; where several fit it alike, one row names them all, joined by `` | ``.

Edge cases: null and empty texts have no words and no license; a license found
several times in a text gives a row each, also where copies stand side by side;
repeated document rows are each scanned; texts are scanned whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from importlib.resources import files
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import Tokens, map_rows, text_slices, whole_text
from salesboard.llm.decontam import WORD, words

#: Share of a template's words that must align, and of the stretch's words that must belong to the template.
COVERAGE, DENSITY = 0.8, 0.6

_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by "
        "the Free Software Foundation, either {} of the License, or (at your option) any later version.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
          "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
          "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
          "THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
                   "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
                   "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
                   "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
                   "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
                   "POSSIBILITY OF SUCH DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
              "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that "
              "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
              "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
              "relinquishment in perpetuity of all present and future rights to this software under copyright law.")
#: Whole texts in ``license_texts``, and identifiers that stand in SPDX lines.
WHOLE = ("apache-2.0", "gpl-1.0", "gpl-2.0", "gpl-3.0", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0", "mpl-1.1", "mpl-2.0", "cc0-1.0")
SPDX = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "0BSD", "Zlib", "BSL-1.0", "MPL-2.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0",
        "CC-BY-SA-4.0", "CC-BY-NC-4.0", *(f"{k}-{v}" for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for v in ("only", "or-later")))

# Public license texts and notices (fixed values); the last word of a name is its kind.
TEMPLATES = {
    "apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                         "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                         "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "cc-by-nc-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl header": _GNU.format("", "version 3"),
    "mit notice": "Released under the MIT License.",
    "mit text": _MIT,
    "bsd text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
                "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "mpl-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                      "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "gpl-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "agpl-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd notice": "Released under the BSD License.",
    "isc notice": "Released under the ISC License.",
    "cc-by-sa-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0 header": _GNU.format("", "version 2"),
    "lgpl-3.0 header": _GNU.format("Lesser ", "version 3"),
    "lgpl-2.1 header": _GNU.format("Lesser ", "version 2.1"),
    "agpl-3.0 header": _GNU.format("Affero ", "version 3"),
    "mit whole text": f"{_MIT} {_AS_IS}",
    "bsd-2-clause text": f"{_BSD} {_BSD_DISCLAIMER}",
    "bsd-3-clause text": f"{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                         f"derived from this software without specific prior written permission. {_BSD_DISCLAIMER}",
    "isc text": _ISC,
    "unlicense text": _UNLICENSE,
    **{f"{name} text": files("salesboard.llm").joinpath(f"license_texts/{name}.txt").read_text() for name in WHOLE},
    **{f"{name.lower()} spdx": f"SPDX-License-Identifier: {name}" for name in SPDX},
}


def _versions(name: str, number: str) -> list[str]:
    return [f"{name} {v}{number}" for v in ("version ", "v", "v ", "")]


# What notices and headers must name (fixed values): of each list, one phrase must stand in the stretch as it is.
NAMED = {
    "apache-2.0 notice": [_versions("Apache License", "2.0")],
    "apache-2.0 header": [_versions("Apache License", "2.0")],
    "cc-by-nc-4.0 notice": [["CC BY-NC 4.0"]],
    "cc-by-sa-4.0 notice": [["CC BY-SA 4.0"]],
    "cc-by-4.0 notice": [["Creative Commons Attribution 4.0"]],
    "gpl-2.0 notice": [_versions("GNU General Public License", "2")],
    "gpl-3.0 notice": [_versions("GNU General Public License", "3")],
    "lgpl-2.1 notice": [_versions("GNU Lesser General Public License", "2.1")],
    "lgpl-3.0 notice": [_versions("GNU Lesser General Public License", "3")],
    "agpl-3.0 notice": [_versions("GNU Affero General Public License", "3")],
    "mit notice": [["MIT License"]],
    "bsd notice": [["BSD License"]],
    "isc notice": [["ISC License"]],
    "gpl-2.0 header": [["GNU General Public License"], ["version 2"]],
    "gpl header": [["GNU General Public License"], ["version 3"]],
    "lgpl-2.1 header": [["GNU Lesser General Public License"], ["version 2.1"]],
    "lgpl-3.0 header": [["GNU Lesser General Public License"], ["version 3"]],
    "agpl-3.0 header": [["GNU Affero General Public License"], ["version 3"]],
    "mpl-2.0 header": [_versions("Mozilla Public License", "2.0")],
}


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first number, whose second numbers increase (patience sorting)."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(last[pile - 1] if pile else -1)
        tops[pile:pile + 1], last[pile:pile + 1] = [b], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Matched places ``(text, template)`` of a patience alignment, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and text[a] == template[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        here, there = Counter(text[a:a_end]), Counter(template[b:b_end])
        place = {w: k for k, w in enumerate(template[b:b_end], b) if there[w] == 1}
        anchors = increasing([(k, place[w]) for k, w in enumerate(text[a:a_end], a) if here[w] == 1 and w in place])
        out += anchors
        if anchors:
            edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
            todo += [(p + 1, x, q + 1, y) for (p, q), (x, y) in zip(edges, edges[1:]) if x > p + 1 and y > q + 1]
    return sorted(out)


def dense(matched: list[tuple[int, int]], need: int) -> list[tuple[int, int]]:
    """The longest run of at least ``need`` matches that is dense enough: stray matches at either end go."""
    at = np.array([a for a, _ in matched])
    if len(at) >= DENSITY * (at[-1] - at[0] + 1):
        return matched
    firsts, lasts = np.arange(len(at) - need + 1)[:, None], np.arange(need - 1, len(at))[None, :]
    n = lasts - firsts + 1
    n = np.where((n >= need) & (n >= DENSITY * (at[lasts] - at[firsts] + 1)), n, 0)
    i, j = np.unravel_index(n.argmax(), n.shape)
    return matched[i:need + j] if n[i, j] else []


def named(phrases: list[list[list[str]]], text: str, first: int, last: int) -> bool:
    """Whether of each list of ``phrases`` one begins in the words ``first:last`` of ``text`` and goes on as it is."""
    lower = text.lower()
    spans = list(islice((m.span() for m in WORD.finditer(lower)), first, last + max(len(w) for p in phrases for w in p)))
    held = [lower[a:b] for a, b in spans]

    def stands(phrase: list[str], k: int) -> bool:
        end = k + len(phrase)
        if held[k:end] != phrase:
            return False
        further = end < len(held) and phrase[-1][-1].isdigit() and held[end].isdigit() and lower[spans[end - 1][1]:spans[end][0]] == "."
        return not further

    return all(any(stands(w, k) for w in p for k in range(min(last - first, len(held)))) for p in phrases)


def best(found: list[tuple]) -> list[tuple]:
    """Of finds ``(name, first, last, matched, words)`` of one kind that share most of a stretch, those that fit best.

    Finds that fit a stretch alike become one, whose name lists theirs.
    """
    kept: list[tuple] = []
    rank = lambda f: (-f[3] / f[4], -f[3])
    for f in sorted(found, key=lambda f: (*rank(f), f[0], f[1])):
        rivals = [i for i, k in enumerate(kept) if k[0].split()[-1] == f[0].split()[-1] and 2 * (min(k[2], f[2]) - max(k[1], f[1])) > min(k[2] - k[1], f[2] - f[1])]
        if not rivals:
            kept.append(f)
        elif rank(kept[rivals[0]]) == rank(f):
            kept[rivals[0]] = (f"{kept[rivals[0]][0]} | {f[0]}", *kept[rivals[0]][1:])
    return kept


def find(text: list, template: list, places: dict, coverage: float = COVERAGE) -> list[tuple[int, int, int]]:
    """``(first word, word after the last, words matched)`` of every stretch that covers the template.

    ``places`` has the positions in ``text`` of each template word that occurs in it.
    """
    n, need = len(template), int(np.ceil(coverage * len(template)))
    if sum(w in places for w in template) < need:
        return []
    # at most n - need template words are missing from a stretch, so one of any n - need + 1 of them is there
    rarest = sorted(range(n), key=lambda q: (len(places.get(template[q], ())), q))[:n - need + 1]
    reach = int(n / DENSITY) - n + 1
    spans = sorted({(max(0, p - q - reach), min(len(text), p + n - q + reach)) for q in rarest for p in places.get(template[q], ())})
    there = Counter(template)
    found: list[tuple[int, int, int]] = []
    done = clear = 0  # every window that ends before ``clear`` holds too few words
    for begin, end in spans:
        if end < clear:
            continue
        begin = max(begin, done)
        while end - begin >= need:
            # common words in any order bound what can align; a window further on has at most its new words more
            most = sum(min(k, there[w]) for w, k in Counter(text[begin:end]).items())
            if most >= need:
                matched = align(text[begin:end], template)
                most = len(matched)
            if most < need:
                clear = end + need - most
                break
            if not (matched := dense(matched, need)):
                break
            first = begin + matched[0][0]
            # the window may end inside this copy: from its first word on, there is room for the whole template
            whole = align(text[first:first + n + reach], template)
            if len(whole) > len(matched) and (whole := dense(whole, need)) and len(whole) > len(matched):
                matched, first, begin = whole, first + whole[0][0], first
            last = begin + matched[-1][0] + 1
            found.append((first, last, len(matched)))
            begin = done = last
    return found


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, first_word, last_word, n_matched, n_words, coverage``: every license found in every text."""
    cut = {name: words(t) for name, t in templates.items()}
    phrases = {name: [[words(x) for x in p] for p in NAMED[name]] for name in cut if name in NAMED}
    names, exact = list(cut), {name for name in cut if name.endswith(" spdx")}  # an identifier has no near match
    need = np.array([len(t) * (1 if name in exact else coverage) for name, t in cut.items()])
    known = {w: k for k, w in enumerate(sorted({w for t in cut.values() for w in t}))}
    weight = np.zeros((len(known) + 1, len(cut)), np.int32)  # places of each word in each template; the last row is of no word
    for j, t in enumerate(cut.values()):
        for w, n in Counter(t).items():
            weight[known[w], j] = n

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, ids, k = [], batch["doc_id"].to_pylist(), 0
            for texts in text_slices(batch["text"]):
                tokens = Tokens([words(t) for t in texts], pa.string())
                own = np.array([known.get(w, len(known)) for w in tokens.distinct], np.int64)
                hits = np.flatnonzero(own[tokens.codes] < len(known)) if len(own) else np.zeros(0, np.int64)
                cuts = np.searchsorted(hits, tokens.at)
                for j in range(len(texts)):
                    base, here = tokens.at[j], hits[cuts[j]:cuts[j + 1]]
                    held = np.flatnonzero(weight[own[np.unique(tokens.codes[here])]].sum(axis=0) >= need) if len(here) else ()
                    if len(held):
                        places, found = defaultdict(list), []
                        for p in here.tolist():
                            places[tokens.distinct[tokens.codes[p]]].append(p - base)
                        text = [tokens.distinct[c] for c in tokens.codes[base:tokens.at[j + 1]]]
                        for name in (names[h] for h in held):
                            t = cut[name]
                            spans = find(text, t, places, 1.0 if name in exact else coverage)
                            found += [(name, a, b, m, len(t)) for a, b, m in spans
                                      if (name not in exact or b - a == m) and (name not in phrases or named(phrases[name], texts[j], a, b))]
                        out += [(ids[k], *f) for f in best(found)]
                    k += 1
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "license", "first_word", "last_word", "n_matched", "n_words"])
        return fn

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = map_rows(rows, start, "doc_id long, license string, first_word long, last_word long, n_matched long, n_words long")
    return found.withColumn("coverage", F.col("n_matched") / F.col("n_words"))
