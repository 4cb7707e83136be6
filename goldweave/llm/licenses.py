"""Licence texts in documents, by patience alignment with templates."""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from goldweave.llm.tables import id_type, schema, texts

_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions: The above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the Software. ")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
    "in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission. ")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(name: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the "
        f"GNU {name} as published by the Free Software Foundation, either version 3 of the License, or "
        f"(at your option) any later version. This program is distributed in the hope that it will be "
        f"useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        f"FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received "
        f"a copy of the GNU {name} along with this program. If not, see https://www.gnu.org/licenses/.")


# Whole texts of short public licences, and what stands for long ones in files.
# Lines that only refer to a licence are templates of their own, named -notice.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": _PERMISSION + (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "BSD-2-Clause": _BSD + _BSD_END,
    "BSD-3-Clause": _BSD + _BSD_NAMES + _BSD_END,
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."),
    "GPL-3.0-header": _gnu("General Public License"),
    "LGPL-3.0-header": _gnu("Lesser General Public License"),
    "AGPL-3.0-header": _gnu("Affero General Public License"),
}
COVERAGE = 0.8
#: A place has at most this many times the words of the template.
ROOM = 2

_WORD = re.compile(r"\w+")


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence: patience sorting with back pointers."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
        back.append(at[pile - 1] if pile else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, rising in both.

    Words that are unique in both stretches are anchors; those on a longest increasing
    subsequence are kept, and the gaps between them are aligned in the same way. A gap without
    anchors is matched from both of its ends.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a.get(w) == 1}
        common = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where]
        anchors = [common[k] for k in longest_increasing([j for _, j in common])]
        if not anchors:
            continue
        out += anchors
        for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def occurrences(words: list[str], template: list[str], coverage: float) -> list[tuple[int, int, int]]:
    """Where a template occurs: first word, last word and aligned words of each place.

    A place is a stretch of at most ``ROOM`` times the template's words in which enough of them
    are aligned; what else stands in it, and where, does not matter. From left to right every
    word that could be the first aligned one opens stretches of growing length. The best one from
    the first such word is the place, or a better one inside of it; the search goes on behind it.
    """
    n = len(template)
    need = max(1, -int(-coverage * n // 1))
    wanted = Counter(template)
    # Places of template words; the others only take up room.
    hits = [i for i, w in enumerate(words) if w in wanted]
    heads = set(template[:n - need + 1])
    lengths = sorted({n, *(min(ROOM * n, need + k * max(1, n // 8)) for k in range(8 * ROOM + 8))})

    def worth(place: tuple[int, int, int]) -> int:
        """Aligned words count twice, others against: a place does not reach into the next for a few."""
        return 3 * place[2] - (place[1] - place[0])

    def longest(start: int) -> tuple[int, int, int] | None:
        """The place that begins at a word, if there is one."""
        best = None
        for m in lengths:
            part = words[start:start + m]
            pairs = align(template, part)
            if len(pairs) >= need and pairs[0][1] == 0:
                found = (start, start + pairs[-1][1], len(pairs))
                best = found if best is None else max(best, found, key=worth)
            if len(part) < m or best and best[2] == n:
                break
        return best

    # For each hit how many of the template's words follow within the room, in any order.
    have: Counter[str] = Counter()
    held, stop, out, after, best = 0, 0, [], 0, None
    for k, i in enumerate(hits):
        while stop < len(hits) and hits[stop] < i + ROOM * n:
            w = words[hits[stop]]
            have[w] += 1
            held += have[w] <= wanted[w]
            stop += 1
        if best is not None and (i > best[1] or best[2] == n):
            out.append(best)
            after, best = best[1] + 1, None
        if i >= after and held >= need and words[i] in heads:
            found = longest(i)
            if found and (best is None or found[1] <= best[1] and worth(found) > worth(best)):
                best = found
        held -= have[words[i]] <= wanted[words[i]]
        have[words[i]] -= 1
    return out if best is None else [*out, best]


def scan_licenses(rows: DataFrame, templates: Mapping[str, str] = TEMPLATES,
                  coverage: float = COVERAGE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_found``, ``best``, ``best_coverage`` and ``found``.

    ``found`` lists name, start and end (code points, end exclusive) and coverage, the share of
    the template's words that are aligned, of every place with at least ``coverage``, by start
    and then name. ``best`` is the name with the highest coverage, of equal ones that with more
    aligned words; null without a find. Places of different templates may overlap, as a shorter
    licence is part of a longer one; places of one template do not.
    Words are compared in lower case; layout and punctuation do not matter.

    A null or empty text has no finds. Null ids, equal ids and repeated rows are scanned like
    any other row; an empty table gives an empty one; other columns are left out.
    """
    known = {name: _WORD.findall(t.lower()) for name, t in templates.items()}
    out = schema(id_type(rows, id_col), "n_found long, best string, best_coverage double, found "
                 "array<struct<name:string,start:long,end:long,coverage:double>>", id_col)
    place = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("coverage", pa.float64())]))

    def scan(text: str) -> list[dict]:
        words = _WORD.findall(text.lower())
        have = Counter(words)
        found = []
        spans = None
        for name, template in known.items():
            need = coverage * len(template)
            if sum(min(c, have[w]) for w, c in Counter(template).items()) < need:
                continue
            if spans is None:  # lower case may change lengths, so places come from the text itself
                spans = [m.span() for m in _WORD.finditer(text)]
                if len(spans) != len(words):
                    words = [text[s:e].lower() for s, e in spans]
            for first, last, n in occurrences(words, template, coverage):
                found.append({"name": name, "start": spans[first][0], "end": spans[last][1],
                              "coverage": n / len(template)})
        return sorted(found, key=lambda x: (x["start"], x["name"]))

    def run(batches):
        for batch in batches:
            found = [scan(x.as_py()) for x in batch.column(1)]
            best = [max(f, key=lambda x: (x["coverage"], len(known[x["name"]])), default=None) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([b and b["name"] for b in best], pa.string()),
                 pa.array([b and b["coverage"] for b in best], pa.float64()), pa.array(found, place)],
                names=out.names)

    return texts(rows, id_col, text_col).mapInArrow(run, out)
