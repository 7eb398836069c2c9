"""License scans by patience alignment.

A template is a sequence of words. A stretch of text is aligned with it like this: equal words at both ends are matched;
words that are unique in the stretch and in the template are anchors; of their positions the longest increasing
subsequence is taken; the gaps between anchors are aligned the same way. The coverage is the share of the template's words
that are matched. Texts are aligned in windows of three lengths, so that words that are frequent in a long text can be
unique where it matters: a notice of L words lies whole in a window of 5/4 L words when nothing is inserted, in one of 2 L
words when it is spread over up to 3/2 L, and in one of 3 L words up to 5/2 L, wherever it begins; a notice spread wider is
found only by the part of it that lies within a window. Every stretch that does not overlap a better one is reported.

Coverage alone does not tell licenses apart, so a stretch must agree with the template in its marks as well. In a template of
up to ``SHORT`` words these are all words but ``FILLERS``: the stretch must hold just these, in order, nothing inserted. In a
longer one they are ``NAMES`` and the number after "version": those of the template must be matched, and no other may stand
in the stretch; other words may be missing or inserted.

Only texts that hold enough words of a template to reach ``LEAST`` are aligned at all; the count of common words is an
upper bound of the coverage, so nothing is lost by that. It is taken for a whole batch from its distinct chunks. Rows stay
where they are read: no shuffle.

Cases: a NULL or empty text matches nothing; a template without words is refused; repeated rows are reported each; an empty
table gives an empty result; very long texts are aligned window by window; overlapping stretches of equal coverage go to
the shorter, then the first one; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import by_bytes, parts_of

LEAST = 0.8
SHORT = 20
SLICE_BYTES = 8 << 20
#: Words of a short notice that tell nothing about the license (fixed values).
FILLERS = frozenset("a an the this is are of under terms licensed released work version v".split())
#: Words that licenses of almost the same text differ by (fixed values).
NAMES = frozenset("apache mozilla lesser affero endorse advertising included appear".split())
find_words = re.compile(r"[^\W_]+").findall
each_word = re.compile(r"[^\W_]+").finditer

GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version. This program is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details. You should have received a copy of "
    "the GNU {} along with this program. If not, see <https://www.gnu.org/licenses/>.")
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. ")
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def gnu_header(name: str, version: str) -> str:
    return GNU_HEADER.format(name, version, name, name)


#: Whole notices and permission texts in public use (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE."),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."),
    "gpl-2.0-header": gnu_header("General Public License", "2"),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": gnu_header("General Public License", "3"),
    "lgpl-2.1-header": gnu_header("Lesser General Public License", "2.1"),
    "lgpl-3.0-header": gnu_header("Lesser General Public License", "3"),
    "agpl-3.0-header": gnu_header("Affero General Public License", "3"),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "bsd-2-clause": BSD_CONDITIONS + BSD_DISCLAIMER,
    "bsd-3-clause": BSD_CONDITIONS + BSD_THIRD + BSD_DISCLAIMER,
}


def rising(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tails, last, before = [], [], []
    for n, value in enumerate(values):
        at = bisect_left(tails, value)
        before.append(last[at - 1] if at else -1)
        if at == len(tails):
            tails.append(value)
            last.append(n)
        else:
            tails[at], last[at] = value, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(n)
        n = before[n]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched positions (in the text, in the template), increasing in both."""
    out, open_ = [], [(0, len(text), 0, len(template))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: n for n, w in enumerate(text[a:b], a) if here[w] == 1}
        anchors = [(place[w], n) for n, w in enumerate(template[c:d], c) if there[w] == 1 and w in place]
        chain = [anchors[n] for n in rising([x for x, _ in anchors])]
        out += chain
        if chain:
            for (x, y), (u, v) in zip([(a - 1, c - 1), *chain], [*chain, (b, d)], strict=True):
                open_.append((x + 1, u, y + 1, v))
    return sorted(out)


def marks(words: list[str]) -> list[tuple[int, str]]:
    """Positions and names of the words of a long text that tell licenses apart."""
    out = []
    for n, (before, word) in enumerate(zip(["", *words], words, strict=False)):
        if word in NAMES:
            out.append((n, word))
        elif word.isdigit() and before in ("version", "v"):
            out.append((n, f"version {word}"))
        elif word == "library" and before == "gnu":
            out.append((n, "gnu library"))
    return out


def same_license(text: list[str], template: list[str], pairs: list[tuple[int, int]]) -> bool:
    """Whether the matched stretch agrees with the template in the words that tell licenses apart."""
    stretch = text[pairs[0][0]:pairs[-1][0] + 1]
    if len(template) <= SHORT:
        return [w for w in stretch if w not in FILLERS] == [w for w in template if w not in FILLERS]
    matched = {j for _, j in pairs}
    named = marks(template)
    held = {name for n, name in named if n in matched}
    names = {name for _, name in named}
    return held == names and {name for _, name in marks(stretch)} <= names | {"included", "appear"}


def stretches(words: list[str], template: list[str], least: float = LEAST) -> list[tuple[float, int, int]]:
    """(coverage, first word, last word) of every stretch that covers enough of the template, in order. Of stretches that
    overlap, the one that covers more stays, then the shorter one, then the first one."""
    length, needed, wanted = len(template), least * len(template), Counter(template)
    at = np.array([n for n, w in enumerate(words) if w in wanted], np.int64)
    found = set()
    for size, step in ((length + max(1, length // 4), length // 4), (2 * length, length // 2), (3 * length, length // 2)):
        starts = np.arange(0, max(1, len(words)), max(1, step))
        many = np.searchsorted(at, starts + size) - np.searchsorted(at, starts)
        for start in starts[many >= needed].tolist():
            window = words[start:start + size]
            if sum((Counter(w for w in window if w in wanted) & wanted).values()) < needed:
                continue
            pairs = align(window, template)
            if len(pairs) >= needed and same_license(window, template, pairs):
                found.add((-len(pairs), pairs[-1][0] - pairs[0][0], start + pairs[0][0]))
    kept = []
    for many, more, first in sorted(found):
        place = bisect_left(kept, (first,))
        if (place == 0 or kept[place - 1][1] < first) and (place == len(kept) or first + more < kept[place][0]):
            kept.insert(place, (first, first + more, -many / length))
    return [(coverage, first, last) for first, last, coverage in kept]


def best_stretch(words: list[str], template: list[str], least: float = LEAST) -> tuple[float, int, int] | None:
    """The first of the stretches that cover most of the template."""
    return max(stretches(words, template, least), key=lambda s: s[0], default=None)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """``doc_id, license, coverage, first_char, end_char`` of every stretch of a document that covers a template enough;
    positions are code points of the aligned stretch, the end exclusive."""
    sequences = {name: find_words(body.lower()) for name, body in (templates or TEMPLATES).items()}
    if not all(sequences.values()):
        raise ValueError("a template without words")
    vocabulary = {w: n for n, w in enumerate(sorted({w for words in sequences.values() for w in words}))}
    wanted = np.array([[Counter(words)[w] for w in vocabulary] for words in sequences.values()])
    needed = least * wanted.sum(axis=1)

    def candidates(texts: pa.Array) -> np.ndarray:
        """Which (text, template) can reach the coverage at all."""
        parts, index, first = parts_of(texts.cast(pa.string()), False)
        found = [[vocabulary[w] for w in find_words(p.lower()) if w in vocabulary] for p in parts.to_pylist()]
        sizes = np.array([len(f) for f in found], np.int64)
        opens = np.cumsum(sizes) - sizes
        flat = np.array([v for f in found for v in f], np.int64)
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        many = sizes[index]
        at = np.repeat(opens[index] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        held = np.bincount(np.repeat(row, many) * len(vocabulary) + flat[at],
                           minlength=len(texts) * len(vocabulary)).reshape(len(texts), -1)
        return np.stack([np.minimum(held, w).sum(axis=1) >= n for w, n in zip(wanted, needed, strict=True)], axis=1)

    def scan(batches):
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                may, out = candidates(rows.column(1)), []
                for n in np.flatnonzero(may.any(axis=1)).tolist():
                    spans = [(m[0].lower(), m.start(), m.end()) for m in each_word(rows.column(1)[n].as_py())]
                    words = [w for w, _, _ in spans]
                    for k, (name, template) in enumerate(sequences.items()):
                        for coverage, first, last in stretches(words, template, least) if may[n, k] else ():
                            out.append((rows.column(0)[n].as_py(), name, coverage, spans[first][1], spans[last][2]))
                columns = list(zip(*out, strict=True)) if out else [[]] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = ["doc_id", "license", "coverage", "first_char", "end_char"]
    kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, license string, coverage double, first_char bigint, end_char bigint")
