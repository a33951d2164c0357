"""Licence scan: Dice coefficient over word bigrams against licence templates.

Words are lower-cased ``\\w+``. Compared with a template are the whole text, every line,
every run of lines most of whose bigrams are the template's, and word windows that begin
and end with a bigram of the template, whatever the lines. A window inside the match of a
larger template is part of that one. A unit of a bigrams can
reach the Dice coefficient d with a template of b bigrams only if a lies between
b d / (2 - d) and b (2 - d) / d; and a text must hold b d / (2 - d) of the template's
bigrams. Both bounds prune templates before sets are compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.words import mix, slices, words_of

DICE = 0.85

#: Short notices and licence texts as published.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved-line": "All rights reserved.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
}


def full_texts() -> dict[str, str]:
    """Whole licence texts by name: the files of ``license_texts``."""
    return {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def normal(text: str | None) -> str:
    """Lower-cased words ``\\w+``, spaces between them; line feeds are kept."""
    return re.sub(r"[^\w\n]+", " ", text.lower()) if text else ""


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def bounds(size: int, least: float) -> tuple[float, float]:
    return size * least / (2 - least) - 1e-9, size * (2 - least) / least + 1e-9


def windows(pairs: list[tuple[str, str]], template: set, least: float) -> list[tuple[float, int, int]]:
    """(coefficient, first bigram, last bigram) of the best window of each group of overlapping ones that reach ``least``.

    A best window begins and ends with a bigram of the template. From every such start
    the bigrams are followed until more different ones are passed than the bound allows.
    """
    low, high = bounds(len(template), least)
    out: list[tuple[float, int, int]] = []
    counts: dict = {}
    left = right = held = 0
    for i in [k for k, p in enumerate(pairs) if p in template]:
        if right <= i:
            counts, left, right, held = {}, i, i, 0
        while left < i:
            p = pairs[left]
            counts[p] -= 1
            if not counts[p]:
                del counts[p]
                held -= p in template
            left += 1
        while right < len(pairs) and (pairs[right] in counts or len(counts) + 1 <= high):
            p = pairs[right]
            if p not in counts:
                counts[p] = 0
                held += p in template
            counts[p] += 1
            right += 1
        overlaps = bool(out) and i <= out[-1][2]
        # with all of these bigrams and no others
        most = 2 * held / (held + len(template))
        if held < low or (overlaps and most <= out[-1][0]):
            continue
        seen, hits, best = set(), 0, None
        for k in range(i, right):
            p = pairs[k]
            if p not in seen:
                seen.add(p)
                if p in template:
                    hits += 1
                    d = 2 * hits / (len(seen) + len(template))
                    if d >= least and (best is None or d > best[0]):
                        best = (d, i, k)
        if best and not overlaps:
            out.append(best)
        elif best and best[0] > out[-1][0]:
            out[-1] = best
    return out


def scan_text(text: str, templates: dict[str, set], least: float = DICE) -> list[tuple[str, float, int, int]]:
    """(template, coefficient, first line, last line) of the best unit of each template; ties go to the earlier, then shorter unit."""
    lines = [x.split() for x in normal(text).split("\n")]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
    words = [w for x in lines for w in x]
    pairs = list(zip(words, words[1:]))
    out = {}
    covered: list[tuple[int, int, int]] = []  # (template size, first word, last word) of every match
    whole = set(pairs)
    for name, template in sorted(templates.items(), key=lambda x: -len(x[1])):
        low, high = bounds(len(template), least)
        if len(whole & template) < low:
            continue
        hit = np.fromiter((p in template for p in pairs), dtype=np.int64, count=len(pairs))
        sums = np.concatenate([[0], np.cumsum(hit)])
        # a line's bigrams are those that begin in it and do not leave the text
        a, b = first[:-1], np.minimum(first[1:], len(pairs))
        hits, sizes = sums[np.maximum(a, b)] - sums[np.minimum(a, len(pairs))], np.maximum(b - a, 0)
        mostly = (2 * hits > sizes) | (np.diff(first) == 0)
        units = {(0, len(lines) - 1)} | {(i, i) for i in np.flatnonzero(hits)}
        i = 0
        while i < len(lines):
            j = i
            while j < len(lines) and mostly[j]:
                j += 1
            if j > i:
                units.add((i, j - 1))
                units.add((i, min(j, len(lines) - 1)))
            i = max(j, i + 1)
        best = None
        for i, j in units:
            own = words[first[i] : first[j + 1]]
            if len(own) - 1 < low:
                continue
            grams = bigrams(own)
            if low <= len(grams) <= high:
                d = dice(grams, template)
                if d >= least:
                    covered.append((len(template), int(first[i]), int(first[j + 1]) - 1))
                    if best is None or (-d, i, j) < best:
                        best = (-d, i, j)
        for d, a, b in windows(pairs, template, least):
            if any(size > len(template) and lo <= a and b + 1 <= hi for size, lo, hi in covered):
                continue
            covered.append((len(template), a, b + 1))
            i, j = np.searchsorted(first, [a, b + 1], side="right") - 1
            if best is None or (-d, i, j) < best:
                best = (-d, i, j)
        if best:
            out[name] = (name, round(-best[0], 6), int(best[1]), int(best[2]))
    return [out[name] for name in templates if name in out]


def _scan(templates: dict[str, str], least: float):
    sets = {k: bigrams(normal(v).split()) for k, v in templates.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pair_hashes(texts):
            w = words_of(texts)
            h = w.hashes()
            return w, mix(h[:-1] * np.uint64(3) + mix(h[1:]))

        known = [np.unique(pair_hashes([normal(v).replace("\n", " ")])[1]) for v in templates.values()]
        need = [bounds(len(s), least)[0] for s in sets.values()]
        for batch in batches:
            rows = []
            texts = batch.column(1)
            for lo, hi in slices(texts.cast(pa.large_string()).to_pandas().str.len().fillna(0).to_numpy()):
                own = texts.slice(lo, hi - lo).to_pylist()
                w, grams = pair_hashes(normal("\x00".join((t or "").replace("\x00", " ").replace("\n", " ") for t in own).replace("\x00", "\n")).split("\n"))
                owner = w.text_of()
                likely = np.zeros(hi - lo, dtype=bool)
                all_known = np.unique(np.concatenate(known))
                at = np.flatnonzero(np.isin(grams, all_known))
                for mine, least_hits in zip(known, need):
                    likely |= np.bincount(owner[at][np.isin(grams[at], mine)], minlength=hi - lo) >= least_hits
                for i in np.flatnonzero(likely):
                    rows += [(int(i) + lo, *found) for found in scan_text(own[i] or "", sets, least)]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64()), *[pa.array([r[k] for r in rows], pa.int64()) for k in (3, 4)]],
                names=["id", "license", "dice", "first_line", "last_line"],
            )

    return run


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | DataFrame | None = None, least: float = DICE) -> DataFrame:
    """(id, license, dice, first_line, last_line): a row for each template that some unit of the text reaches ``least`` with.

    Null and empty texts have no rows; repeated rows each have theirs; lines count from
    0; long texts are scanned whole; an empty table gives no rows; other columns are
    ignored. ``templates`` (name to text, or a table of name and text) replaces the
    built-in ones, which are ``TEMPLATES`` and the files of ``license_texts``.
    """
    if isinstance(templates, DataFrame):
        templates = {r[0]: r[1] for r in templates.collect()}
    templates = templates or TEMPLATES | full_texts()
    id_type = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(_scan(templates, least), f"id {id_type}, license string, dice double, first_line long, last_line long").withColumnRenamed("id", id_col)
