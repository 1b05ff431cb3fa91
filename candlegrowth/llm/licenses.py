"""License texts in documents: MinHash bands over overlapping windows, then exact containment.

Texts are cut into shingles of five lower-cased words (a shorter template is one shingle). A
template of t shingles is sought with windows of the smallest power of two that, at steps of a
quarter, must hold any t shingles in a row; the MinHash of a window is the least of its blocks'. A
window and a template that share a band of hashes are candidates. The number of bands is set so
that a window which holds SHARE of the template, in the worst place, is found with chance CHANCE.
Templates of up to four shingles have windows of their own size, which must equal them, so one hash
is sure. A candidate is verified by the exact share of the template's shingles round the window.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlegrowth.llm.common import WordHashes, mixed

WIDTH = 5
SHARE = 0.8
CHANCE = 0.99
ROWS = 2  # hashes in a band
SMALL = 4
CHUNK = 100_000  # words that are searched at a time
PIECE = 1 << 20
MOST_WORDS = 200_000  # of all templates together: they are sent to every task
SEED = 11
_WORDS = re.compile(r"[^\W_]+")
_BLANK = re.compile(r"\s")

#: Well-known license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "BSD-3-Clause-third-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def shingles(words):
    """Shingles of a list of words as tuples; of a shorter list the list itself, if it has words."""
    if len(words) < WIDTH:
        return [tuple(words)] if words else []
    return list(zip(*(words[i:] for i in range(WIDTH))))


def words_of(text):
    """The lower-cased words of a text, in lists of about PIECE characters."""
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            gap = _BLANK.search(text, stop)
            stop = gap.start() if gap else len(text)
        yield _WORDS.findall(text[start:stop].lower())
        start = stop


def window_of(size):
    """(window, step) for templates of so many shingles."""
    if size <= SMALL:
        return size, 1
    window = 8
    while size > window - window // 4 + 1:
        window *= 2
    return window, window // 4


def bands_of(sizes, window):
    """Bands so that a window that holds SHARE of the least template collides with chance CHANCE."""
    least = min(sizes)
    common = math.ceil(SHARE * least)
    alike = common / (window + least - common)
    return max(1, math.ceil(math.log(1 - CHANCE) / math.log(1 - alike ** ROWS)))


class Scanner:
    """Finds templates, given as (name, text), in texts."""

    def __init__(self, templates):
        self.names, self.sets, self.lengths = [], [], []
        for name, text in templates:
            words = [w for part in words_of(text or "") for w in part]
            if words:
                self.names.append(name)
                self.sets.append(set(shingles(words)))
                self.lengths.append(len(words))
        if sum(self.lengths) > MOST_WORDS:
            raise ValueError(f"the templates have over {MOST_WORDS} words")
        self.cache = WordHashes()
        kinds = {}
        for i, found in enumerate(self.sets):
            width = min(WIDTH, self.lengths[i])
            kinds.setdefault((width, *window_of(len(found))), []).append(i)
        rng = np.random.default_rng(SEED)
        self.kinds = []
        for (width, window, step), members in sorted(kinds.items()):
            small = window <= SMALL
            bands, rows = (1, 1) if small else (bands_of([len(self.sets[i]) for i in members], window), ROWS)
            factors = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64) | np.uint64(1)
            lists = [np.unique(self._of_set(self.sets[i])) for i in members]
            keys = np.array([
                self._bands(np.array([(x * f).min() for f in factors], dtype=np.uint64)[:, None], rows)[:, 0] for x in lists
            ], dtype=np.uint64).reshape(len(members), bands)
            near = np.zeros((bands, 1 << 16), dtype=bool)
            for band in range(bands):
                near[band, keys[:, band] >> np.uint64(48)] = True
            self.kinds.append((width, window, step, np.array(members), bands, rows, factors, keys, near))

    def _of_set(self, found):
        return self._shingle(np.array([self.cache.of([w.encode() for w in x]) for x in found], dtype=np.uint64).T)

    @staticmethod
    def _shingle(columns):
        total = np.zeros(len(columns[0]), dtype=np.uint64)
        for column in columns:
            total = total * np.uint64(0x9E3779B97F4A7C15) + column
        return mixed(total)

    @staticmethod
    def _bands(hashes, rows):
        """Band keys of MinHashes (rows: hashes, columns: windows)."""
        keys = hashes[::rows]
        for i in range(1, rows):
            keys = keys * np.uint64(0xD6E8FEB86659FD93) + hashes[i::rows]
        return mixed(keys)

    def _candidates(self, hashes):
        """(template, start, end) in words, for the word hashes of a chunk."""
        for width, window, step, members, bands, rows, factors, keys, near in self.kinds:
            n = len(hashes) - width + 1
            if n < 1:
                continue
            found = self._shingle([hashes[i:n + i] for i in range(width)])
            if step == 1:
                blocks = max(n, window)
            else:
                blocks = max(-(-n // step), window // step)
            full = np.full(blocks * step, ~np.uint64(0))
            full[:n] = found
            held = []
            for s in range(0, bands, 8):
                some = factors[s * rows:(s + 8) * rows]
                least = []
                for f in some:
                    block = full * f
                    block[n:] = ~np.uint64(0)
                    if step > 1:
                        block = block.reshape(-1, step).min(axis=1)
                    many = window // step if step > 1 else window
                    wide = block[:len(block) - many + 1].copy()
                    for i in range(1, many):
                        np.minimum(wide, block[i:len(block) - many + 1 + i], out=wide)
                    least.append(wide)
                for b, key in enumerate(self._bands(np.array(least), rows), s):
                    hit = np.flatnonzero(near[b, key >> np.uint64(48)])
                    for m, value in enumerate(keys[:, b].tolist()):
                        held += [(int(members[m]), int(x) * step) for x in hit[key[hit] == np.uint64(value)]]
            for template, start in sorted(set(held)):
                yield template, max(0, start - window), min(len(hashes), start + 2 * window + width)

    def find(self, texts):
        """For each text the best place (template number, share, start word, end word) per template."""
        found = [{} for _ in texts]
        held, length = [], 0
        for number, text in enumerate(texts):
            offset, carried = 0, []
            for part in words_of(text or ""):
                words = carried + part
                offset -= len(carried)
                held.append((number, offset, words))
                length += len(words)
                offset += len(words)
                carried = words[-2 * max(self.lengths, default=0) - WIDTH:] if len(words) > len(part) or len(text) > PIECE else []
                if length >= CHUNK:
                    self._search(held, found)
                    held, length = [], 0
        if held:
            self._search(held, found)
        return found

    def _search(self, held, found):
        hashes = np.concatenate([self.cache.of([*map(str.encode, words)]) for _, _, words in held])
        ends = np.cumsum([len(x) for _, _, x in held])
        done = set()
        for template, low, high in self._candidates(hashes):
            piece = int(np.searchsorted(ends, low, "right"))
            while piece < len(held) and int(ends[piece]) - len(held[piece][2]) < high:
                begin = int(ends[piece]) - len(held[piece][2])
                key = (template, piece, max(low, begin), min(high, int(ends[piece])))
                if key not in done:
                    done.add(key)
                    self._verify(template, held[piece], key[2] - begin, key[3] - begin, found)
                piece += 1

    def _verify(self, template, piece, low, high, found):
        number, offset, words = piece
        own, width = self.sets[template], min(WIDTH, self.lengths[template])
        at = {}
        places = [i for i in range(low, high - width + 1) if tuple(words[i:i + width]) in own]
        reach = 2 * self.lengths[template]
        best = None
        right = 0
        for left in range(len(places)):  # the shortest stretch that holds the most of the template
            while right < len(places) and places[right] - places[left] < reach:
                x = tuple(words[places[right]:places[right] + width])
                at[x] = at.get(x, 0) + 1
                right += 1
            score = (len(at), places[left] - places[right - 1])
            if best is None or score > best[0]:
                best = (score, places[left], places[right - 1] + width)
            x = tuple(words[places[left]:places[left] + width])
            at[x] -= 1
            if not at[x]:
                del at[x]
        if best and best[0][0] >= SHARE * len(own):
            share, s, e = best[0][0] / len(own), offset + best[1], offset + best[2]
            known = found[number].get(template)
            if known is None or (-share, s) < (-known[1], known[2]):
                found[number][template] = (template, share, s, e)


def _scan(templates, id_type):
    def scan(batches):
        scanner = Scanner(templates)
        for batch in batches:
            rows = [
                (i, scanner.names[template], share, s, e)
                for i, found in enumerate(scanner.find(batch.column(1).to_pylist()))
                for template, share, s, e in sorted(found.values())
            ]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(arrays[0]), *arrays[1:]],
                ["doc_id", "license", "share", "start_word", "end_word"],
            )

    return scan


def scan_licenses(documents, id_column="doc_id", text_column="text", templates=None):
    """(doc_id, license, share, start_word, end_word): a row for each document and template of which
    a stretch of the document, at most about twice as long, holds SHARE of the shingles or more, with
    the best such stretch. Words are numbered from 0.

    `templates` maps names to texts, MOST_WORDS words in all at most. Templates without words match
    nothing, nor do texts that are NULL or blank; repeated documents have rows of their own; an empty
    table gives none. Other columns are not read.
    """
    templates = list((TEMPLATES if templates is None else templates).items())
    Scanner(templates)  # the bound holds, or an error here
    docs = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType
    return docs.mapInArrow(
        _scan(templates, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, license string, share double, start_word long, end_word long",
    )


def op7_license_scan(spark, folder):
    """All license notices in all documents."""
    return scan_licenses(spark.read.parquet(f"{folder}/documents.parquet"))
