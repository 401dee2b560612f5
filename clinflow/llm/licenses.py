"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are whole license texts (the files of license_texts), notices and one-line statements of versions and variants,
taken as words; K words in a row are hashed and of every W hashes the least is a fingerprint, so any K + W - 1 words in a
row that a text shares with a template hold one. The inverted index has for each fingerprint its places in the templates.
All hashes of K words of a text are looked up in it at once; hits of a template near one diagonal are a piece, which is
aligned word by word in a band around that diagonal (match 2, mismatch -1, gap -1). Pieces of a template that follow each
other in text and template, with GAP words or fewer between them, are a chain. A chain whose matched words are ``least`` of
the template's or more is reported with its span; in short statements the words that tell versions and variants apart
must all match. Of overlapping spans the one that matches most stays.

The templates are a fixed, small table, sent with the job. Null text is empty and has no license. Offsets count code
points, the end is exclusive. Texts are read whole. Rows are independent: repeated rows repeat, an empty table gives an
empty result, other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, lean, text_or_empty
from clinflow.llm.shingles import PART, Shingler, mix

by_value(__name__)

K, W, BAND, LEAST = 3, 2, 8, 0.75
#: Words between two pieces of a chain, at most; words beside a piece's hits that its alignment looks at; words that a statement has, at most.
GAP, BESIDE, STATEMENT = 64, 32, 40
#: Shares of a template's fingerprints that a text, and a piece, must hit (one at least); a chain of LEAST has far more.
HIT, PIECE = 0.1, 0.04

#: Statements and notices of public licenses.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "mit": "Released under the MIT License.",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
        copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
        in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
        AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
        EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
        LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal.",
}
#: Versions of the GNU licenses, and the variants of the Creative Commons licenses of version 4.0.
GNU = (("gpl", "", "2"), ("gpl", "", "3"), ("lgpl", "Lesser ", "2.1"), ("lgpl", "Lesser ", "3"), ("agpl", "Affero ", "3"))
COMMONS = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives", "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
#: Words that tell variants apart; words with a digit do too.
VARIANTS = {"lesser", "affero", "by", "sa", "nd", "nc", "sharealike", "noderivatives", "noncommercial", "mit", "apache", "gnu", "cc0"}


def _templates() -> dict[str, str]:
    out = dict(NOTICES)
    for name, word, version in GNU:
        full = version if "." in version else f"{version}.0"
        out[f"{name}-{full}"] = f"This work is licensed under the GNU {word}General Public License, version {version}."
        out[f"{name}-{full}-notice"] = f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU {word}General
            Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
    for name, words in COMMONS.items():
        out[f"cc-{name}-4.0"] = f"Licensed under CC {name.upper()} 4.0."
        out[f"cc-{name}-4.0-notice"] = f"This work is licensed under a Creative Commons {words} 4.0 International License."
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        out[f"{file.stem.lower()}-text"] = file.read_text(encoding="utf-8")
    return out


TEMPLATES = _templates()


class Words(Shingler):
    """Hashes of words of ASCII letters and digits, A to Z lowered, with their places in the bytes."""

    def __init__(self):
        super().__init__(1)
        self.space = np.ones(256, bool)
        self.space[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

    def placed(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and starts, in parts of PART bytes or a word more."""
        data, at = np.frombuffer(raw, np.uint8), 0
        out, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        while at < len(data):
            end = min(len(data), at + PART)
            while end < len(data) and not self.space[data[end]]:
                end += 1
            h, starts = self.words(data[at:end])
            out.append(h)
            places.append(starts + at)
            at = end
        return np.concatenate(out), np.concatenate(places)


def hashes_of(words: np.ndarray) -> np.ndarray:
    """The hash of every K words in a row."""
    n = len(words) - K + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, K, np.uint64)
    for k in range(K):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return h


def winnow(hashes: np.ndarray, w: int = W) -> np.ndarray:
    """Places of the fingerprints: the least of every ``w`` hashes in a row, the last of equal ones."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    w = min(w, len(hashes))
    windows = np.lib.stride_tricks.sliding_window_view(hashes, w)
    return np.unique(np.arange(len(windows)) + w - 1 - np.argmin(windows[:, ::-1], axis=1))


def align(text: list[int], template: list[int], diagonal: int, band: int = BAND, must: dict[int, int] | None = None) -> tuple[int, int, int, int, int, int, int]:
    """(score, matched words, first and last + 1 in the text, first and last + 1 in the template, bits of ``must`` that matched) of the best
    local alignment within ``band`` of the diagonal (text place less template place). ``must``: template place to bit."""
    best = (0, 0, 0, 0, 0, 0, 0)
    must = must or {}
    above: dict[int, tuple[int, int, int, int, int]] = {}
    for j, word in enumerate(template):
        row: dict[int, tuple[int, int, int, int, int]] = {}
        bit = must.get(j, 0)
        for i in range(max(0, j + diagonal - band), min(len(text), j + diagonal + band + 1)):
            score, matched, i0, j0, bits = above.get(i - 1, (0, 0, i, j, 0))
            same = text[i] == word
            cell = (score + 2, matched + 1, i0, j0, bits | bit) if same else (score - 1, matched, i0, j0, bits)
            for other in (above.get(i), row.get(i - 1)):
                if other and (other[0] - 1, other[1]) > cell[:2]:
                    cell = (other[0] - 1, *other[1:])
            if cell[0] > 0:
                row[i] = cell
                if same and cell[:2] > best[:2]:
                    best = (cell[0], cell[1], cell[2], i + 1, cell[3], j + 1, cell[4])
        above = row
    return best


#: Alignments that are made side by side, at most, and at least.
SIDE, FEW = 256, 6
_UNIT = 1 << 24  # a point of score, in a number that has the matched words below it


def align_all(jobs: list[tuple[np.ndarray, np.ndarray, int, dict[int, int]]], band: int = BAND) -> list[tuple[int, ...]]:
    """What ``align`` gives for each (text, template, diagonal, must): alignments of like lengths side by side, a row of all their bands at a time."""
    out: list[tuple[int, ...]] = [()] * len(jobs)
    order = sorted(range(len(jobs)), key=lambda k: len(jobs[k][1]))
    b = 0
    while b < len(order):
        some = [k for k in order[b : b + SIDE] if len(jobs[k][1]) <= 1.5 * len(jobs[order[b]][1]) + 8]  # no short one waits for a long one
        b += len(some)
        if len(some) < FEW:
            for k in some:
                text, template, diagonal, must = jobs[k]
                out[k] = align(text.tolist(), template.tolist(), diagonal, band, must)
        else:
            for k, x in zip(some, _side_by_side([jobs[k] for k in some], band), strict=True):
                out[k] = x
    return out


def _side_by_side(jobs: list, band: int) -> list[tuple[int, ...]]:
    n, width = len(jobs), 2 * band + 1
    texts = np.zeros((n, max(len(j[0]) for j in jobs)), np.uint64)
    templates = np.zeros((n, max(len(j[1]) for j in jobs)), np.uint64)
    bits_at = np.zeros(templates.shape, np.int64)
    for k, (text, template, _, must) in enumerate(jobs):
        texts[k, : len(text)], templates[k, : len(template)] = text, template
        for place, bit in must.items():
            if 0 <= place < len(template):
                bits_at[k, place] = bit
    size, rows = np.array([len(j[0]) for j in jobs])[:, None], np.array([len(j[1]) for j in jobs])[:, None]
    diagonal, slot = np.array([j[2] for j in jobs])[:, None], np.arange(width)
    every = np.arange(n)[:, None]
    key, first, above, said = (np.zeros((n, width), np.int64) for _ in range(4))  # score and matched in one; places of the beginning; bits
    best, best_at = np.zeros(n, np.int64), np.zeros((n, 5), np.int64)
    for j in range(templates.shape[1]):
        i = j + diagonal - band + slot
        inside = (i >= 0) & (i < size) & (j < rows)
        same = inside & (texts[every, np.clip(i, 0, texts.shape[1] - 1)] == templates[:, j : j + 1])
        # from the cell before both; where there is none, the alignment begins here
        fresh = key <= 0
        own = np.where(same, key + 2 * _UNIT + 1, key - _UNIT)
        i0, j0, bits = np.where(fresh, i, first), np.where(fresh, j, above), np.where(same, said | bits_at[:, j : j + 1], said)
        # a template word that the text lacks
        up = np.concatenate([key[:, 1:], np.zeros((n, 1), np.int64)], 1)
        take = (up > 0) & (up - _UNIT > own)
        pad = lambda x: np.concatenate([x[:, 1:], x[:, :1]], 1)
        own, i0, j0, bits = np.where(take, up - _UNIT, own), np.where(take, pad(first), i0), np.where(take, pad(above), j0), np.where(take, pad(said), bits)
        own = np.where(inside, own, -_UNIT * (1 << 20))
        # text words that the template lacks: the best of all cells to the left, less a point a word; of equal ones the nearest
        run = np.maximum.accumulate((own + slot * _UNIT) * 32 + slot, axis=1)
        source = run & 31
        key = (run >> 5) - slot * _UNIT
        flat = every * width + source
        first, above, said = i0.ravel()[flat], j0.ravel()[flat], bits.ravel()[flat]
        alive = inside & (key >= _UNIT)
        key, said = np.where(alive, key, 0), np.where(alive, said, 0)
        reached = np.where(same, key, 0)
        at = reached.argmax(1)
        top = reached[every[:, 0], at]
        better = np.flatnonzero(top > best)
        if len(better):
            c = at[better]
            best[better] = top[better]
            best_at[better] = np.stack([first[better, c], i[better, c] + 1, above[better, c], np.full(len(c), j + 1), said[better, c]], 1)
    return [(int(k) // _UNIT, int(k) % _UNIT, *map(int, x)) for k, x in zip(best, best_at, strict=True)]


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.least, self.names, self.words = least, list(templates), Words()
        self.templates = [self.words.placed(t.encode())[0] for t in templates.values()]
        self.must: list[dict[int, int]] = []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for t, (text, words) in enumerate(zip(templates.values(), self.templates, strict=True)):
            said = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()
            telling = [j for j, x in enumerate(said) if x in VARIANTS or any(c.isdigit() for c in x)] if len(words) <= STATEMENT else []
            self.must.append({j: 1 << k for k, j in enumerate(telling)})
            hashes = hashes_of(words)
            places = winnow(hashes)
            found.append((hashes[places], np.full(len(places), t), places))
        keys, of, places = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(keys, kind="stable")
        self.keys, self.of, self.places = keys[order], of[order], places[order]
        self.size = np.bincount(of, minlength=len(self.templates))  # fingerprints of each template

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text place, template, template place) of every hash of the words that is a fingerprint of a template."""
        hashes = hashes_of(words)
        lo, hi = np.searchsorted(self.keys, hashes, "left"), np.searchsorted(self.keys, hashes, "right")
        n = hi - lo
        at = np.repeat(np.arange(len(hashes)), n)
        entry = np.repeat(lo, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        return at, self.of[entry], self.places[entry]

    def pieces(self, at: np.ndarray, places: np.ndarray, t: int) -> list[tuple[int, int, int]]:
        """(diagonal, first and last template place) of the runs of hits near one diagonal."""
        diagonal = at - places
        order = np.lexsort((places, diagonal))
        least = max(1, math.ceil(PIECE * self.size[t]))
        out, group = [], []
        for d, j in zip(diagonal[order].tolist(), places[order].tolist(), strict=True):
            if group and d - group[0][0] > BAND // 2:
                out.append(group)
                group = []
            group.append((d, j))
        if group:
            out.append(group)
        return [(g[len(g) // 2][0], min(j for _, j in g), max(j for _, j in g)) for g in out if len(g) >= least]

    def scan(self, raw: bytes) -> list[tuple[int, int, str, int, int]]:
        """(start, end, template, matched words, words of the template), by place; of overlapping spans the one that matches most stays."""
        words, starts = self.words.placed(raw)
        wanted = self.wanted(words, *self.hits(words))
        return self.judged(raw, words, starts, wanted, align_all([x[3] for x in wanted]))

    def wanted(self, words: np.ndarray, at: np.ndarray, of: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, tuple]]:
        """(template, first text place, first template place, what to align) of each piece."""
        out = []
        for t in np.unique(of).tolist():
            own = of == t
            if len(np.unique(places[own])) < max(1, math.ceil(HIT * self.size[t])):
                continue
            template = self.templates[t]
            for diagonal, a, b in self.pieces(at[own], places[own], t):
                j0, j1 = max(0, a - BESIDE), min(len(template), b + K + BESIDE)
                i0 = max(0, j0 + diagonal - BAND)
                i1 = min(len(words), j1 + diagonal + BAND)
                out.append((t, i0, j0, (words[i0:i1], template[j0:j1], diagonal + j0 - i0, {j - j0: k for j, k in self.must[t].items()})))
        return out

    def judged(self, raw: bytes, words: np.ndarray, starts: np.ndarray, wanted: list, aligned: list) -> list[tuple[int, int, str, int, int]]:
        pieces: dict[int, set] = {}
        for (t, i0, j0, _), (_, matched, x, y, u, v, bits) in zip(wanted, aligned, strict=True):
            if matched:
                pieces.setdefault(t, set()).add((i0 + x, i0 + y, j0 + u, j0 + v, matched, bits))
        found = [x for t, rows in sorted(pieces.items()) for x in self._chains(t, sorted(rows))]
        if not found:
            return []
        kept: list[tuple[int, int, int, int]] = []
        for x in sorted(found, key=lambda x: (x[0], -x[3], x)):  # by place
            if not kept or x[0] >= kept[-1][1]:
                kept.append(x)
            elif x[3] > kept[-1][3]:
                kept[-1] = x
        data = np.frombuffer(raw, np.uint8)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
        inside = ~self.words.space[data]
        out = []
        for a, b, t, m in kept:
            end = int(starts[b - 1])
            while end < len(data) and inside[end]:
                end += 1
            out.append((int(points[starts[a]]), int(points[end]), self.names[t], m, len(self.templates[t])))
        return out

    def _chains(self, t: int, rows: list[tuple[int, ...]]) -> list[tuple[int, int, int, int]]:
        """(first word, last + 1, template, matched) of what covers enough of a template."""
        template, must = self.templates[t], self.must[t]
        best: list[tuple[int, int, int]] = []  # matched and bits of the best chain that ends in a piece, and its piece before
        for k, (x, _, u, _, matched, bits) in enumerate(rows):
            own = (matched, bits, -1)
            for p in range(k - 1, -1, -1):
                if x - rows[p][0] > GAP + len(template) + BAND:
                    break
                if 0 <= x - rows[p][1] <= GAP and u >= rows[p][3] and best[p][0] + matched > own[0]:
                    own = (best[p][0] + matched, best[p][1] | bits, p)
            best.append(own)
        every, used, out = sum(must.values()), set(), []
        for k in sorted(range(len(rows)), key=lambda k: -best[k][0]):
            if best[k][0] < self.least * len(template):
                break
            chain = [k]
            while best[chain[-1]][2] >= 0:
                chain.append(best[chain[-1]][2])
            if best[k][1] == every and not used & set(chain):
                used |= set(chain)
                out.append((rows[chain[-1]][0], rows[k][1], t, best[k][0]))
        return out

    def scan_all(self, texts: list[bytes]) -> Iterator[list[tuple[int, int, str, int, int]]]:
        """As ``scan`` for each text; short texts are hashed and looked up together."""
        group: list[bytes] = []
        size = 0
        for raw in texts:
            if group and size + len(raw) > PART:
                yield from self._together(group)
                group, size = [], 0
            group.append(raw)
            size += len(raw) + 1
        if group:
            yield from self._together(group)

    def _together(self, group: list[bytes]) -> Iterator[list[tuple[int, int, str, int, int]]]:
        words, starts = self.words.placed(b"\n".join(group))
        first = np.cumsum([0, *(len(x) + 1 for x in group[:-1])])
        begin = np.searchsorted(starts, first)
        end = np.append(begin[1:], len(words))
        at, of, places = self.hits(words)
        text = np.searchsorted(begin, at, side="right") - 1
        inside = at + K <= end[text]  # K words of one text
        at, of, places, text = at[inside], of[inside], places[inside], text[inside]
        edges = np.searchsorted(text, np.arange(len(group) + 1))
        wanted = []
        for k in range(len(group)):
            lo, hi = edges[k], edges[k + 1]
            wanted.append(self.wanted(words[begin[k] : end[k]], at[lo:hi] - begin[k], of[lo:hi], places[lo:hi]) if lo < hi else [])
        aligned = iter(align_all([x[3] for part in wanted for x in part]))
        for k, raw in enumerate(group):
            yield self.judged(raw, words[begin[k] : end[k]], starts[begin[k] : end[k]] - first[k], wanted[k], [next(aligned) for _ in wanted[k]]) if wanted[k] else []


def _scan(templates: dict[str, str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = list(scanner.scan_all([x.encode() for x in batch.column(1).to_pylist()]))
                spans = [",".join(f"{name}:{a}:{b}:{m}/{n}" for a, b, name, m, n in x) for x in found]
                best = [max((round(m / n, 4) for *_, m, n in x), default=0.0) for x in found]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array(best, pa.float64()), pa.array(spans, pa.string())], names=["doc_id", "n_licenses", "best_coverage", "licenses"])

    return run


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, n_licenses, best_coverage, licenses ("template:start:end:matched/words", comma-joined, by start)."""
    rows = lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_scan(templates or TEMPLATES, least), "doc_id long, n_licenses long, best_coverage double, licenses string")
