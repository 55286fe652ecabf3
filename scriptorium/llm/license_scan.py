"""Operator 1: licence texts in documents.

Templates are few and given: winnowed fingerprints of their word grams make an inverted index that goes to every task.
A long template keeps the smallest grams of every window; one of fewer than LONG words keeps all, of as many words
as surely stay together when so many words change as the least coverage allows.  A document's grams that hit the index
vote for (template, diagonal); around each diagonal a banded local alignment of words gives a piece of the template, with
edits, and where it stands.  Pieces that follow each other in template and text are chained, so what was put between
them (up to GAP words) costs nothing; matched words and span are those of the chain.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import releasing, table

GRAM_WORDS, WINDOW = 3, 3
#: Words from which a template is winnowed.
LONG = 24
#: Words by which an alignment may drift off its diagonal, words that may stand between two pieces, and the matched share of a template to report.
BAND, GAP, LEAST_COVERAGE = 8, 120, 0.7
_WORD = re.compile(r"\w+(?:[.-]\w+)*")

#: Licence notices in common use.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mit-full": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-2-clause-full": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc-full": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
}


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    found = [(m.group().lower(), m.span()) for m in _WORD.finditer(text)]
    return [w for w, _ in found], [s for _, s in found]


def _gram_hash(gram: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest("\0".join(gram))


def winnow(words: list[str], gram: int = GRAM_WORDS, window: int = WINDOW) -> list[tuple[tuple[str, ...], int]]:
    """Grams that are smallest by hash (last on ties) in some window of grams, with their places."""
    grams = [tuple(words[i : i + gram]) for i in range(max(1, len(words) - gram + 1))]
    hashes = [_gram_hash(g) for g in grams]
    chosen: dict[int, None] = {}
    for i in range(max(1, len(grams) - window + 1)):
        chosen.setdefault(min(range(i, min(i + window, len(grams))), key=lambda j: (hashes[j], -j)))
    return [(grams[i], i) for i in chosen]


def _unbroken(words: int, least: float) -> int:
    """Words of the longest run, at least, when words are changed or left out down to the least coverage."""
    matched = min(words, max(1, math.ceil(least * words - 1e-9)))
    return -(-matched // (words - matched + 1))


class Index:
    """Fingerprints of the templates: gram -> (template, place)."""

    def __init__(self, templates: dict[str, str], least: float = LEAST_COVERAGE):
        self.names = sorted(templates)
        self.words = [words_of(templates[n])[0] for n in self.names]
        self.postings: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            long = len(words) >= LONG
            for gram, i in winnow(words, GRAM_WORDS if long else min(GRAM_WORDS, _unbroken(len(words), least)), WINDOW if long else 1) if words else ():
                self.postings.setdefault(gram, []).append((t, i))
        self.starters = {g[0] for g in self.postings}
        # A text without the rarest kind of word of every gram has no hit: one search decides that.
        self.gate = re.compile("|".join(sorted({re.escape(max(g, key=len)) for g in self.postings}, key=len)) or "(?!)")


@functools.lru_cache(4)
def _index(templates: tuple[tuple[str, str], ...], least: float) -> Index:
    return Index(dict(templates), least)


class Piece(NamedTuple):
    """A local alignment: score, matched words, first and last + 1 matched word of the text, and of the template; the matched pairs."""

    score: int
    matched: int
    first: int
    end: int
    template_first: int
    template_end: int
    pairs: tuple[tuple[int, int], ...] = ()


def align(template: list[str], words: list[str | None], center: int, band: int = BAND) -> Piece:
    """Banded local alignment (match 2, mismatch -1, gap -1) along words[i + center + drift].

    Of equal scores the one that ends nearest the center counts; no alignment crosses a word that is None.
    """
    width = 2 * band + 1
    top, matched, drift, link = 0, 0, 0, None
    none = (0, 0, None)  # score, matches, (place in template, place in text, the match before)
    before = [none] * (width + 1)
    for i, t in enumerate(template):
        now = [none] * (width + 1)
        for d in range(width):
            j = i + center + d - band
            if not 0 <= j < len(words) or words[j] is None:
                continue
            cell = before[d]
            hit = t == words[j]
            cell = (cell[0] + 2, cell[1] + 1, (i, j, cell[2])) if hit else (cell[0] - 1, cell[1], cell[2])
            up = before[d + 1]
            if (up[0] - 1, up[1]) > cell[:2]:
                cell = (up[0] - 1, up[1], up[2])
            if d and (now[d - 1][0] - 1, now[d - 1][1]) > cell[:2]:
                cell = (now[d - 1][0] - 1, now[d - 1][1], now[d - 1][2])
            if cell[0] > 0:
                now[d] = cell
                if hit and (cell[0], -abs(d - band)) > (top, -drift):
                    top, matched, link, drift = cell[0], cell[1], cell[2], abs(d - band)
        before = now
    pairs = []
    while link is not None:
        pairs.append(link[:2])
        link = link[2]
    pairs.reverse()
    return Piece(top, matched, pairs[0][1], pairs[-1][1] + 1, pairs[0][0], pairs[-1][0] + 1, tuple(pairs)) if pairs else Piece(0, 0, 0, 0, 0, 0)


def _in_order(pairs: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The most pairs that rise in template and text."""
    ends: list[int] = []
    link: list[tuple | None] = []
    for j, i in sorted(((j, -i) for i, j in pairs)):
        k = bisect.bisect_left(ends, -i)
        node = (-i, j, link[k - 1] if k else None)
        if k == len(ends):
            ends.append(-i)
            link.append(node)
        else:
            ends[k], link[k] = -i, node
    out, node = [], link[-1] if link else None
    while node is not None:
        out.append(node[:2])
        node = node[2]
    return out[::-1]


def joined(pieces: list[Piece], size: int, gap: int = GAP) -> Iterator[tuple[int, list[Piece]]]:
    """(matched words, pieces) of what pieces of one template make together.

    Pieces at most ``gap`` words apart are a group.  A group that has no more matched words than one copy has (and a
    quarter) is one copy: the most pairs of it that are in order.  Else copies follow each other, and pieces are chained.
    """
    group: list[Piece] = []
    end = 0
    for p in [*sorted(set(pieces), key=lambda p: (p.first, p.end)), None]:
        if p is None or (group and p.first - end > gap):
            points = {x for q in group for x in q.pairs}
            if len(group) > 1 and 4 * len({j for _, j in points}) <= 5 * size:
                kept = tuple(_in_order(points))
                yield len(kept), [Piece(0, len(kept), kept[0][1], kept[-1][1] + 1, kept[0][0], kept[-1][0] + 1, kept)]
            yield from chains(group, gap)
            group = []
        if p is not None:
            group.append(p)
            end = p.end if len(group) == 1 else max(end, p.end)


def chains(pieces: list[Piece], gap: int = GAP) -> list[tuple[int, list[Piece]]]:
    """(matched words, pieces) of the best chain that ends in each piece.

    A piece may follow another that ends before it in template and text, at most ``gap`` words of text apart; where two
    overlap, the larger overlap is taken off, so the matched words of a chain are never too many.
    """
    pieces = sorted(set(pieces), key=lambda p: (p.end, p.template_end, p.first))
    best: list[tuple[int, int | None]] = []
    for i, p in enumerate(pieces):
        total, back = p.matched, None
        for k in range(i - 1, -1, -1):
            q = pieces[k]
            if p.first - q.end > gap or p.end - q.end > gap + p.end - p.first:
                break
            if q.end < p.end and q.template_end < p.template_end and q.first < p.first and q.template_first < p.template_first:
                shared = max(0, q.end - p.first, q.template_end - p.template_first)
                if shared < min(p.matched, q.matched) and best[k][0] + p.matched - shared > total:
                    total, back = best[k][0] + p.matched - shared, k
        best.append((total, back))
    out = []
    for i, (total, _) in enumerate(best):
        chain, at = [], i
        while at is not None:
            chain.append(pieces[at])
            at = best[at][1]
        out.append((total, chain[::-1]))
    return out


def scan_text(text: str, index: Index, least: float = LEAST_COVERAGE) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, first and last + 1 character) of every match, best first where they overlap."""
    if not index.gate.search(text.lower()):
        return []
    words, places = words_of(text)
    votes: dict[int, list[tuple[int, int]]] = {}
    for i, w in enumerate(words):
        if w in index.starters:
            for n in range(1, GRAM_WORDS + 1):
                for t, at in index.postings.get(tuple(words[i : i + n]), ()):
                    votes.setdefault(t, []).append((i - at, i))
    out: list[tuple[str, float, int, int, int]] = []
    free: list[str | None] = list(words)
    while votes:
        found = []
        for t, diagonals in votes.items():
            diagonals.sort()
            last, pieces = None, []
            for d, _ in diagonals:
                if last is not None and d - last <= BAND // 2:
                    continue
                last = d
                pieces.append(align(index.words[t], free, d))
            size = len(index.words[t])
            for matched, chain in joined([p for p in pieces if p.matched], size):
                if matched / size >= least:
                    first, end = chain[0].first, chain[-1].end
                    found.append((-matched, -matched / size, index.names[t], end - first, first, end, chain))
        taken: list[tuple[int, int]] = []
        used: list[Piece] = []
        for matched, coverage, name, _, first, end, chain in sorted(found):
            if all(end <= a or first >= b for a, b in taken):
                taken.append((first, end))
                used += chain
                out.append((name, -coverage, -matched, places[first][0], places[end - 1][1]))
        if not taken:
            break
        for p in used:  # votes outside of what was matched are aligned again, in what is left; long gaps between matches are left too
            at = p.first
            for _, j in p.pairs:
                at = j if j - at > BAND else at
                free[at : j + 1] = [None] * (j + 1 - at)
                at = j + 1
        votes = {t: left for t, own in votes.items() if (left := [v for v in own if free[v[1]] is not None])}
    return sorted(out, key=lambda r: r[3])


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST_COVERAGE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match: ``doc_id, license, coverage, matched_words, start, stop`` (characters).

    Null and empty texts have no match; null ids and repeated rows give their own rows; empty tables and no
    templates give none; of overlapping matches the one with most matched words is reported, then the
    higher coverage, then the first name; other columns are not read.
    """
    given = tuple(sorted(templates.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(given, least)
        for batch in batches:
            rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for m in scan_text(t, index, least)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "license", "coverage", "matched_words", "start", "stop"])

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(releasing(run), "doc_id long, license string, coverage double, matched_words long, start long, stop long")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
