"""Licence texts inside documents: MinHash bands over overlapping windows find templates, exact containment decides.

Templates are grouped by size: class c holds those of 2**(c-1)+1 to 2**c shingles and looks at windows of 2**(c+1) shingles,
2**c apart, so that every run of 2**c shingles lies whole in a window. A window that holds the asked share of a template
then has a Jaccard similarity with it of at least ``least_similarity``; with one MinHash a band, BANDS bands agree at least once
with a probability of COLLISION or more, whatever the template. Retrieved pairs are verified on the shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.text import ALNUM, SHINGLE, blocks, mix, shingles, words

#: The share of a template's shingles that a window must hold.
CONTAINMENT = 0.8
#: The chance that a window holding that share is retrieved.
COLLISION = 0.9995

# Notices as the licences ask for them.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation, either version 3 of the "
                        "License, or (at your option) any later version. This program is distributed in the hope that it "
                        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
                        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
           "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
           "Software.",
}


def least_similarity(share: float = CONTAINMENT) -> float:
    """Of a window of 2**(c+1) shingles and a template of more than 2**(c-1), of which it holds the share: in the worst case
    share * t / (4 * t + (1 - share) * t)."""
    return share / (4 + 1 - share)


def bands(share: float = CONTAINMENT, collision: float = COLLISION) -> int:
    return math.ceil(math.log(1 - collision) / math.log(1 - least_similarity(share)))


def _family(count: int) -> list[tuple[np.uint64, np.uint64]]:
    seeds = mix(np.arange(2 * count, dtype=np.uint64), 51)
    return [(seeds[2 * i], seeds[2 * i + 1] | np.uint64(1)) for i in range(count)]


def _hashed(s: np.ndarray, seed: tuple[np.uint64, np.uint64]) -> np.ndarray:
    x = (s ^ seed[0]) * seed[1]
    return x ^ (x >> np.uint64(29))


class _Index:
    """Templates by class: their sorted shingles, and for each band the sorted MinHashes and whose they are."""

    def __init__(self, templates: Mapping[str, str], share: float, collision: float):
        self.family = _family(bands(share, collision))
        self.names = sorted(templates)
        w = words(pa.array([templates[n] for n in self.names], pa.string()), ALNUM)
        rows, _, hashes = shingles(w, SHINGLE)
        self.sets = [np.unique(hashes[rows == i]) for i in range(len(self.names))]
        self.classes: dict[int, list] = {}
        for i, s in enumerate(self.sets):
            if len(s):
                self.classes.setdefault(math.ceil(math.log2(len(s))), []).append(i)
        self.bands = {c: [(np.array([_hashed(self.sets[i], seed).min() for i in own])) for seed in self.family]
                      for c, own in self.classes.items()}


def _found(index: _Index, w, share: float) -> list[tuple[int, int, float, int, int]]:
    """(row, template, containment, first byte, end byte) of every verified window."""
    rows, at, hashes = shingles(w, SHINGLE)
    out = []
    if not len(hashes):
        return out
    row_begin = np.searchsorted(rows, np.arange(len(w.offsets)))
    width = row_begin[1:] - row_begin[:-1]
    layout = {}
    for c in index.classes:
        step = 1 << c
        per_row = -(-width // step)
        cell_row = np.repeat(np.arange(len(width)), per_row)
        cell = np.arange(len(cell_row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        layout[c] = (row_begin[:-1][cell_row] + cell * step, cell_row)
    candidates: dict[int, set] = {c: set() for c in index.classes}
    for k, seed in enumerate(index.family):
        values = _hashed(hashes, seed)
        for c, (begin, cell_row) in layout.items():
            least = np.minimum.reduceat(values, begin)
            two = least.copy()  # a window is a cell and the next one of its row
            two[:-1] = np.where(cell_row[1:] == cell_row[:-1], np.minimum(least[:-1], least[1:]), least[:-1])
            wanted = index.bands[c][k]
            for hit in np.flatnonzero(np.isin(two, wanted)):
                candidates[c].update((int(hit), index.classes[c][j]) for j in np.flatnonzero(wanted == two[hit]))
    for c, pairs in candidates.items():
        begin, cell_row = layout[c]
        for cell, template in sorted(pairs):
            low = begin[cell]
            high = min(low + (2 << c), row_begin[cell_row[cell] + 1])
            here = np.isin(hashes[low:high], index.sets[template])
            held = len(np.unique(hashes[low:high][here]))
            if held >= share * len(index.sets[template]):
                places = at[low:high][here]
                last = min(int(places.max()) + SHINGLE - 1, int(np.searchsorted(w.doc, cell_row[cell], "right")) - 1)
                out.append((int(cell_row[cell]), template, held / len(index.sets[template]),
                            int(w.start[places.min()]), int(w.end[last])))
    return out


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_column: str = "doc_id", share: float = CONTAINMENT,
         collision: float = COLLISION) -> DataFrame:
    """(doc_id, license, containment, n_matches, start, end): one row for each template found in a row.

    Words are runs of ASCII digits, letters (lowered) and non-ASCII bytes, shingles are five of them (a shorter template's
    whole sequence). ``containment`` is the best window's share of the template's shingles, ``start`` and ``end`` are where its
    matched words stand (code points), and ``n_matches`` counts stretches of overlapping windows. A null or empty text
    matches nothing, nor does a template without words. Repeated rows and null ids give rows as others do. An empty
    table gives none. Templates are a parameter held in memory. Other columns are not looked at.
    """
    fixed = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(fixed, share, collision)
        for block in blocks(batches):
            w = words(block.column("text"), ALNUM)
            best: dict[tuple[int, int], list] = {}
            for row, template, held, start, end in sorted(_found(index, w, share), key=lambda f: (f[0], f[1], f[3], f[4])):
                mine = best.setdefault((row, template), [held, 0, start, end, -1])
                if start >= mine[4]:
                    mine[1] += 1
                mine[4] = max(mine[4], end)
                if held > mine[0]:
                    mine[0], mine[2], mine[3] = held, start, end
            lead = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
            keys = sorted(best)
            places = [[int(lead[best[k][j]] - lead[w.offsets[k[0]]]) for k in keys] for j in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [block.column("id").take(pa.array([k[0] for k in keys], pa.int64())),
                 pa.array([index.names[k[1]] for k in keys], pa.string()), pa.array([best[k][0] for k in keys], pa.float64()),
                 pa.array([best[k][1] for k in keys], pa.int64()), *(pa.array(p, pa.int64()) for p in places)],
                names=["id", "license", "containment", "n_matches", "start", "end"])

    source = docs.select(F.col(id_column).alias("id"), "text")
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, license string, containment double, n_matches bigint, start bigint, "
                                  "end bigint").withColumnRenamed("id", id_column)
