"""Licence scans with a trained paragraph classifier.

Paragraphs are lines, and blocks of several lines without a blank line between
them, as licences are wrapped; lines that hold marks only, as in comments, count
as blank.  Of a block counts what lies between the first and the last word pair
that its family's templates have, if that is several lines and BLOCK_COVERED of its
pairs are such; then it takes the place of the lines in it.  A licence that runs into
other text without a blank line is found by its lines alone.

A paragraph's features are its word n-grams of one to
three lower-cased words without the marks around them, by 64-bit hash, weighted
by one over the square root of their number.  Multinomial logistic regression
over the n-grams of the training paragraphs tells the licence families and
ordinary text apart.  It is trained here, on the templates below (whole, with
words dropped, and among other words), on notices made of a phrase and a licence's
name, on sentences that only mention a name, and on made paragraphs of ordinary
text, from a fixed seed; no row of a table is read for it.

A temperature, fitted on made paragraphs that training left out, calibrates the
probabilities.  A paragraph that is likelier a licence than not, but whose best
family has less than CERTAIN, belongs to the class "unknown".  Templates confirm
a prediction: the share of word pairs that the paragraph has in common with the
nearest template of the family, out of the shorter one's, must be CONFIRMED or
more; otherwise the paragraph is "unknown" too.  Without any common pair it is
ordinary text.

A null or empty text has no paragraphs.  Spans are bytes of the UTF-8 text, end
exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.words import Words, bodies, hash_ranges, mix, slices

CERTAIN, CONFIRMED = 0.6, 0.6
#: The least share of a block's word pairs that its family's templates have.
BLOCK_COVERED = 0.5
NGRAM = 3
UNKNOWN = "unknown"

# Wording by which each family of licences announces itself.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "mit": [
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.',
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "isc": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
        "See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "public-domain": [
        "This work is released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work (CC0 1.0 Universal).",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "Copyright Example Corporation. All rights reserved.",
        "Confidential and proprietary. Unauthorized copying or distribution of this file is strictly prohibited.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    ],
}
# The names by which notices call a family's licences, phrases before a name, and phrases that only mention one.
NAMES = {
    "apache": ["the Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0", "the Apache 2 licence", "Apache 2 terms", "the Apache-2.0 license", "the Apache License"],
    "mit": ["the MIT License", "the MIT licence", "MIT", "an MIT license", "MIT terms", "the MIT (Expat) license"],
    "gpl": ["the GNU General Public License", "the GPL", "GPLv3", "the GNU GPL v2", "the GPL version 3", "GPL-2.0"],
    "lgpl": ["the GNU Lesser General Public License", "the LGPL", "LGPLv2.1", "the GNU LGPL version 3", "LGPL-3.0"],
    "agpl": ["the GNU Affero General Public License", "the AGPL", "AGPLv3", "the GNU AGPL version 3", "AGPL-3.0"],
    "bsd": ["the BSD license", "a BSD licence", "the three-clause BSD license", "the 2-clause BSD licence", "the BSD-3-Clause license", "the new BSD License", "BSD terms"],
    "mpl": ["the Mozilla Public License", "the MPL", "MPL 2.0", "the Mozilla Public License 2.0", "the MPL-2.0 licence"],
    "isc": ["the ISC License", "the ISC licence", "ISC terms", "an ISC license"],
    "boost": ["the Boost Software License", "the Boost Software License 1.0", "the Boost licence", "the Boost license, version 1.0"],
    "cc-by": ["CC BY 4.0", "CC-BY", "a Creative Commons Attribution License", "Creative Commons Attribution 4.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC-BY-SA", "a Creative Commons Attribution-ShareAlike license", "Creative Commons Attribution-ShareAlike 3.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC-BY-NC", "a Creative Commons Attribution-NonCommercial license", "Creative Commons Attribution-NonCommercial 4.0"],
    "public-domain": ["the Unlicense", "CC0", "CC0 1.0", "the CC0 dedication"],
}
PHRASES = [
    "Licensed under", "Released under", "This code is distributed under", "Available under", "Code is covered by", "This project is licensed under", "Distributed under the terms of", "The source is made available under", "You may use this file under",
    "This library is released under the terms of", "Published under", "This package is subject to", "The software is licensed under", "All files are under",
]
MENTIONS = [
    "The talk compared {} with others.", "He had never heard of {} before.", "A lawyer explained {} to the class.", "{} was discussed at the meeting.", "Critics of {} wrote a long letter.", "What do people like about {} and why?",
    "The history of {} began long ago.", "Students of law read about {} this year.", "She asked whether {} is popular.", "They argued over {} all night.",
]
# Ordinary words, and ordinary sentences about licences.
COMMON = """
the of and to in a is that it for was on are with as be this have from or had by but not what all were we when your can
said there use an each which she do how their if will up other about out many then them these so some her would make like
him into time has look two more write go see number no way could people my than first been call who its now find long down
day did get come made may part over new sound take only little work know place year live me back give most very after
thing our just name good sentence man think say great where help through much before line right too mean old any same tell
boy follow came want show also around form three small set put end does another well large must big even such because turn
here why ask went men read need land different home us move try kind hand picture again change off play spell air away animal
house point page letter mother answer found study still learn should world high every near add food between own below country
plant last school father keep tree never start city earth eye light thought head under story saw left few while along might
close something seem next hard open example begin life always those both paper together got group often run until state
public general version source software code file copy rights free terms permission notice author commercial
der die und das ist nicht ein eine mit von auf für le la les des et est une dans que qui pour el los las de en una por con
""".split()
ORDINARY = [
    "She renewed her driving license at the public office on Monday.",
    "The new version of the software was released last year under great pressure.",
    "A license plate was found near the house, and the driver had no license.",
    "The general public was free to use the source of the river.",
    "He asked the author for permission to copy the page.",
    "The report describes which version of the file the group read.",
    "Under the terms of the treaty the land was left to the state.",
    "All the rights of the people were written down in the charter.",
]


class Paragraphs:
    """N-grams of the words of a text column, by paragraph; paragraphs without words don't count.

    A word that is lines_apart or more lines below the one before opens a paragraph: 1 for lines, 2 for blocks.  row,
    begin and end tell where each paragraph is and height over how many lines it goes; grams are its n-grams' hashes
    and owner their paragraphs.
    """

    def __init__(self, column: pa.Array, lines_apart: int = 1):
        words = Words(column, lower=True)
        start, end = bodies(words)
        kept = start < words.end
        rows = words.rows[kept]
        start, end = start[kept], end[kept]
        lines = np.concatenate([[0], np.cumsum(words.data == 0x0A)])[start]
        opens = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(lines, prepend=-1) >= lines_apart))
        counts = np.diff(np.append(opens, len(start)))
        self.row = rows[opens]
        self.begin, self.end = start[opens] - words.offsets[self.row], end[opens + counts - 1] - words.offsets[self.row]
        self.height = lines[opens + counts - 1] - lines[opens] + 1
        self._words, self._lines, self._starts, self._ends = opens, lines, start - words.offsets[rows], end - words.offsets[rows]
        of_word = np.repeat(np.arange(len(opens)), counts)
        hashes = hash_ranges(words.data, start, end)
        grams, owner = [hashes], [of_word]
        total = hashes
        for width in range(2, NGRAM + 1):
            total = mix(total[:-1]) + hashes[width - 1 :] if len(total) else total
            inside = of_word[: len(total)] == of_word[width - 1 :]
            grams.append(total[inside] + np.uint64(width))
            owner.append(of_word[: len(total)][inside])
        self.grams, self.owner, self.pairs = np.concatenate(grams), np.concatenate(owner), (grams[1], owner[1])
        self.count = np.bincount(self.owner, minlength=len(self.row))

    def __len__(self) -> int:
        return len(self.row)

    def part(self, at: int, pairs: np.ndarray) -> tuple[int, int, int, float] | None:
        """Of a paragraph, what goes from the first of the given word pairs to the last: begin, end, height, share of its pairs that are given."""
        grams, owner = self.pairs
        hit = np.isin(grams[np.searchsorted(owner, at) : np.searchsorted(owner, at, "right")], pairs)
        if not hit.any():
            return None
        places = np.flatnonzero(hit)
        first, last = self._words[at] + places[0], self._words[at] + places[-1] + 1
        return int(self._starts[first]), int(self._ends[last]), int(self._lines[last] - self._lines[first] + 1), float(hit[places[0] : places[-1] + 1].mean())

    def word_pairs(self, which: np.ndarray) -> list[np.ndarray]:
        """The distinct word pairs of some paragraphs, given in ascending order."""
        grams, owner = self.pairs
        return [np.unique(grams[a:b]) for a, b in zip(np.searchsorted(owner, which), np.searchsorted(owner, which, "right"), strict=True)]


@dataclass
class LicenceModel:
    """vocabulary: sorted hashes; weights: a row for each and a column for each family, ordinary text last."""

    vocabulary: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def __post_init__(self) -> None:
        self._seen = np.zeros(1 << 20, bool)
        self._seen[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def logits(self, paragraphs: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
        """Paragraphs with a known n-gram, and their logits."""
        some = np.flatnonzero(self._seen[(paragraphs.grams >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, paragraphs.grams[some]), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == paragraphs.grams[some]
        owner, at = paragraphs.owner[some[hit]], at[hit]
        which = np.unique(owner)
        place = np.searchsorted(which, owner)
        share = 1 / np.sqrt(np.maximum(1, paragraphs.count[owner]))
        sums = np.stack([np.bincount(place, self.weights[at, k] * share, len(which)) for k in range(len(self.bias))], 1)
        return which, sums + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = np.exp((logits - logits.max(1, keepdims=True, initial=0)) / self.temperature)
        return z / z.sum(1, keepdims=True)


def _made_paragraphs(rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Training paragraphs and their classes."""
    texts, classes = [], []

    def ordinary(n: int) -> list[str]:
        return rng.choice(COMMON, n).tolist()

    for k, family in enumerate(TEMPLATES.values()):
        for template in family:
            words = template.split(" ")
            made = [template] * 3
            for drop in (0.05, 0.1, 0.2):
                made.append(" ".join(w for w in words if rng.random() >= drop))
            for _ in range(3):
                made.append(" ".join([*ordinary(rng.integers(0, 8)), *words, *ordinary(rng.integers(0, 8))]))
            texts += made
            classes += [k] * len(made)
    # words of the templates that don't name a family
    plain = sorted({w for family in TEMPLATES.values() for t in family for w in t.split(" ") if w.isalpha() and w.islower()})
    for k, family in enumerate(TEMPLATES):
        made = [f"{phrase} {name}{rng.choice(['.', '', ', see LICENSE.'])}" for name in NAMES.get(family, ()) for phrase in PHRASES]
        made += [" ".join([*ordinary(rng.integers(0, 4)), *rng.choice(plain, rng.integers(0, 4)), *rng.choice(["under", "by", "under the terms of"]).split(" "), name]) for name in NAMES.get(family, ()) for _ in range(20)]
        texts += made
        classes += [k] * len(made)
    made = [" ".join(ordinary(n)) for n in rng.integers(1, 60, 400)]
    made += [" ".join(w if rng.random() < 0.4 else "".join(rng.choice(list("abcdefghijklmnoprstuvwyz"), rng.integers(2, 9))) for w in ordinary(n)) for n in rng.integers(1, 40, 300)]
    # a few words of a template are no licence
    named = sorted({w for family in TEMPLATES.values() for t in family for w in t.split(" ")})
    made += named + [" ".join([w] * n) for w, n in zip(ordinary(150), rng.integers(2, 30, 150), strict=True)]
    made += [" ".join(rng.choice(named, n).tolist()) for n in rng.integers(2, 4, 300)]
    made += [s for s in ORDINARY for _ in range(6)]
    names = [name for family in NAMES.values() for name in family]
    made += [s.format(name) for name in names for s in MENTIONS]
    made += [" ".join([*ordinary(rng.integers(1, 6)), rng.choice(["about", "of", "than", "with", "that"]), name, *ordinary(rng.integers(1, 6))]) for name in names for _ in range(4)]
    made += [" ".join([*ordinary(5), *s.split(" "), *ordinary(5)]) for s in ORDINARY for _ in range(4)]
    return texts + made, np.array(classes + [len(TEMPLATES)] * len(made))


def _log_loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    z = logits / temperature
    top = z.max(1)
    return float(np.mean(top + np.log(np.exp(z - top[:, None]).sum(1)) - z[np.arange(len(y)), y]))


@lru_cache(1)
def trained(steps: int = 200) -> LicenceModel:
    """The model, fitted to four fifths of the made paragraphs; the rest fits the temperature."""
    rng = np.random.default_rng(23)
    texts, y = _made_paragraphs(rng)
    paragraphs = Paragraphs(pa.array([t or "a" for t in texts]))
    fold = rng.integers(0, 5, len(y))
    vocabulary, at, seen = np.unique(paragraphs.grams, return_inverse=True, return_counts=True)
    vocabulary, at, often = vocabulary[seen > 2], (np.cumsum(seen > 2) - 1)[at], seen[at] > 2
    share = 1 / np.sqrt(paragraphs.count[paragraphs.owner])
    x = np.zeros((len(y), len(vocabulary)), np.float32)
    np.add.at(x, (paragraphs.owner[often], at[often]), share[often])
    wanted = np.eye(len(TEMPLATES) + 1, dtype=np.float32)[y]
    inside = fold > 0
    x, left_out, wanted = x[inside], x[~inside], wanted[inside]
    weights, bias = np.zeros((len(vocabulary), wanted.shape[1]), np.float32), np.zeros(wanted.shape[1], np.float32)
    squares, bias_squares = np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(steps):
        z = x @ weights + bias
        z = np.exp(z - z.max(1, keepdims=True))
        error = (z / z.sum(1, keepdims=True) - wanted) / len(x)
        grad, bias_grad = x.T @ error + 1e-5 * weights, error.sum(0)
        squares += grad**2
        bias_squares += bias_grad**2
        weights -= 0.3 * grad / np.sqrt(squares)
        bias -= 0.3 * bias_grad / np.sqrt(bias_squares)
    left = left_out @ weights + bias
    grid = np.geomspace(0.25, 8, 41)
    temperature = float(grid[np.argmin([_log_loss(left, y[~inside], t) for t in grid])])
    used = np.abs(weights).max(1) > 1e-3
    return LicenceModel(vocabulary[used], weights[used], bias, temperature)


@lru_cache(1)
def _template_pairs() -> list[list[np.ndarray]]:
    out = []
    for name, family in TEMPLATES.items():
        names = NAMES.get(name, ())
        paragraphs = Paragraphs(pa.array([*family, *[x for x in names if " " in x], *[f"{word} {x}" for word in ("under", "by", "of") for x in names]]))
        out.append(paragraphs.word_pairs(np.arange(len(paragraphs))))
    return out


@lru_cache(1)
def _family_pairs() -> list[np.ndarray]:
    """All word pairs of each family's templates."""
    return [np.unique(np.concatenate(pairs)) for pairs in _template_pairs()]


def likeness_to_templates(pairs: np.ndarray, family: int) -> float:
    """The share of word pairs in common with the family's nearest template, out of the shorter one's."""
    return max((float(np.isin(pairs, t).sum()) / max(1, min(len(pairs), len(t))) for t in _template_pairs()[family]), default=0.0)


def _blocks(column: pa.Array, model: LicenceModel) -> list[list[dict]]:
    """The licences among each row's blocks of several lines."""
    found: list[list[dict]] = [[] for _ in range(len(column))]
    blocks = Paragraphs(column, 2)
    if not (blocks.height > 1).any():
        return found
    which, logits = model.logits(blocks)
    p = model.probabilities(logits)
    certain = np.flatnonzero((blocks.height[which] > 1) & (p[:, -1] < 0.5) & (p[:, :-1].max(1, initial=0) >= CERTAIN))
    families = list(TEMPLATES)
    for k in certain.tolist():
        best = int(p[k, :-1].argmax())
        part = blocks.part(which[k], _family_pairs()[best])
        if part and part[2] > 1 and part[3] >= BLOCK_COVERED:
            found[blocks.row[which[k]]].append({"family": families[best], "start": part[0], "end": part[1], "probability": float(p[k, best]), "likeness": part[3]})
    return found


def classify(column: pa.Array, model: LicenceModel) -> list[list[dict]]:
    """For each row its licence paragraphs: family, start, end, probability and likeness to the nearest template, for blocks to all of them."""
    found = _blocks(column, model)
    starts = [np.array([x["start"] for x in row]) for row in found]
    ends = [np.array([x["end"] for x in row]) for row in found]
    paragraphs = Paragraphs(column)
    if not len(paragraphs):
        return found
    which, logits = model.logits(paragraphs)
    p = model.probabilities(logits)
    licence = np.flatnonzero(p[:, -1] < 0.5)
    families = list(TEMPLATES)
    for k, pairs in zip(licence.tolist(), paragraphs.word_pairs(which[licence]), strict=True):
        best = int(p[k, :-1].argmax())
        near = likeness_to_templates(pairs, best)
        if not near:
            continue
        name = families[best] if p[k, best] >= CERTAIN and near >= CONFIRMED else UNKNOWN
        at = which[k]
        row = paragraphs.row[at]
        if ((starts[row] <= paragraphs.begin[at]) & (paragraphs.end[at] <= ends[row])).any():
            continue
        found[row].append({"family": name, "start": int(paragraphs.begin[at]), "end": int(paragraphs.end[at]), "probability": float(p[k, best]), "likeness": near})
    return [sorted(row, key=lambda x: x["start"]) for row in found]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None) -> DataFrame:
    """(id, licences): the licence paragraphs of each row, in text order.

    Every paragraph of every text is classified where it was read; nothing is shuffled.  Equal rows give equal
    results, null and empty texts an empty list; a text is classified whole, however long, and other columns don't matter.
    """
    model = model or trained()
    kind = df.schema[id_col].dataType.simpleString()
    struct = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("likeness", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(classify(part.column("text"), model), struct)], names=[id_col, "licences"])

    schema = f"{id_col} {kind}, licences array<struct<family:string,start:long,end:long,probability:double,likeness:double>>"
    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, schema)
