"""License scans: a trained paragraph classifier, sparse word n-gram logistic regression, with templates to confirm.

A paragraph is a line with words, and the lines up to a blank one joined, as notices are wrapped: all of them, and those
side by side whose words mostly stand in templates. Its features are hashed words and word pairs (lower case, punctuation as space). The
classifier is fitted on the driver from variants of the templates below and a bounded sample of paragraphs of the corpus
(FIT_PARAGRAPHS, picked by hash, none that names a licence) as the class of unknown texts; a temperature fitted on held-out rows calibrates it.
Every paragraph of every document is scored where it lies, by sums of weights. A family is confirmed if the paragraph
has enough of one of its templates' words, or that template enough of the paragraph's, words weighing by how few families
have them; if no template of another family, nor one of the notices that are no family's, has more in common with the
paragraph; and if the paragraph has a word or pair that only this family's templates have. Nothing is shuffled but the
sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import prepare
from .words import NORMAL, U64, Slice, mix, slices

# Notices by which the families are known, and parts of their texts.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
        "Released under the GNU Affero General Public License (AGPL), version 3.",
        "Licensed under the AGPL v3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under Apache 2.0.",
        "Released under the Apache License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
        "Licensed under the Boost Software License 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Licensed under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
        "Content is available under CC BY-SA 4.0 unless otherwise noted.",
        *(f"Licensed under CC {x} 4.0." for x in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
        *(f"This work is licensed under a Creative Commons Attribution-{x} 4.0 International License." for x in ("ShareAlike", "NonCommercial", "NoDerivatives", "NonCommercial-ShareAlike", "NonCommercial-NoDerivatives")),
        "Released under CC0 1.0 Universal.",
    ],
    "eclipse": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
        "Licensed under the Eclipse Public License 2.0.",
        "Licensed under the EPL 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Licensed under the GPL v3.",
        "Licensed under the GNU GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "Released under the ISC License.",
        "Licensed under ISC.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "Released under the GNU Lesser General Public License (LGPL), version 3.",
        "Licensed under the LGPL v2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Licensed under MIT.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
        "Released under the MPL 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "reserved": ["All rights reserved.", "Copyright (c) The Authors. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher."],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ],
}
# Notices of no family above, clauses that many licences share and texts about licences; they are unknown.
FOREIGN = {
    "artistic": ["Licensed under the Artistic License 2.0.", "You may use, copy, modify and distribute this package under the terms of the Artistic License."],
    "cddl": ["The contents of this file are subject to the terms of the Common Development and Distribution License. You may not use this file except in compliance with the License.", "Licensed under the CDDL 1.0."],
    "hpnd": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."],
    "psf": ["This license agreement is between the Python Software Foundation, and the individual or organization accessing and otherwise using this software in source or binary form and its associated documentation."],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "Licensed under the zlib License.",
    ],
    "contract": ["This software is licensed, not sold. You may not reverse engineer, decompile, disassemble, rent, lease or lend the software.", "Subject to the terms of this agreement, the licensor grants you a limited, non-exclusive, non-transferable, revocable license to use the software."],
    "warranty": [
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software.",
    ],
    "prose": ["A driver must carry a valid licence.", "The company was sued for copyright infringement.", "The court granted permission to appeal.", "The license fee must be paid every year.", "Licensed under a custom license."],
}
FAMILIES = [*TEMPLATES, "unknown"]
UNKNOWN = len(TEMPLATES)
BUCKETS, FIT_PARAGRAPHS, FIT_DOCUMENTS, VARIANTS, ROUNDS = 1 << 16, 8_000, 2_000, 30, 150
MIN_PROBABILITY, MIN_SHARE, MIN_SHARED = 0.5, 0.6, 6
NAMES = re.compile(r"licen[cs]|copyright|all rights reserved|redistribut|creative commons|spdx|\bcc[ -](by|0)|\b(l|a)?gpl|\b(mit|bsd|mpl)\b", re.I)
FOUND = "doc_id long, n_paragraphs long, n_license long, families string, best_family string, best_probability double, best_share double"


def paragraphs_of(part: Slice) -> np.ndarray:
    """The number of every word's paragraph, counted through the slice: a line end or a document's end closes one."""
    return _breaks(part.data, part.bounds)[part.starts]


def _breaks(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    ends = np.zeros(len(data) + 1, dtype=np.int64)
    ends[np.flatnonzero(data == 0x0A) + 1] = 1
    ends[bounds[:-1]] += 1
    return np.cumsum(ends)


def features(hashes: np.ndarray, paragraph: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, paragraph) of every word and of every pair of neighbours in a paragraph."""
    pairs = np.flatnonzero(paragraph[1:] == paragraph[:-1])
    both = mix(hashes[pairs] * U64(0x9E3779B97F4A7C15) + hashes[pairs + 1])
    return np.concatenate([hashes, both]) & U64(BUCKETS - 1), np.concatenate([paragraph, paragraph[pairs]])


def hashed(texts: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for part in slices(pa.array(texts, pa.string()), table=NORMAL):
        h = part.word_hashes()
        out += [h[part.first_word[d] : part.first_word[d + 1]] for d in range(part.documents)]
    return out


def variants(words: np.ndarray, n: int, rng: np.random.Generator, filler: np.ndarray) -> list[np.ndarray]:
    """The words themselves and n copies with some left out or replaced, cut short or with others around them."""
    out = [words]
    for _ in range(n):
        kept = words[rng.random(len(words)) > rng.choice([0.0, 0.1, 0.2])]
        new = kept.copy()
        if len(filler) and len(new):
            swap = rng.random(len(new)) < rng.choice([0.0, 0.1])
            new[swap] = rng.choice(filler, int(swap.sum()))
            new = np.concatenate([rng.choice(filler, rng.integers(0, 6)), new, rng.choice(filler, rng.integers(0, 6))])
        out.append(new if len(new) else words)
    return out


class Classifier:
    """Weights (BUCKETS, classes), biases and a temperature."""

    def __init__(self, classes: int):
        self.weights, self.bias, self.temperature = np.zeros((BUCKETS, classes), dtype=np.float32), np.zeros(classes), 1.0

    def logits(self, bucket: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        out = np.empty((rows, self.weights.shape[1]))
        for c in range(out.shape[1]):
            out[:, c] = np.bincount(row, weights=self.weights[bucket, c], minlength=rows)
        # by the square root of its number of features, so that a long paragraph isn't sure for its length
        return out / np.sqrt(np.maximum(np.bincount(row, minlength=rows), 1))[:, None] + self.bias

    def probabilities(self, bucket: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        z = self.logits(bucket, row, rows) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, samples: list[np.ndarray], labels: np.ndarray) -> Classifier:
        """AdaGrad on the whole sample; each round is two sums over its sorted features."""
        row = np.repeat(np.arange(len(samples)), [len(s) for s in samples])
        bucket, row = features(np.concatenate(samples), row)
        both, n = np.unique(row * BUCKETS + bucket.astype(np.int64), return_counts=True)
        distinct, place = np.unique(both % BUCKETS, return_inverse=True)
        row, n = both // BUCKETS, n.astype(np.float32)[:, None]
        heads, order = np.searchsorted(row, np.arange(len(samples))), np.argsort(place, kind="stable")
        bucket_heads, row_of, n_of = np.searchsorted(place[order], np.arange(len(distinct))), row[order], n[order]
        held = np.arange(len(samples)) % 5 == 4
        classes = self.weights.shape[1]
        target = np.eye(classes, dtype=np.float32)[labels]
        scale = (1 / np.sqrt(np.maximum(np.add.reduceat(n[:, 0], heads), 1))).astype(np.float32)[:, None]
        weight = 1 / np.maximum(target[~held].sum(axis=0), 1)[labels]  # classes count alike
        weight = np.where(held, 0, weight / weight[~held].sum()).astype(np.float32)[:, None]
        w, seen, seen_bias = np.zeros((len(distinct), classes), dtype=np.float32), np.full((len(distinct), classes), 1e-8, dtype=np.float32), np.full(classes, 1e-8)
        for _ in range(ROUNDS):
            z = np.add.reduceat(w[place] * n, heads, axis=0) * scale + self.bias.astype(np.float32)
            z = np.exp(z - z.max(axis=1, keepdims=True))
            slope = (z / z.sum(axis=1, keepdims=True) - target) * weight
            g = np.add.reduceat((slope * scale)[row_of] * n_of, bucket_heads, axis=0) + 1e-6 * w
            seen += g * g
            w -= 0.3 * g / np.sqrt(seen)
            g = slope.sum(axis=0, dtype=float)
            seen_bias += g * g
            self.bias -= 0.3 * g / np.sqrt(seen_bias)
        self.weights[distinct] = w
        bucket, row = np.repeat(both % BUCKETS, n[:, 0].astype(int)), np.repeat(row, n[:, 0].astype(int))
        z = self.logits(bucket, row, len(samples))[held]
        if len(z):
            losses = {}
            for t in np.geomspace(0.25, 4, 17):
                p = z / t - (z / t).max(axis=1, keepdims=True)
                losses[t] = -np.mean(p[np.arange(len(z)), labels[held]] - np.log(np.exp(p).sum(axis=1)))
            self.temperature = min(losses, key=losses.get)
        return self


class Templates:
    """The templates of all families and the foreign ones, as sets of word hashes, and what only one family has.

    A word weighs log((groups + 1) / groups that have it), a group being a family or a foreign one; other words weigh
    as those of one group.
    """

    def __init__(self):
        groups = [hashed(t) for t in (*TEMPLATES.values(), *FOREIGN.values())]
        self.known = np.unique(np.concatenate([t for own in groups for t in own]))
        self.known_families = np.unique(np.concatenate([t for own in groups[:UNKNOWN] for t in own]))
        self.group = np.repeat(np.arange(len(groups)), [len(own) for own in groups])
        self.has = np.array([np.isin(self.known, t) for own in groups for t in own])
        spread = np.array([self.has[self.group == g].any(axis=0) for g in range(len(groups))]).sum(axis=0)
        self.weight, self.other = np.log((len(groups) + 1) / spread), float(np.log(len(groups) + 1))
        self.whole = self.has @ self.weight
        grams = [np.unique(np.concatenate([_grams(t) for t in own])) for own in groups]
        values, n = np.unique(np.concatenate(grams), return_counts=True)
        alone = values[n == 1]
        self.own = [np.intersect1d(g, alone, assume_unique=True) for g in grams[:UNKNOWN]]

    def compare(self, words: np.ndarray) -> tuple[np.ndarray, float]:
        """(groups, share) of the templates that have the greatest weight in common with the words, of equal ones those of
        the greatest share; the share is that of the template's weight which is in common, or, from MIN_SHARED words
        in common on, that of the words' weight, if greater. To nine digits, so that sums in another order tie too."""
        have = np.unique(words)
        met = np.isin(self.known, have, assume_unique=True)
        common = self.has @ (self.weight * met)
        whole = float(self.weight[met].sum()) + self.other * (len(have) - int(met.sum()))
        share = common / self.whole
        share = np.where(self.has @ met.astype(np.int64) >= MIN_SHARED, np.maximum(share, common / max(whole, 1e-9)), share)
        common, share = np.round(common, 9), np.round(share, 9)
        nearest = common == common.max()
        most = share[nearest].max()
        return self.group[nearest & (share == most)], float(most)

    def confirm(self, family: int, words: np.ndarray) -> float | None:
        """The share, if it is enough, if no other group's template is nearer and the words have the family's own."""
        groups, share = self.compare(words)
        return share if family in groups and share >= MIN_SHARE and np.isin(_grams(words), self.own[family]).any() else None


def _grams(words: np.ndarray) -> np.ndarray:
    return np.concatenate([words, mix(words[:-1] * U64(0x9E3779B97F4A7C15) + words[1:])])


def joined_lines(hashes: np.ndarray, lines: np.ndarray, line: np.ndarray, owner: np.ndarray, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, number of the paragraph) of lines joined, two at least: all up to a blank line or the document's end, then
    those side by side of which MIN_SHARE of the words are known. lines has the lines' numbers in the slice, line the
    place in it of every word, owner the documents."""
    n = len(lines)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (np.diff(lines) > 1) | (owner[1:] != owner[:-1])
    seeds = np.bincount(line, weights=np.isin(hashes, known), minlength=n) >= MIN_SHARE * np.bincount(line, minlength=n)
    parted = fresh.copy()
    parted[1:] |= ~(seeds[1:] & seeds[:-1])
    for first in (fresh, parted):
        number = np.cumsum(first) - 1
        some = (np.bincount(number) > 1)[number[line]]
        yield np.flatnonzero(some), np.unique(number[line][some], return_inverse=True)[1]


def training_rows(paragraphs: list[str], seed: int = 3) -> tuple[list[np.ndarray], np.ndarray]:
    rng = np.random.default_rng(seed)
    others = [h for h in hashed([x for x in paragraphs if not NAMES.search(x)]) if len(h)]
    # paragraphs that are a template nearly whole are no examples of unknown texts
    templates = Templates()
    others = [h for h in others if templates.compare(h)[1] < 0.5]
    filler = np.concatenate(others) if others else np.empty(0, dtype=np.uint64)
    samples, labels = [], []
    for family, own in [*enumerate(TEMPLATES.values()), *((UNKNOWN, x) for x in FOREIGN.values())]:
        for words in hashed(own):
            new = variants(words, VARIANTS, rng, filler)
            samples += new
            labels += [family] * len(new)
    samples += others or hashed(["no text at all"])
    labels += [UNKNOWN] * (len(samples) - len(labels))
    order = rng.permutation(len(samples))
    return [samples[i] for i in order], np.array(labels)[order]


def train(docs: DataFrame, paragraphs: int = FIT_PARAGRAPHS) -> Classifier:
    """Fits on the templates and at most paragraphs paragraphs, in the order of a hash, of about FIT_DOCUMENTS documents
    of docs(doc_id, text), picked by hash."""
    share = FIT_DOCUMENTS / max(docs.count(), 1)
    if share < 1:
        docs = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line")).filter(F.length(F.trim("line")) > 0)
    picked = lines.select("line", F.xxhash64("doc_id", "place", F.lit(5)).alias("h")).orderBy("h", "line").limit(paragraphs)
    samples, labels = training_rows([r.line for r in picked.collect()])
    return Classifier(len(FAMILIES)).fit(samples, labels)


def _notices(model: Classifier, templates: Templates, hashes: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, tuple]]:
    """(first word, last word, (probability, share, family)) of the paragraphs, numbered by row, that are notices."""
    if not len(row):
        return
    rows = int(row[-1]) + 1
    heads = np.searchsorted(row, np.arange(rows + 1))
    bucket, at = features(hashes, row)
    p = model.probabilities(bucket.astype(np.int64), at, rows)
    best = p.argmax(axis=1)
    for i in np.flatnonzero((best != UNKNOWN) & (p.max(axis=1) >= MIN_PROBABILITY)):
        share = templates.confirm(int(best[i]), hashes[heads[i] : heads[i + 1]])
        if share is not None:
            yield int(heads[i]), int(heads[i + 1]) - 1, (float(p[i, best[i]]), share, FAMILIES[best[i]])


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Classifier = shared.value
        templates = Templates()
        names = [x.split()[0] for x in FOUND.split(", ")]
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()] * 2
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            rows = []
            for part in slices(batch["text"], table=NORMAL):
                hashes, numbers = part.word_hashes(), paragraphs_of(part)
                distinct, row = np.unique(numbers, return_inverse=True)
                heads = np.searchsorted(row, np.arange(len(distinct) + 1))
                owner = part.documents_of(heads[:-1]) if len(distinct) else np.empty(0, np.int64)
                hits: dict[int, list[tuple]] = {}
                if len(distinct):
                    alone = [(first, found) for first, _, found in _notices(model, templates, hashes, row)]
                    places = np.array([first for first, _ in alone], dtype=np.int64)
                    taken = [found[2] for _, found in alone]
                    for words, number in joined_lines(hashes, distinct, row, owner, templates.known_families):
                        for first, last, found in _notices(model, templates, hashes[words], number):
                            first, last = words[first], words[last]
                            # a notice that a line or a longer paragraph in its place has shown counts once
                            if found[2] not in [taken[i] for i in np.flatnonzero((places >= first) & (places <= last))]:
                                alone.append((first, found))
                                places, taken = np.append(places, first), [*taken, found[2]]
                    for first, found in alone:
                        hits.setdefault(int(owner[row[first]]), []).append(found)
                n = np.bincount(owner, minlength=part.documents)
                for d in range(part.documents):
                    own = hits.get(d, [])
                    probability, share, family = max(own) if own else (None, None, None)
                    rows.append((ids[part.first_row + d], int(n[d]), len(own), ",".join(sorted({x[2] for x in own})), family, probability, share))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=names)

    return run


def license_families(docs: DataFrame, paragraphs: int = FIT_PARAGRAPHS) -> DataFrame:
    """doc_id, n_paragraphs, n_license, families, best_family, best_probability, best_share for every row of
    docs(doc_id, text): how many lines and
    joined lines (counted once) are licence notices, of which families (sorted, comma-joined; empty if none)
    and the surest of them. Null and empty texts have no paragraphs; rows without doc_id and repeated rows are scanned
    like others. Other columns are not read.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, paragraphs))
    return docs.mapInArrow(_scan(shared), FOUND)
