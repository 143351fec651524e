"""Licence scan by a trained paragraph classifier.

Paragraphs are scored by a logistic regression over sparse word n-grams, trained on altered copies of notices of
each licence family and on other text; the other text is a class of its own ("unknown"). A temperature fitted
on held-back paragraphs calibrates the probabilities. A family is reported where it beats the unknown class at
the calibrated threshold, and confirmed where the paragraph shares enough word pairs with one of its templates.
"""

from __future__ import annotations

import bisect
import functools
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

SEED = 5
EXAMPLES = 140  # altered notices per family for training; other text gets eight times as many
MIN_PROBABILITY, MIN_SHARED = 0.6, 0.6
WINDOW, STRIDE = 80, 40  # words of a paragraph that are scored together
GAP = 3  # words that a copy of a notice may put between two of its word pairs
#: Short notices by family.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Released under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "This software is distributed under the BSD 3-Clause License.",
        "Released under the simplified BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Distributed under the GPL version 2 or later.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Released under the LGPL 3.0.",
    ],
    "AGPL": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL v3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Shared under the Creative Commons BY-NC-SA licence for non-commercial use.",
    ],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "This article is distributed under the terms of the Creative Commons Attribution License"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0 Universal Public Domain Dedication.", "Dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Released under the zlib License.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ],
    "Boost": ["Distributed under the Boost Software License, Version 1.0.", "Licensed under the Boost Software License 1.0 (BSL-1.0)."],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0 (EPL-2.0).",
    ],
    "Proprietary": ["All rights reserved.", "Copyright by the authors. All rights reserved. No part of this publication may be reproduced without prior written permission.", "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited."],
}
#: Other text in which words of licences occur.
OTHERS = [
    "The driver showed his license to the officer and was free to go.", "He had permission to leave the building after work.", "The public library will copy the file for a small fee.",
    "Rights and duties of members are set out in the rules of the club.", "They released the new version of the record in spring.", "The software was distributed to all schools in the county.",
    "A fishing licence is needed in this area from May to July.", "General terms of sale apply to all products.", "The source of the river lies in the mountains.", "The commons voted on the bill, and attribution of blame began.",
    "The apache helicopter landed at the base.", "Copyright law is taught in the second year.", "All seats in the hall are reserved for guests.", "You may use the pool without any charge.", "Das Werk wurde mit grosser Sorgfalt erstellt und mit dem Preis bedacht.",
]
STOP = frozenset("the a an of in on to and or is are be by for with at as it this that from was not no any all under you your may can his her he she they we its if".split())
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.+][0-9A-Za-z]+)*")
CLASSES = ["unknown", *TEMPLATES]


def words_of(text: str) -> list[str]:
    """Words of ASCII letters and digits, A-Z lowered."""
    return [w.lower() for w in _WORD.findall(text)]


def _places(text: str) -> list[tuple[str, int, int]]:
    """Words with start and end in the text."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def ngrams(words: list[str]) -> Iterator[str]:
    """Runs of one to three words that hold a word outside the stop list."""
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            run = words[i : i + n]
            if not STOP.issuperset(run):
                yield " ".join(run)


def _altered(rng: random.Random, text: str) -> str:
    """A copy with words dropped, swapped case, a name or year put in, an end cut off, or other words around it."""
    w = text.split()
    if rng.random() < 0.3:
        w = [x for x in w if rng.random() > 0.08] or w
    if rng.random() < 0.2 and len(w) > 12:
        k = rng.randrange(0, len(w) // 2)
        w = w[k : k + rng.randint(8, len(w))]
    if rng.random() < 0.3:
        w.insert(rng.randrange(len(w) + 1), rng.choice(["2019", "(c)", "Copyright 2021", _noise(rng, 1)]))
    if rng.random() < 0.3:
        w = _noise(rng, rng.randint(1, 12)).split() + w
    if rng.random() < 0.3:
        w += _noise(rng, rng.randint(1, 12)).split()
    out = " ".join(w)
    return rng.choice([out, out, out.upper(), out.lower()])


def _noise(rng: random.Random, n: int) -> str:
    parts = "an the er in on re ti ed ha es or en at le de la ei ch um ca mo ri so pa mit of and to a is".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@functools.lru_cache(maxsize=1)
def trained() -> tuple[dict[str, int], np.ndarray, np.ndarray, float]:
    """(n-gram index, weights, biases, temperature); every fifth example is held back for the temperature."""
    rng = random.Random(SEED)
    examples = [(_altered(rng, rng.choice(ts)), CLASSES.index(f)) for f, ts in TEMPLATES.items() for _ in range(EXAMPLES)]
    examples += [(t, CLASSES.index(f)) for f, ts in TEMPLATES.items() for t in ts for _ in range(5)]
    for _ in range(8 * EXAMPLES):
        kind = rng.random()
        base = rng.choice(OTHERS) if kind < 0.5 else _noise(rng, rng.randint(1, 60)) if kind < 0.8 else " ".join(rng.sample([w for ts in TEMPLATES.values() for t in ts for w in t.split()], rng.randint(1, 6)))
        examples.append((_altered(rng, base) if kind < 0.8 else base, 0))
    rng.shuffle(examples)
    fit, held = [e for i, e in enumerate(examples) if i % 5], examples[::5]
    seen = Counter(g for text, _ in fit for g in set(ngrams(words_of(text))))
    of_notices = {w for ts in TEMPLATES.values() for t in ts for w in words_of(t)}
    index = {g: i for i, g in enumerate(sorted(g for g, c in seen.items() if c >= 3 and of_notices.issuperset(g.split())))}

    def matrix(rows: list[tuple[str, int]]) -> np.ndarray:
        x = np.zeros((len(rows), len(index)), np.float32)
        for i, (text, _) in enumerate(rows):
            x[i, vector(index, words_of(text))] = 1
        return x

    x, y = matrix(fit), np.eye(len(CLASSES), dtype=np.float32)[[c for _, c in fit]]
    w, b = np.zeros((len(index), len(CLASSES)), np.float32), np.zeros(len(CLASSES), np.float32)
    pace_w, pace_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(150):  # gradient descent with momentum
        d = (_softmax(x @ w + b) - y) / len(x)
        pace_w, pace_b = 0.9 * pace_w - 2.0 * (x.T @ d + 2e-5 * w), 0.9 * pace_b - 2.0 * d.sum(0)
        w, b = w + pace_w, b + pace_b
    z, truth = matrix(held) @ w + b, [c for _, c in held]
    loss = {t: -np.log(np.maximum(_softmax(z / t)[range(len(truth)), truth], 1e-9)).mean() for t in np.linspace(0.5, 3, 26).tolist()}
    return index, w, b, min(loss, key=loss.get)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def vector(index: dict[str, int], words: list[str]) -> list[int]:
    return sorted({index[g] for g in ngrams(words) if g in index})


@functools.lru_cache(maxsize=1)
def _pairs() -> dict[str, list[set[tuple[str, str]]]]:
    return {f: [set(zip(w, w[1:], strict=False)) for w in map(words_of, ts)] for f, ts in TEMPLATES.items()}


def shared_pairs(family: str, words: list[str]) -> float:
    """Largest share of a template's word pairs that the words hold, or of the words' pairs that a template holds."""
    own = set(zip(words, words[1:], strict=False))
    return max((len(own & t) / min(len(own), len(t)) for t in _pairs()[family] if own and t and len(own & t) > 1), default=0.0)


def stretch(family: str, words: list[str]) -> tuple[int, int]:
    """The longest run of words that one template's word pairs cover, with gaps of at most GAP words; all words if there is none."""
    best = (0, 0)
    for pairs in _pairs()[family]:
        start = end = None
        seen: set[tuple[str, str]] = set()
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            if pair in pairs:
                if end is None or i - end > GAP or pair in seen:  # a pair that comes again begins another notice
                    start, seen = i, set()
                seen.add(pair)
                end = i + 2
                best = max(best, (start, end), key=lambda r: r[1] - r[0])
    return best if best[1] - best[0] > 2 else (0, len(words))


def gaps(family: str, words: list[str]) -> list[tuple[int, int]]:
    """Runs of words that no word pair of the family's templates covers."""
    known = set().union(*_pairs()[family])
    covered = [False] * len(words)
    for i, pair in enumerate(zip(words, words[1:], strict=False)):
        if pair in known:
            covered[i] = covered[i + 1] = True
    edges = [k for k in range(len(words) + 1) if (k < len(words) and not covered[k]) != (k > 0 and not covered[k - 1])]
    return list(zip(edges[::2], edges[1::2], strict=True))


class Scanner:
    def __init__(self, model: tuple) -> None:
        import ahocorasick

        self.index, self.w, self.b, self.heat = model
        self.triggers = ahocorasick.Automaton()
        for word in {w for g in self.index for w in g.split()} - STOP:
            self.triggers.add_word(word, len(word))
        self.triggers.make_automaton()

    def chances(self, words: list[str]) -> np.ndarray | None:
        hits = vector(self.index, words)
        return _softmax((self.w[hits].sum(0) + self.b) / self.heat) if hits else None

    def families(self, words: list[str], at: int) -> Iterator[tuple[int, int, str, float, float]]:
        """(first word, word after the last, family, probability, shared pairs) of all families in one window.

        The stretch that a template of the surest family covers is set apart, and what stands on either side of it
        is scored by itself, and so is what stands in its gaps, with two words before each, so that no family hides
        another.
        """
        p = self.chances(words)
        if p is None or 1 - p[0] < MIN_PROBABILITY:
            return
        k = int(np.argmax(p[1:])) + 1
        i, j = stretch(CLASSES[k], words)
        own = p
        if p[k] < MIN_PROBABILITY:  # families share the window's probability
            own = self.chances(words[i:j])
            k = 0 if own is None else int(np.argmax(own))
        if k and own[k] >= MIN_PROBABILITY:
            part = words if own is p else words[i:j]
            yield at + i, at + j, CLASSES[k], float(own[k]), shared_pairs(CLASSES[k], part)
            for x, y in gaps(CLASSES[k], words[i:j]):
                x, y = max(0, i + x - 2), i + y
                if y - x < len(words):
                    for found in self.families(words[x:y], at + x):
                        if found[4] >= MIN_SHARED and found[2] != CLASSES[k]:
                            yield found
        if j - i < len(words):
            for x, y in ((0, i), (j, len(words))):
                for found in self.families(words[x:y], at + x):
                    if found[4] >= MIN_SHARED:
                        yield found

    def spans(self, words: list[str]) -> list[tuple[int, int, str, float, float, bool]]:
        """(first word, word after the last, family, probability, shared pairs, confirmed); neighbours of one family are one span."""
        found = [f for i in range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE) for f in self.families(words[i : i + WINDOW], i)]
        out: list[list] = []
        last: dict[str, list] = {}
        for i, j, family, p, shared in sorted(found):
            open_ = last.get(family)
            if open_ and i <= open_[1] + STRIDE:
                open_[1], open_[3], open_[4] = max(open_[1], j), max(open_[3], p), max(open_[4], shared)
            else:
                last[family] = [i, j, family, p, shared]
                out.append(last[family])
        return [(*s, s[4] >= MIN_SHARED) for s in out]

    def paragraph(self, text: str) -> tuple[str, float, float, bool] | None:
        """(family, probability, shared pairs, confirmed) of the surest family, a confirmed one first; None if all are unknown."""
        return max((s[2:] for s in self.spans(words_of(text))), key=lambda s: (s[3], s[1]), default=None)

    def scan(self, text: str | None) -> Iterator[tuple[int, int, int, str, float, float, bool]]:
        """Licences: paragraph, start and end of the span in code points, then family, probability, shared pairs, confirmed.

        Every n-gram that weighs anything holds a trigger word, so only paragraphs with one are scored.
        """
        if not text:
            return
        starts, at = [], 0
        for line in text.split("\n"):
            starts.append(at)
            at += len(line) + 1
        lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # lowers A-Z alone, so that places stay
        part = lambda c: c.isascii() and c.isalnum()
        whole = [e for e, n in self.triggers.iter(lower) if (e < n or not part(lower[e - n])) and not part(lower[e + 1 : e + 2])]
        marked = sorted({bisect.bisect_right(starts, e) - 1 for e in whole})
        for k in marked:
            end = starts[k + 1] - 1 if k + 1 < len(starts) else len(text)
            places = _places(text[starts[k] : end])
            for i, j, *found in self.spans([w for w, _, _ in places]):
                yield (k, starts[k] + places[i][1], starts[k] + places[j - 1][2], *found)


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per licence family and span of a paragraph of ``docs`` (a line).

    Columns: doc_id, paragraph, start, end, family, probability, shared, confirmed. Null and empty texts have none.
    Other columns are not read; rows that repeat an id each give their own.
    """
    names = ["doc_id", "paragraph", "start", "end", "family", "probability", "shared", "confirmed"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _from(model)
        for b in batches:
            rows = [(i, *found) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for found in scanner.scan(t)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, paragraph int, start int, end int, family string, probability double, shared double, confirmed boolean")


def _from(model: tuple) -> Scanner:
    """The scanner of a model that came with the task, built once per worker."""
    if getattr(_from, "scanner", None) is None:
        _from.scanner = Scanner(model)
    return _from.scanner


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs in every text of ``documents``."""
    return scan_licences(documents(spark, sf_dir).select("doc_id", "text"))
