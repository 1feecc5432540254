"""License scans: a trained classifier of paragraphs, confirmed by comparison with templates.

A paragraph is a line of text, in overlapping stretches of ``STRETCH`` words if it is longer. A multinomial logistic regression over
hashed n-grams of one to three words tells licence families and an unknown class apart. It is trained on variants of the templates (words
dropped, changed, cut off at the ends, between up to a stretch of words of the corpus) and on about ``SAMPLE`` distinct paragraphs of
the corpus, chosen by hash, as unknown. Every family is weighed against unknown on its own; its least probability is calibrated on
variants and paragraphs set aside. A prediction counts when the word pairs of a template of its family are found in the paragraph,
or the paragraph's in the template, to a given share. Of families that match the same words the best match counts, so a
stretch lists several licences if different words name them.

Cases: a null or empty text has no paragraphs. Repeated rows get a row each, repeated paragraphs count each. A text that
quotes several licences lists all. Empty tables give empty results, also for training. Other columns are kept, but for
those named as a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.words import ALNUM, LOWER, Texts, find_words, hash_words, mix, pieces

STRETCH, STEP = 24, 12
BITS = 15
SAMPLE, VARIANTS = 8000, 60
CONFIRM = 0.7
#: Shares of unknown paragraphs that may reach a family's least probability, at most and at least.
MISTAKES = (0.2, 0.1)

#: Notices of licence families as published, one or more per family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "the Apache License, Version 2.0", "the Apache 2.0 license",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License.", "the MIT license", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.", "Distributed under the BSD license.", "the BSD 3-Clause license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "the GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.", "the GNU Affero General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.", "the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.", "the Mozilla Public License",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": [
        "All rights reserved. No part of this work may be reproduced without the prior written permission of the owner.",
        "This file is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
FAMILIES = list(TEMPLATES)

_IN_LINE = np.ones(256, dtype=bool)
_IN_LINE[10] = False


def paragraphs(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, and of each paragraph its row, first word and end."""
    data = LOWER[texts.data]
    words = find_words(Texts(data, texts.offsets), ALNUM)
    line = np.cumsum(data == 10)[words.starts] if len(words.starts) else np.zeros(0, dtype=np.int64)
    symbols = hash_words(data, words)
    new = np.ones(len(symbols), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([begins, [len(symbols)]]))
    count = 1 + np.maximum(0, -(-(sizes - STRETCH) // STEP))
    of = np.repeat(np.arange(len(begins)), count)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    first = begins[of] + nth * STEP
    end = np.minimum(first + STRETCH, begins[of] + sizes[of])
    return symbols, words.doc[begins[of]], first, end


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Feature numbers of the n-grams that begin at each word, for n of 1 to 3; those over the end repeat the first."""
    n = len(symbols)
    out = np.empty((3, n), dtype=np.int64)
    run = np.zeros(n, dtype=np.uint64)
    for j in range(3):
        run = mix(run * np.uint64(0xD6E8FEB86659FD93) + np.concatenate([symbols[j:], symbols[:j]])[:n])
        out[j] = (run >> np.uint64(64 - BITS)).astype(np.int64)
    return out


def _pooled(symbols: np.ndarray, first: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean of the rows of ``table`` over the n-grams of each paragraph."""
    grams, total = _grams(symbols), np.zeros((len(first), table.shape[1]))
    count = np.zeros(len(first))
    for j in range(3):
        sums = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table[grams[j]], axis=0, dtype=np.float64)])
        last = np.maximum(end - j, first)
        total += sums[last] - sums[first]
        count += last - first
    return total / np.sqrt(np.maximum(count, 1))[:, None]


@dataclass
class LicenseModel:
    """Weights of the hashed n-grams (the last class is unknown), and the least probability of each family."""

    weights: np.ndarray
    bias: np.ndarray
    least: np.ndarray

    def promising(self, symbols: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the paragraphs that can reach a least probability, by the best family of every n-gram; loses none."""
        over = self.weights[:, :-1] - self.weights[:, -1:]
        bound = _pooled(symbols, first, end, over.max(1, keepdims=True))[:, 0] + (self.bias[:-1] - self.bias[-1]).max()
        least = np.clip(self.least, 1e-6, 1 - 1e-6).min()
        return np.flatnonzero(bound >= np.log(least / (1 - least)) - 1e-6)

    def against_unknown(self, symbols, first, end) -> np.ndarray:
        """Of each family the probability if there were only it and unknown."""
        raw = _pooled(symbols, first, end, self.weights) + self.bias
        return 1 / (1 + np.exp(np.clip(raw[:, -1:] - raw[:, :-1], -50, 50)))

    def probabilities(self, symbols, first, end) -> np.ndarray:
        raw = _pooled(symbols, first, end, self.weights) + self.bias
        raw = np.exp(raw - raw.max(1, keepdims=True))
        return raw / raw.sum(1, keepdims=True)


def _symbols(text: str) -> np.ndarray:
    body = text.encode()
    data = LOWER[np.frombuffer(body, dtype=np.uint8)]
    return hash_words(data, find_words(Texts(data, np.array([0, len(body)])), ALNUM))


def _sample(df: DataFrame, text: str, sample: int) -> list[np.ndarray]:
    """About ``sample`` distinct lines, chosen by hash; copies of a line are made one before they leave the executors."""
    split = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    total = df.agg(F.sum(F.size(split))).first()[0] or 1
    share = min(1_000_000, int(sample * 1_000_000 / total) + 1)
    lines = df.select(F.explode(split).alias("line")).filter("line <> ''")
    some = lines.filter(F.pmod(F.xxhash64("line"), F.lit(1_000_000)) < share).distinct().limit(2 * sample)
    found = [_symbols(line)[:STRETCH] for line in sorted(r["line"] for r in some.collect())]
    return [c for c in found if len(c)]


def _variant(notice: np.ndarray, foreign: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A notice with words dropped and changed, cut to a stretch if it is longer, or among foreign words."""
    words = notice[rng.random(len(notice)) > 0.06] if len(notice) > 8 else notice.copy()
    swap = rng.random(len(words)) < (0.04 if len(words) > 8 else 0)
    words[swap] = rng.integers(1, 2**63, swap.sum()).astype(np.uint64)
    if len(words) > STRETCH // 2:
        size = int(rng.integers(STRETCH // 2, STRETCH + 1))
        at = int(rng.integers(0, max(1, len(words) - size + 1)))
        words = words[at:at + size]
    room = int(rng.integers(0, max(1, STRETCH - len(words) + 1))) if len(foreign) else 0
    before = int(rng.integers(0, room + 1))
    return np.concatenate([foreign[:before], words, foreign[before:room]])


def fit(df: DataFrame, text: str = "text", sample: int = SAMPLE, variants: int = VARIANTS, seed: int = 11) -> LicenseModel:
    """Train on variants of the templates and about ``sample`` paragraphs of the documents, chosen by hash."""
    corpus = _sample(df, text, sample)
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    notices = [(k, _symbols(t)) for k, family in enumerate(FAMILIES) for t in TEMPLATES[family]]
    known = [set(t.tolist()) for _, t in notices]
    clean = [c for c in corpus if not any(sum(w in t for w in c.tolist()) >= 0.6 * min(len(t), len(c)) for t in known)]
    none = np.zeros(0, dtype=np.uint64)
    for k, notice in notices:
        for v in range(variants):
            some = [clean[i] for i in rng.integers(len(clean), size=6)] if v % 3 and clean else []
            rows.append(_variant(notice, np.concatenate([*some, none])[:STRETCH], rng) if v else notice[:STRETCH])
            labels.append(k)
    for words in clean:
        rows.append(words)
        labels.append(len(FAMILIES))
    y = np.array(labels)
    flat = np.concatenate(rows)
    end = np.cumsum([len(r) for r in rows])
    first = end - np.array([len(r) for r in rows])
    aside = np.arange(len(rows)) % 4 == 0
    model = LicenseModel(np.zeros((1 << BITS, len(FAMILIES) + 1)), np.zeros(len(FAMILIES) + 1), np.full(len(FAMILIES), 2.0))
    grams = _grams(flat)
    owner = np.repeat(np.arange(len(rows)), end - first)
    entry = [(owner[at], grams[j][at]) for j in range(3) for at in [np.flatnonzero(np.arange(len(flat)) + j < end[owner])]]
    row, gram = np.concatenate([e[0] for e in entry]), np.concatenate([e[1] for e in entry])
    scale = 1 / np.sqrt(np.bincount(row, minlength=len(rows)))[row]
    learn = ~aside[row]
    row, gram, scale = row[learn], gram[learn], scale[learn]
    target = np.eye(len(FAMILIES) + 1)[y]
    used, gram = np.unique(gram, return_inverse=True)
    order = np.argsort(gram, kind="stable")
    starts = np.searchsorted(gram[order], np.arange(len(used)))
    moment = np.zeros((len(used), len(FAMILIES) + 1))
    for _ in range(60):
        wrong = np.where(aside[:, None], 0, target - model.probabilities(flat, first, end))
        slope = np.add.reduceat(wrong[row[order]] * scale[order, None], starts, axis=0) if len(used) else moment
        moment = 0.8 * moment + slope - 0.002 * model.weights[used]
        model.weights[used] += 0.05 * moment
        model.bias += 0.02 * wrong.sum(0) / max(len(rows), 1)
    p = model.against_unknown(flat, first, end)[aside]
    of = y[aside]
    for k in range(len(FAMILIES)):
        right, wrong = np.sort(p[of == k, k]), p[of == len(FAMILIES), k]
        floor = right[int(0.01 * len(right))] if len(right) else 0.9
        often, seldom = np.quantile(wrong, [1 - MISTAKES[0], 1 - MISTAKES[1]]) if len(wrong) else (0.0, 0.9)
        # below the weakest variants, as the templates confirm, as long as few paragraphs of the corpus go on to them
        model.least[k] = min(max(0.5 * floor, often), seldom, 0.9)
    return model


class Templates:
    """Word pairs of the templates, for comparison."""

    def __init__(self):
        self.pairs = [[set(self._pairs(_symbols(t))) for t in TEMPLATES[f]] for f in FAMILIES]

    @staticmethod
    def _pairs(symbols: np.ndarray) -> list[tuple]:
        return list(zip(symbols[:-1].tolist(), symbols[1:].tolist()))

    def matches(self, families: list[int], symbols: np.ndarray, confirm: float) -> list[tuple[int, float]]:
        """Families that a paragraph names and the likeness of each.

        Likeness is the largest share of a template's word pairs in the paragraph, or of the paragraph's in a longer template.
        A family counts if most of the words that it matches are not matched better by another one.
        """
        pairs = self._pairs(symbols)
        mine, found = set(pairs), []
        for family in families:
            for template in self.pairs[family]:
                shared = mine & template
                like = len(shared) / max(1, min(len(template), max(len(mine), 4)))
                if like >= confirm and shared:
                    found.append((len(shared), like, family, {i for i, p in enumerate(pairs) if p in shared}))
        # longer matches first: the notice of one licence may hold most words of a shorter one of another
        out, taken = {}, set()
        for _, like, family, places in sorted(found, key=lambda f: (-f[0], -f[1], f[2])):
            if family in out:
                out[family] = max(out[family], like)
                taken |= places
            elif len(places - taken) > 0.5 * len(places):
                out[family] = like
                taken |= places
        return sorted(out.items())


def scan_licenses(df: DataFrame, model: LicenseModel, text: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """Add ``licenses``: per paragraph that holds a notice its ``family``, ``first_word``, ``n_words``, ``probability``, ``likeness``."""
    kind = T.ArrayType(T.StructType([
        T.StructField("family", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("probability", T.DoubleType()), T.StructField("likeness", T.DoubleType())]))
    kept = [f for f in df.schema.fields if f.name != "licenses"]
    names = [f.name for f in kept]
    sent = df.sparkSession.sparkContext.broadcast(model)
    arrow = pa.list_(pa.struct([("family", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                ("probability", pa.float64()), ("likeness", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            for part, texts in pieces(batch, text, 1 << 20):
                symbols, row, first, end = paragraphs(texts)
                found: list[list] = [[] for _ in range(part.num_rows)]
                some = sent.value.promising(symbols, first, end) if len(first) else []
                if len(some):
                    size = end[some] - first[some]
                    edge = np.cumsum(size) - size
                    own = symbols[np.repeat(first[some] - edge, size) + np.arange(size.sum())]
                    p = sent.value.against_unknown(own, edge, edge + size)
                    begin = np.searchsorted(row, np.arange(part.num_rows))
                    passed = p >= sent.value.least
                    for j in np.flatnonzero(passed.any(axis=1)).tolist():
                        i = int(some[j])
                        a, b = int(first[i]), int(end[i])
                        for k, like in templates.matches(np.flatnonzero(passed[j]).tolist(), symbols[a:b], confirm):
                            found[row[i]].append({
                                "family": FAMILIES[k], "first_word": a - int(first[begin[row[i]]]), "n_words": b - a,
                                "probability": float(p[j, k]), "likeness": like})
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(found, type=arrow)], [*names, "licenses"])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField("licenses", kind)]))
