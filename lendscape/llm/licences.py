"""Licence scan by a trained paragraph classifier.

A multinomial logistic regression over sparse word bigrams tells licence
families from each other and from other text (the unknown class). It is trained
on variants of the families' notices and on a bounded sample of paragraphs from
the corpus itself; its probabilities are calibrated by a temperature on held-out
rows. A paragraph is searched by windows of the size of each notice; every
family counts that has a window with enough of one of its notices, more than
what a better covered family shares with it.

The features are the bigrams of the notices: a paragraph with none of them is
unknown without further work. Every paragraph of every text is read.

Defined cases: a NULL text has no paragraph; paragraphs are runs of
lines with words, without their comment marks; a paragraph in which a family is
predicted, but no notice matches, is counted as unconfirmed; repeated rows are scanned one by one; an empty table
gives an empty result, from a model trained without negatives.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import WORD, table, text_of

# Notices by family.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Apache License Version 2.0, January 2004",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU General Public License, version 2.",
    ],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
UNKNOWN = "unknown"
# Parameters
NEGATIVES = 4000  # corpus paragraphs in training, those of smallest hash
LONGEST = 2000  # code points of a training paragraph
VARIANTS = 30  # of every notice
COVERAGE = 0.7  # share of a notice's bigrams that confirms it
PROBABILITY = 0.5
SEED = 5
TOKEN = re.compile(r"[^\W_]+")
MARK = re.compile(r"[^\w\n]*(?:(?:REM|rem|dnl)\b)?")  # in front of a line; other marks hold no words
SPAN = 1.2  # words of a window, by those of the notice
STRIDE = 20  # half a window of the search for unconfirmed ones, which is longer than any notice
RESULT = "doc_id long, n_paragraphs long, n_licensed long, n_unconfirmed long, licences string, probability double"


def bigrams(text: str) -> list[tuple[str, str]]:
    words = TOKEN.findall(text.lower())
    return list(zip(words, words[1:], strict=False))


def paragraphs(text: str) -> Iterator[list[str]]:
    """Words of every run of lines with words."""
    words: list[str] = []
    for line in text.split("\n"):
        found = TOKEN.findall(line[MARK.match(line).end() :].lower())
        if found:
            words += found
        elif words:
            yield words
            words = []
    if words:
        yield words


def vocabulary(notices=NOTICES) -> dict[tuple[str, str], int]:  # noqa: ANN001
    return {g: i for i, g in enumerate(sorted({g for texts in notices.values() for t in texts for g in bigrams(t)}))}


def matching_notice(grams: set, notices: list[set]) -> float:
    """Largest share of one notice's bigrams among ``grams``."""
    return max((len(n & grams) / len(n) for n in notices if n), default=0.0)


def _variants(notice: str, filler: list[str], rng: random.Random) -> Iterator[str]:
    """The notice as it is, with words lost, and inside other text."""
    words = notice.split()
    yield notice
    for i in range(VARIANTS - 1):
        kept = [w for w in words if rng.random() > 0.1 * (i % 3)]
        around = rng.choice(filler).split()[: rng.randrange(0, 40)] if filler and i % 2 else []
        at = rng.randrange(0, len(around) + 1)
        yield " ".join(around[:at] + kept + around[at:])


class Classifier:
    """Coefficients, temperature and notices; small enough for every task."""

    def __init__(self, families: list[str], vocab: dict, weights: np.ndarray, intercepts: np.ndarray, temperature: float, notices: dict):
        self.families, self.vocab, self.weights, self.intercepts, self.temperature = families, vocab, weights, intercepts, temperature
        self.notices = {k: [set(bigrams(t)) for t in v] for k, v in notices.items()}
        self.sized = [(f, len(g), int(SPAN * len(bigrams(t))) + 1) for f, v in notices.items() for t in v for g in [set(bigrams(t))]]
        self.of_gram: dict[int, list[int]] = {}
        for i, grams in enumerate(g for v in self.notices.values() for g in v):
            for gram in grams:
                self.of_gram.setdefault(vocab[gram], []).append(i)

    def probabilities(self, indices: Iterable[int]) -> np.ndarray:
        score = (self.intercepts + self.weights[:, list(indices)].sum(axis=1)) / self.temperature
        odds = np.exp(score - score.max())
        return odds / odds.sum()

    def judge(self, paragraph: str) -> tuple[str, float, bool]:
        """Family, its probability and whether a notice confirms it."""
        words = TOKEN.findall(paragraph.lower())
        known = self.vocab
        hits = {i for g in zip(words, words[1:], strict=False) if (i := known.get(g)) is not None}
        if not hits:
            return UNKNOWN, 1.0, False
        p = self.probabilities(hits)
        best = int(p.argmax())
        family = self.families[best]
        if family == UNKNOWN or p[best] < PROBABILITY:
            return UNKNOWN, float(p[best]), False
        return family, float(p[best]), matching_notice(set(zip(words, words[1:], strict=False)), self.notices[family]) >= COVERAGE


    def _windows(self, hits: list[tuple[int, int]]) -> Iterator[tuple[float, int, int, int, str, list]]:
        """``coverage, size, length, start, family, hits`` of windows that hold enough of a notice."""
        by_notice: dict[int, list[tuple[int, int]]] = {}
        for hit in hits:
            for i in self.of_gram[hit[1]]:
                by_notice.setdefault(i, []).append(hit)
        for i, own in by_notice.items():
            family, size, span = self.sized[i]
            if len(own) < COVERAGE * size:
                continue
            low, held = 0, {}
            for high, (at, gram) in enumerate(own):
                held[gram] = held.get(gram, 0) + 1
                while own[low][0] <= at - span or held[own[low][1]] > 1:
                    held[own[low][1]] -= 1
                    if not held[own[low][1]]:
                        del held[own[low][1]]
                    low += 1
                if len(held) >= COVERAGE * size:
                    yield len(held) / size, size, at - own[low][0], own[low][0], family, own[low : high + 1]

    def search(self, words: list[str]) -> tuple[dict[str, float], bool]:
        """Confirmed families of a paragraph with their probabilities; whether one is predicted where none is confirmed."""
        known = self.vocab
        hits = [(at, i) for at, g in enumerate(zip(words, words[1:], strict=False)) if (i := known.get(g)) is not None]
        if not hits:
            return {}, False
        sure, owner = {}, {}
        # The best covered notice first, in its shortest window; what it holds counts for no other family.
        for _, size, _, _, family, own in sorted(self._windows(hits), key=lambda w: (-w[0], -w[1], *w[2:5])):
            free = [(at, g) for at, g in own if at not in owner]
            if any(owner.get(at) == family for at, _ in own) or len({g for _, g in free}) < COVERAGE * size:
                continue
            p = float(self.probabilities({g for _, g in free})[self.families.index(family)])
            if p < PROBABILITY:
                continue  # the notice only confirms what the classifier predicts
            sure[family] = max(p, sure.get(family, 0.0))
            owner.update((at, family) for at, _ in free)
        if sure:
            return sure, False
        slots: dict[int, set] = {}  # windows of two strides; every hit lies in two
        for at, g in hits:
            for slot in {max(0, at // STRIDE - 1), at // STRIDE}:
                slots.setdefault(slot, set()).add(g)
        for grams in slots.values():
            p = self.probabilities(grams)
            best = int(p.argmax())
            if self.families[best] != UNKNOWN and p[best] >= PROBABILITY:
                return {}, True
        return {}, False


def train(docs: DataFrame, text: str = "text", notices=NOTICES, negatives: int = NEGATIVES, seed: int = SEED) -> Classifier:  # noqa: ANN001
    """Fit on notice variants and at most ``negatives`` corpus paragraphs; every fourth row calibrates."""
    spark = docs.sparkSession
    lines = docs.select(F.explode_outer(F.split(text_of(F.col(text)), "\n")).alias("line"))
    hashed = lines.where(F.col("line").rlike(WORD) & (F.length("line") <= LONGEST)).select(F.xxhash64("line").alias("h"), "line")
    # Only hashes are shuffled; as many as ``negatives`` of them at most come back to the lines.
    chosen = hashed.select("h").distinct().orderBy("h").limit(negatives)
    sample = hashed.join(F.broadcast(chosen), "h", "left_semi").distinct()
    found = [r["line"] for r in sample.orderBy("h", "line").limit(negatives).collect()]
    known = [set(bigrams(t)) for texts in notices.values() for t in texts]
    plain = [t for t in found if matching_notice(set(bigrams(t)), known) < COVERAGE / 2]
    vocab, rng = vocabulary(notices), random.Random(seed)
    families = [*sorted(notices), UNKNOWN]
    rows = [(float(families.index(f)), v) for f in sorted(notices) for t in notices[f] for v in _variants(t, plain, rng)]
    rows += [(float(len(families) - 1), t) for t in plain] + [(float(len(families) - 1), "")]
    vectors = [
        (i % 4 == 3, label, SparseVector(len(vocab), sorted((vocab[g], 1.0) for g in set(bigrams(t)) if g in vocab)))
        for i, (label, t) in enumerate(rows)
    ]
    data = spark.createDataFrame(vectors, ["held", "label", "features"])
    model = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, standardization=False).fit(data.where(~F.col("held")))
    made = Classifier(families, vocab, model.coefficientMatrix.toArray(), model.interceptVector.toArray(), 1.0, notices)

    def loss(temperature: float) -> float:
        made.temperature = temperature
        return -sum(np.log(made.probabilities(v.indices)[int(label)] + 1e-12) for held, label, v in vectors if held)

    made.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8), key=loss)
    return made


def scan(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licences of every row: families that the classifier predicts for a window and a notice confirms."""
    names = pa.schema([("doc_id", pa.int64()), ("n_paragraphs", pa.int64()), ("n_licensed", pa.int64()), ("n_unconfirmed", pa.int64()),
                       ("licences", pa.string()), ("probability", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = model.search  # travels by value with this function, and is as large as the notices
        for batch in batches:
            out = []
            for doc, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                verdicts = [search(words) for words in paragraphs(body)]
                sure: dict[str, float] = {}
                for found, _ in verdicts:
                    for family, p in found.items():
                        sure[family] = max(p, sure.get(family, 0.0))
                out.append(
                    {"doc_id": doc, "n_paragraphs": len(verdicts), "n_licensed": sum(bool(f) for f, _ in verdicts), "n_unconfirmed": sum(u for _, u in verdicts),
                     "licences": ",".join(sorted(sure)), "probability": max(sure.values(), default=None)}
                )
            yield pa.RecordBatch.from_pylist(out, schema=names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(F.col(text)).alias("text")).mapInArrow(run, RESULT)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
