"""Licence notices in texts: word pairs of templates find them, a trained classifier with an unknown class confirms them.

A paragraph is a run of lines that have words, so a notice may be wrapped; it is looked at in overlapping windows of
``WINDOW`` words. Wherever enough of the word pairs of a template stand close together in a window, its family is a
candidate, any number of families in a window. A candidate goes if the text, where it departs from the template, is as
another candidate has it ("CC BY-NC 4.0" is not "CC BY 4.0"); if each does so to the other, the likelier stays. The rest
go to the classifier:
multinomial logistic regression on hashed words and word pairs, trained here on variations of the templates and on
paragraphs of a bounded sample of the documents as the unknown class, its probabilities sharpened or softened by a
temperature fitted on variations not trained on. It looks at the words that matched, and the family is reported if its
probability reaches ``LEAST_CHANCE``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.langid import bounded_sample
from tablegate.llm.store import bounded_batches
from tablegate.llm.text import buffers, chunks, mix, runs, span_hashes

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True

# The notices by which licences are commonly stated, by family.
TEMPLATES = {
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD License",
        "Use of this source code is governed by a BSD-style license",
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0": ["This work is dedicated to the public domain under CC0 1.0 Universal", "Released into the public domain"],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, Version 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "EUPL-1.2": [
        "Licensed under the EUPL, Version 1.2",
        "Licensed under the European Union Public Licence, Version 1.2",
        "SPDX-License-Identifier: EUPL-1.2",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "The MIT License (MIT)",
        "MIT License Copyright (c)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, Version 2.0",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": ["All rights reserved", "Copyright all rights reserved", "Proprietary and confidential"],
}
# Words that tell families apart. A notice must have all words of one of the first lists of its family, and
# none of the second, between its first and its last word.
_FREE = ["affero", "agpl", "lesser", "lgpl", "eclipse", "mozilla"]
MARKS = {
    "AGPL": (["affero", "agpl"], []),
    "Apache-2.0": (["apache"], []),
    "BSD": (["bsd", "redistribution binary forms"], []),
    "CC-BY": (["cc by", "creative commons attribution"], ["nc", "noncommercial", "sa", "sharealike", "nd", "noderivatives"]),
    "CC-BY-NC": (["cc by nc", "attribution noncommercial"], ["sa", "sharealike", "nd", "noderivatives"]),
    "CC-BY-NC-ND": (["cc by nc nd", "attribution noncommercial noderivatives"], []),
    "CC-BY-NC-SA": (["cc by nc sa", "attribution noncommercial sharealike"], []),
    "CC-BY-ND": (["cc by nd", "attribution noderivatives"], ["nc", "noncommercial"]),
    "CC-BY-SA": (["cc by sa", "attribution sharealike"], ["nc", "noncommercial"]),
    "CC0": (["cc0", "public domain"], []),
    "EPL-2.0": (["eclipse", "epl"], []),
    "EUPL-1.2": (["eupl", "european union"], []),
    "GPL": (["gnu general public", "gpl"], _FREE),
    "ISC": (["isc", "permission purpose fee granted"], ["mit"]),
    "LGPL": (["lesser", "lgpl"], ["affero", "agpl"]),
    "MIT": (["mit", "permission granted charge person"], []),
    "MPL-2.0": (["mozilla", "mpl"], []),
    "proprietary": (["rights reserved", "proprietary"], []),
}
UNKNOWN = "unknown"
CLASSES = [*sorted(TEMPLATES), UNKNOWN]
BITS = 16
WINDOW, STEP = 48, 24  # words
LEAST_CHANCE, LEAST_SHARE = 0.5, 0.7
SAMPLE_DOCS, SAMPLE_LINES = 500, 4  # documents that paragraphs of the unknown class come from, paragraphs of each
VARIATIONS, EPOCHS = 60, 12


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters, digits and non-ASCII characters; A-Z lower-cased) and their bounds by text."""
    data, offsets = buffers(column)
    starts, ends = runs(WORD_BYTES[data], offsets)
    return span_hashes(data, starts, ends, lower=True), np.searchsorted(starts, offsets)


def _hashed(text: str) -> np.ndarray:
    return tokens(pa.array([text], pa.string()))[0]


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) if len(words) > 1 else np.empty(0, np.uint64)


def features(words: np.ndarray) -> np.ndarray:
    """Numbers of the distinct words and word pairs."""
    return np.unique(np.concatenate([words, _pairs(words)]) >> np.uint64(64 - BITS)).astype(np.int64)


class Match(NamedTuple):
    """A template found: the share of its word pairs, and the places of these in the paragraph."""

    template: int
    family: str
    share: float
    places: tuple[int, ...]


class Templates:
    """The word pairs of every template, and which of all 64-bit pairs any template has."""

    def __init__(self) -> None:
        self.words = {f: [_hashed(t) for t in texts] for f, texts in TEMPLATES.items()}
        self.pairs = {f: [np.unique(_pairs(w)) for w in texts] for f, texts in self.words.items()}
        self.any = np.unique(np.concatenate([p for texts in self.pairs.values() for p in texts]))
        self.each = [(f, words) for f, texts in self.words.items() for words in texts]
        self.has = np.stack([np.isin(self.any, _pairs(words)) for _, words in self.each])
        self.sizes = self.has.sum(1)
        self.marks = {f: ([_hashed(m) for m in needed], _hashed(" ".join(barred))) for f, (needed, barred) in MARKS.items()}

    def confirmed(self, match: Match, words: np.ndarray) -> bool:
        """Whether the words are there that tell the match's family from others, and none that tell of another."""
        own = words[match.places[0] : match.places[-1] + 2]
        needed, barred = self.marks[match.family]
        return any(np.isin(m, own).all() for m in needed) and not np.isin(barred, own).any()

    def without_marks(self, family: str, words: np.ndarray, other: np.ndarray) -> np.ndarray:
        """A notice with the words exchanged that tell its family: it reads like a licence, but is none that is known."""
        marks = np.concatenate(self.marks[family][0])
        return np.where(np.isin(words, marks), other[: len(words)], words)

    def matches(self, places: np.ndarray, codes: np.ndarray) -> list[Match]:
        """Where enough of a template's word pairs stand together, of the pairs ``any[codes]`` at ascending places."""
        present = np.unique(codes)
        enough = np.flatnonzero(self.has[:, present].sum(1) >= LEAST_SHARE * self.sizes)
        return [m for t in enough for m in self._closest(int(t), places, codes)]

    def _closest(self, template: int, places: np.ndarray, codes: np.ndarray) -> Iterator[Match]:
        """The shortest stretch with most of the template's pairs, and what there is on both sides of it."""
        own = self.has[template][codes]
        pending = [(places[own], codes[own])]
        while pending:
            at, code = pending.pop()
            most = len(np.unique(code))
            if not most or most < LEAST_SHARE * self.sizes[template]:
                continue
            seen: dict[int, int] = {}
            best, start = (1 << 60, 0, 0), 0
            for end, c in enumerate(code.tolist()):
                seen[c] = seen.get(c, 0) + 1
                while seen[int(code[start])] > 1:
                    seen[int(code[start])] -= 1
                    start += 1
                if len(seen) == most:
                    best = min(best, (int(at[end] - at[start]), start, end))
            _, start, end = best
            yield Match(template, self.each[template][0], most / int(self.sizes[template]), tuple(at[start : end + 1].tolist()))
            pending += [(at[:start], code[:start]), (at[end + 1 :], code[end + 1 :])]

    def contradicted(self, match: Match, other: Match, words: np.ndarray) -> bool:
        """Whether the text, where it departs from the template between two of its words, is as the other one has it."""
        own, covered = self.each[match.template][1], set(other.places)
        low, high = match.places[0], match.places[-1] + 2
        there = {(words[p], words[p + 1]) for p in match.places}
        missing = np.array([False, *((u, v) not in there for u, v in zip(own, own[1:])), False])
        edges = np.flatnonzero(missing[1:] != missing[:-1])
        for i, j in zip(edges[::2], edges[1::2]):  # own[i] and own[j] are around the words in question
            ends = low + np.flatnonzero(words[low:high] == own[j])
            for p in (low + np.flatnonzero(words[low:high] == own[i])).tolist():
                if any(all(x in covered for x in range(p, q)) for q in ends[ends > p].tolist()):
                    return True
        return False


class Model:
    def __init__(self, weights: np.ndarray, temperature: float) -> None:
        self.weights, self.temperature = weights, temperature

    def chances(self, numbers: np.ndarray) -> np.ndarray:
        """Probabilities of the classes."""
        logits = (self.weights[numbers].sum(0) + self.weights[-1]) / self.temperature
        chances = np.exp(logits - logits.max())
        return chances / chances.sum()


def _variations(templates: Templates, unknown: list[np.ndarray], draw: np.random.Generator) -> list[tuple[np.ndarray, int]]:
    """Templates with words lost, changed or around them, and paragraphs without any."""
    filler = np.concatenate(unknown) if unknown else np.arange(1, 999, dtype=np.uint64)
    some = lambda n: draw.choice(filler, n)
    out = []
    for family, texts in templates.words.items():
        for text in texts:
            for _ in range(VARIATIONS):
                words = text[draw.random(len(text)) > 0.08] if len(text) > 6 else text
                words = np.where(draw.random(len(words)) < 0.04, some(max(1, len(words)))[: len(words)], words)
                around = draw.integers(0, 14, 2) * (draw.random(2) < 0.5)
                out.append((features(np.concatenate([some(around[0]), words, some(around[1])]).astype(np.uint64)), CLASSES.index(family)))
            for _ in range(VARIATIONS // 3):
                out.append((features(templates.without_marks(family, text, some(len(text)).astype(np.uint64))), CLASSES.index(UNKNOWN)))
    everything = np.concatenate([w for texts in templates.words.values() for w in texts])
    for words in unknown:
        out.append((features(words), CLASSES.index(UNKNOWN)))
        mixed = np.concatenate([words[:20], draw.choice(everything, 2)])  # single words of notices are no notice
        out.append((features(draw.permutation(mixed)), CLASSES.index(UNKNOWN)))
    return [out[i] for i in draw.permutation(len(out))]


def train(unknown: list[np.ndarray]) -> Model:
    """Weights by stochastic gradient steps, then the temperature under which held-out variations are likeliest."""
    draw = np.random.default_rng(3)
    templates = Templates()
    examples, held = _variations(templates, unknown, draw), _variations(templates, unknown, draw)
    model = Model(np.zeros(((1 << BITS) + 1, len(CLASSES)), np.float32), 1.0)
    model.weights[-1, CLASSES.index(UNKNOWN)] = 1.0  # what says nothing is unknown
    for epoch in range(EPOCHS):
        for numbers, label in examples:
            slope = model.chances(numbers)
            slope[label] -= 1
            model.weights[numbers] -= (0.3 / (1 + epoch)) * slope / np.sqrt(max(1, len(numbers)))
    logits = np.stack([model.weights[n].sum(0) + model.weights[-1] for n, _ in held])
    labels = np.array([label for _, label in held])

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        scaled = scaled - scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(1)) - scaled[np.arange(len(labels)), labels]).mean())

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return model


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model whose unknown class is learned from lines of at most ``sample_docs`` documents without a template's words.

    Works without any document too. A line is taken up to a window's length, so what reaches the driver is bounded.
    """
    rows = bounded_batches(docs).select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    sample = bounded_sample(rows, "doc_id", sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates()
        for piece in chunks(batches, "text"):
            found = []
            for text in piece.column(1).to_pylist():
                for line in text.split("\n")[:: max(1, text.count("\n") // SAMPLE_LINES)][:SAMPLE_LINES]:
                    words = _hashed(line)
                    if len(words) > 1 and not np.isin(_pairs(words), known.any).any():
                        found.append(words[:WINDOW].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["words"])

    drawn = sorted(bytes(r["words"]) for r in sample.mapInArrow(run, "words binary").collect())
    return train([np.frombuffer(b, np.uint64) for b in drawn])


def notices(words: np.ndarray, places: np.ndarray, codes: np.ndarray, known: Templates, model: Model) -> Iterator[tuple[Match, float]]:
    """The notices of a paragraph and their probabilities; ``known.any[codes]`` are the template pairs at the places."""
    found: set[Match] = set()
    last = max(1, len(words) - WINDOW + STEP)
    starts = {s for p in (places // STEP * STEP).tolist() for s in (p - STEP, p) if 0 <= s < last}
    for start in sorted(starts):
        a, b = np.searchsorted(places, [start, min(start + WINDOW, len(words)) - 1])
        if b - a > 1:
            found.update(m for m in known.matches(places[a:b], codes[a:b]) if known.confirmed(m, words))
    taken: dict[str, list[Match]] = {}
    for match in sorted(found, key=lambda m: (-m.share, -len(m.places), m.places[0])):
        near = taken.setdefault(match.family, [])
        if all(m.places[-1] < match.places[0] or match.places[-1] < m.places[0] for m in near):
            near.append(match)
    every = [m for near in taken.values() for m in near]

    def chances(places: list[tuple[int, ...]]) -> np.ndarray:
        return model.chances(features(words[np.unique(np.concatenate([x for at in places for x in (at, np.add(at, 1))]))]))

    def goes(match: Match, other: Match) -> bool:
        if not known.contradicted(match, other, words):
            return False
        if not known.contradicted(other, match, words):
            return True
        both = chances([match.places, other.places])
        return bool(both[CLASSES.index(match.family)] < both[CLASSES.index(other.family)])

    for match in every:
        beside = [m for m in every if m.family != match.family and m.places[0] <= match.places[-1] and match.places[0] <= m.places[-1]]
        if not any(goes(match, m) for m in beside):
            chance = float(chances([match.places])[CLASSES.index(match.family)])
            if chance >= LEAST_CHANCE:
                yield match, chance


FOUND = "doc_id long, line_no int, family string, probability double, template_share double"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, line_no, family, probability, template_share) of every notice found, once a line and family.

    Whole texts are read; line_no is the line where the notice begins, from 0. A notice may go on over lines that have words;
    of overlapping matches of a family the fullest counts. Null and empty texts have no paragraphs; repeated rows are
    reported each; a null doc_id stays null. Other columns are not used.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights, temperature = model.weights, model.temperature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = Templates(), Model(weights, temperature)
        for piece in chunks(batches, "text"):
            data, offsets = buffers(piece.column(1))
            words, bounds = tokens(piece.column(1))
            if len(words) < 2:
                continue
            lines = _line_numbers(data, offsets)
            pairs = _pairs(words)
            codes = np.searchsorted(known.any, pairs) % len(known.any)
            hits = np.flatnonzero(known.any[codes] == pairs)
            text_of, line_of = lines
            new = np.ones(len(words), bool)
            new[1:] = (text_of[1:] != text_of[:-1]) | (line_of[1:] > line_of[:-1] + 1)
            run_starts = np.append(np.flatnonzero(new), len(words))
            run_of = np.cumsum(new) - 1
            hits = hits[run_of[hits] == run_of[hits + 1]]
            cuts = np.flatnonzero(np.diff(run_of[hits])) + 1
            found: list[tuple] = []
            for own_hits in np.split(hits, cuts):
                if len(own_hits) < 2:
                    continue
                first = int(run_starts[run_of[own_hits[0]]])
                own_words = words[first : int(run_starts[run_of[own_hits[0]] + 1])]
                best: dict[tuple[int, str], tuple[float, float]] = {}
                for match, chance in notices(own_words, own_hits - first, codes[own_hits], known, own):
                    key = (int(line_of[first + match.places[0]]), match.family)
                    best[key] = max(best.get(key, (0.0, 0.0)), (chance, match.share))
                found += [(int(text_of[first]), line, f, p, s) for (line, f), (p, s) in sorted(best.items())]
            if found:
                text, line, family, chance, share = zip(*found)
                columns = [piece.column(0).take(pa.array(text)), pa.array(line, pa.int32()), pa.array(family), pa.array(chance), pa.array(share)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line_no", "family", "probability", "template_share"])

    return rows.mapInArrow(run, FOUND)


def _line_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of every word and its line in the text."""
    starts, _ = runs(WORD_BYTES[data], offsets)
    breaks = np.flatnonzero(data == 10)
    text = np.searchsorted(offsets, starts, "right") - 1
    return text, np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[text])
