"""Licence scans: a trained paragraph classifier with template comparison.

Every paragraph (line) of every text, in pieces of at most ``PIECE`` words, is scored by a sparse
logistic regression on hashed word 1- and 2-grams that tells licence notices from other text.
Pieces that may be notices go to a softmax regression over the licence families and an
``unknown`` class, whose probabilities are calibrated by a temperature fitted on examples that
training did not see.  A predicted family counts when the piece's word 3-grams are found in
the family's templates; a notice without such a family is reported as ``unknown``.

A notice may lie anywhere in a line.  Where 3-grams of the templates (or whole templates of two
words) lie close together in a line, they form a stretch, which is scored like a piece of its own,
whatever stands around it and across the pieces' limits.  A stretch counts for a family if it also
has a 3-gram that few families share; without a family it is ``unknown`` if it and the ``AFTER``
words behind it are a notice.  A stretch is reported under the piece that it begins in.

The classifiers are trained on variations of the templates and on a bounded sample of the
corpus's own pieces (``SAMPLE_PIECES``, drawn by hash from any place of their lines; of a piece at
most ``SAMPLE_CHARS`` characters, of the made examples' vocabulary the first 2 000 pieces).  Defined results: null and empty texts
have no pieces; repeated rows give the same rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow.llm.common import mix, texts, word_hashes, word_spans
from scribeflow.llm.decontaminate import _blocks
from scribeflow.llm.windows import _rows

PIECE = 64
BITS = 16
SAMPLE_PIECES, SAMPLE_CHARS = 20_000, 4096
#: A piece is looked at closely from this probability of being a notice.
NOTICE = 0.5
#: A family needs this calibrated probability, and this share of the piece's 3-grams.
SURE, SHARED = 0.5, 0.4
#: A stretch goes on over this many words without a template 3-gram.
GAP, AFTER = 6, 6
#: A 3-gram tells a family from others if at most so many families have it.
FEW = 4
UNKNOWN = "unknown"
_SIZE = 1 << BITS
_PUNCTUATION = bytes(32 if chr(c) in ".,;:!?\"()[]|*#/" else c for c in range(256))

# Names of the licence families and sentences of their notices.
NAMES = {
    "MIT": ["MIT License", "MIT Licence", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL", "GPL-3.0", "GPLv3", "GPL-2.0", "GPLv2"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "LGPL-3.0", "LGPL"],
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL-3.0"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "ISC": ["ISC License", "ISC"],
    "CC0": ["CC0 1.0 Universal", "CC0", "public domain dedication"],
    "CC-BY": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
}
NOTICES = ["Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "This work is licensed under the {}.",
           "This work is licensed under a {}.", "This software is distributed under the terms of the {}.", "This file is available under the {}.",
           "This project is licensed under the {} - see the LICENSE file for details.", "SPDX-License-Identifier: {}",
           "You may use this under the terms of the {}.", "Distributed under {}. See accompanying file."]
SENTENCES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
FAMILIES = [*NAMES, UNKNOWN]


def templates() -> dict[str, list[str]]:
    return {f: [n.format(x) for x in names for n in NOTICES] + SENTENCES.get(f, []) for f, names in NAMES.items()}


@dataclass
class Pieces:
    """Word hashes of all pieces, the pieces' offsets, their rows and numbers in the row, and the
    lines' offsets."""

    words: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    number: np.ndarray
    lines: np.ndarray


def pieces(raw: list[bytes]) -> Pieces:
    lines = [x.split(b"\n") for x in raw]
    flat_lines = [y.translate(_PUNCTUATION) for x in lines for y in x]
    flat = np.frombuffer(b"".join(flat_lines), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in flat_lines], dtype=np.int64)))
    starts, ends, rows = word_spans(flat, offsets)
    h = word_hashes(flat, starts, ends, lower=True)
    cut, _ = _blocks(rows, PIECE)
    line = np.searchsorted(rows[1:], cut, side="right")
    row = np.repeat(np.arange(len(raw)), [len(x) for x in lines])[line]
    first = np.searchsorted(row, np.arange(len(raw)))
    return Pieces(h, np.append(cut, len(h)), row, np.arange(len(cut)) - first[row], rows)


def _numbers(p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece and number of every hashed 1- and 2-gram."""
    n = np.diff(p.offsets)
    of = np.repeat(np.arange(len(n)), n)
    with np.errstate(over="ignore"):
        two = mix(p.words[:-1] * np.uint64(3) + p.words[1:])
    same = of[1:] == of[:-1] if len(of) else np.zeros(0, bool)
    number = np.concatenate((p.words, two[same])) >> np.uint64(64 - BITS)
    return np.concatenate((of, of[1:][same])), number.astype(np.int64)


def grams(p: Pieces, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece and number of every distinct hashed 1- and 2-gram of the wanted pieces, and each
    piece's scale: a word said over and over counts once."""
    piece, number = _numbers(p)
    if wanted is not None:
        keep = wanted[piece]
        piece, number = piece[keep], number[keep]
    key = np.sort(piece * _SIZE + number)
    key = key[np.concatenate(([True], key[1:] != key[:-1]))[:len(key)]]
    piece, number = key // _SIZE, key % _SIZE
    return piece, number, 1 / np.sqrt(np.maximum(np.bincount(piece, minlength=len(p.row)) / 2, 1))


def threes(p: Pieces, k: int) -> np.ndarray:
    """Hashes of the word 3-grams of a piece; a shorter piece is one."""
    w = p.words[p.offsets[k]:p.offsets[k + 1]]
    with np.errstate(over="ignore"):
        return np.unique(mix(w[:-2] * np.uint64(9) + w[1:-1] * np.uint64(3) + w[2:])) if len(w) > 2 else mix(w.sum(keepdims=True, dtype=np.uint64))


@dataclass
class Model:
    notice: np.ndarray
    notice_bias: float
    families: np.ndarray
    bias: np.ndarray
    temperature: float
    known: dict[str, np.ndarray]
    telling: dict[str, np.ndarray]


def _examples(vocabulary: list[str], rng: np.random.Generator, copies: int = 6) -> tuple[list[str], np.ndarray]:
    """Variations of the templates: cropped, with words left out or put in, in other cases.
    Notices with invented names are the unknown class."""
    made, label = [], []
    names = [" ".join(rng.choice(vocabulary, rng.integers(1, 4))).title() + rng.choice([" License", " Licence", "", " License 1.0", " Agreement"]) for _ in range(60)]
    sets = templates() | {UNKNOWN: [n.format(x) for x in names for n in NOTICES]}
    for k, family in enumerate(FAMILIES):
        for text in sets[family]:
            for c in range(copies if family != UNKNOWN else 2):
                w = text.split()
                if c and len(w) > 14:
                    a = int(rng.integers(0, len(w) - 10))
                    w = w[a:a + int(rng.integers(10, len(w) + 1))]
                if c > 2:
                    w = [x for x in w if rng.random() > 0.05]
                if c > 3:
                    w = [*rng.choice(vocabulary, rng.integers(0, 6)), *w, *rng.choice(vocabulary, rng.integers(0, 6))]
                made.append(" ".join(w).upper() if c == 2 else " ".join(w))
                label.append(k)
    return made, np.array(label)


def _descend(piece: np.ndarray, number: np.ndarray, scale: np.ndarray, target: np.ndarray, steps: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression (rows of ``target`` are class shares) by accelerated gradient steps."""
    n, classes = target.shape
    used, place = np.unique(number, return_inverse=True)
    w, b = np.zeros((len(used), classes)), np.zeros(classes)
    look, look_b = w.copy(), b.copy()
    order = np.argsort(place, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(place[order]) > 0)))
    by_piece = np.argsort(piece, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], np.diff(piece[by_piece]) > 0)))
    have = piece[by_piece][begin]
    value = scale[piece][:, None]
    # rows have a squared length near 2, which bounds the curvature
    step = 1 / (0.5 * 3 * n / 4 + l2)
    for k in range(steps):
        z = np.tile(look_b, (n, 1))
        z[have] += np.add.reduceat((look[place] * value)[by_piece], begin, axis=0)
        z -= z.max(1, keepdims=True)
        q = np.exp(z)
        q /= q.sum(1, keepdims=True)
        d = q - target
        g = np.add.reduceat((d[piece] * value)[order], first, axis=0) + l2 * look
        new, new_b = look - step * 20 * g, look_b - step * d.sum(0)
        m = k / (k + 3)
        look, look_b, w, b = new + m * (new - w), new_b + m * (new_b - b), new, new_b
    out = np.zeros((_SIZE, classes), np.float32)
    out[used] = w
    return out, b


def _scores(piece: np.ndarray, number: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    out = np.stack([np.bincount(piece, weights=weights[number, c], minlength=len(scale)) for c in range(weights.shape[1])], axis=1)
    return out * scale[:, None] + bias


def train(others: list[bytes], seed: int = 7) -> Model:
    """``others``: pieces of the corpus."""
    rng = np.random.default_rng(seed)
    known = {}
    for family, texts_ in templates().items():
        own = pieces([x.encode() for x in texts_])
        known[family] = np.unique(np.concatenate([threes(own, k) for k in range(len(own.row))]))
    everything, shared = np.unique(np.concatenate(list(known.values())), return_counts=True)
    telling = {f: x[shared[np.searchsorted(everything, x)] <= FEW] for f, x in known.items()}
    plain = pieces(others)
    # pieces of the corpus that look like templates are no counterexamples
    tells = np.unique(np.concatenate(list(telling.values())))
    own = [threes(plain, k) for k in range(len(plain.row))]
    flat, at = np.concatenate([np.zeros(0, np.uint64), *own]), np.concatenate(([0], np.cumsum([len(x) for x in own], dtype=np.int64)))
    common, tell = (np.diff(np.concatenate(([0], np.cumsum(np.isin(flat, x))))[at]) for x in (everything, tells))
    alike = set(plain.row[(common >= 0.3 * np.diff(at)) | (tell > 0)].tolist())
    clean = [o for k, o in enumerate(others) if len(o) and k not in alike]
    vocabulary = sorted({w for o in clean[:2000] for w in o.decode("utf-8", "ignore").split()})[:4000] or ["work", "open", "free", "data"]
    made, label = _examples(vocabulary, rng)
    raw = [x.encode() for x in made] + clean
    p = pieces(raw)
    label = np.concatenate((label, np.full(len(clean), -1)))[p.row]
    piece, number, scale = grams(p)
    held = rng.random(len(label)) < 0.2
    notice = (label >= 0).astype(float)
    fit = ~held

    def part(keep: np.ndarray, target: np.ndarray, steps: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
        place = np.cumsum(keep) - 1
        own = keep[piece]
        return _descend(place[piece[own]], number[own], scale[keep], target[keep], steps, l2)

    w2, b2 = part(fit, np.stack((1 - notice, notice), axis=1), 60, 0.5)
    one = np.eye(len(FAMILIES))[np.maximum(label, 0)]
    wk, bk = part(fit & (label >= 0), one, 150, 0.05)
    check = held & (label >= 0)
    z = _scores(piece, number, scale, wk, bk)[check]
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.05, 5, 40):
        s = z / t
        s = s - s.max(1, keepdims=True)
        loss = float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), label[check]]).mean())
        if loss < best:
            best, temperature = loss, float(t)
    return Model((w2[:, 1] - w2[:, 0]).astype(np.float32), float(b2[1] - b2[0]), wk, bk, temperature, known, telling)


def sample(docs: DataFrame, most: int = SAMPLE_PIECES) -> list[bytes]:
    """Pieces of the corpus, at most ``most``, drawn by hash: texts, then their lines, then a piece of each."""
    rows = docs.count()
    share = min(1.0, 4 * most / 10 / max(1, rows))
    some = texts(docs).where(F.xxhash64("doc_id", F.lit("licence")) / F.lit(2.0 ** 64) + 0.5 < share)
    lines = some.select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line")).where("length(trim(line)) > 0")
    drawn = lines.orderBy(F.xxhash64("doc_id", "k", "line"), "doc_id", "k").limit(most)
    parted = drawn.select(F.filter(F.split("line", r"[\s.,;:!?\"()\[\]|*#/]+"), lambda w: w != "").alias("w"),
                          F.xxhash64("line", "doc_id", "k", F.lit("piece")).alias("h"))
    at = F.pmod("h", F.greatest(F.lit(1), F.ceil(F.size("w") / PIECE))).cast("int") * PIECE + 1
    piece = F.array_join(F.slice("w", at, PIECE), " ")
    return [r["piece"].encode() for r in parted.select(F.substring(piece, 1, SAMPLE_CHARS).alias("piece")).collect()]


def _weighed(p: Pieces, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    piece, number = _numbers(p)
    return piece, weights[number]


def _near(grams_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the hashes that are wanted."""
    table = np.zeros(_SIZE, bool)
    table[(wanted >> np.uint64(64 - BITS)).astype(np.int64)] = True
    at = np.flatnonzero(table[(grams_ >> np.uint64(64 - BITS)).astype(np.int64)])
    return at[np.isin(grams_[at], wanted)]


def stretches(p: Pieces, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and line of the stretches of template 3-grams in each line."""
    w, wanted = p.words, np.unique(np.concatenate(list(model.known.values())))
    line = np.repeat(np.arange(len(p.lines) - 1), np.diff(p.lines))
    begin, length = [], []
    with np.errstate(over="ignore"):
        # as ``threes`` has them; a template of two words is one hash
        for n, hashes in ((3, mix(w[:-2] * np.uint64(9) + w[1:-1] * np.uint64(3) + w[2:])), (2, mix(w[:-1] + w[1:]))):
            at = _near(hashes, wanted)
            begin.append(at[line[at] == line[at + n - 1]])
            length.append(np.full(len(begin[-1]), n))
    begin, length = np.concatenate(begin), np.concatenate(length)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], (begin + length)[order]
    if not len(begin):
        return begin, end, begin
    end = np.maximum.accumulate(end)
    new = np.concatenate(([True], (line[begin[1:]] != line[begin[:-1]]) | (begin[1:] - end[:-1] > GAP)))
    first = np.flatnonzero(new)
    return begin[first], end[np.append(first[1:], len(end)) - 1], line[begin[first]]


def _cut(p: Pieces, begin: np.ndarray, end: np.ndarray) -> Pieces:
    """Ranges of words as pieces, with row and number of the piece that they begin in."""
    n = end - begin
    offsets = np.concatenate(([0], np.cumsum(n)))
    of = np.searchsorted(p.offsets, begin, side="right") - 1
    return Pieces(p.words[np.repeat(begin - offsets[:-1], n) + np.arange(offsets[-1])], offsets, p.row[of], p.number[of], offsets)


def _judged(p: Pieces, model: Model, telling: bool = False) -> list[tuple[int, str, float, float]]:
    """Piece, family, probability and share of the templates' 3-grams of the notices."""
    # no piece scores higher than all its positive weights together
    most = np.bincount(*_weighed(p, np.maximum(model.notice, 0)), minlength=len(p.row)) + model.notice_bias
    piece, number, scale = grams(p, most >= np.log(NOTICE / (1 - NOTICE)))
    z = np.bincount(piece, weights=model.notice[number], minlength=len(scale)) * scale + model.notice_bias
    found = np.flatnonzero(z >= np.log(NOTICE / (1 - NOTICE)))
    out = []
    if len(found):
        place = np.full(len(scale), -1)
        place[found] = np.arange(len(found))
        own = place[piece] >= 0
        s = _scores(place[piece[own]], number[own], scale[found], model.families, model.bias) / model.temperature
        s = np.exp(s - s.max(1, keepdims=True))
        s /= s.sum(1, keepdims=True)
        for k, q in zip(found.tolist(), s):
            own3 = threes(p, k)
            share = {f: float(np.isin(own3, t).mean()) for f, t in model.known.items()}
            # the likeliest family whose template agrees; notices of two families may share words
            ranked = [FAMILIES[c] for c in np.argsort(-q, kind="stable")]
            name = ranked[0]
            if name == UNKNOWN or q.max() < SURE or share[name] < SHARED or (telling and not np.isin(own3, model.telling[name]).any()):
                name = UNKNOWN
            out.append((k, name, float(q.max()), max(share.values()) if name == UNKNOWN else share[name]))
    return out


def scan_rows(raw: list[bytes], model: Model) -> list[tuple[int, int, str, float, float, int]]:
    """Row, piece, family, probability, share of the templates' 3-grams, words; for notices."""
    p = pieces(raw)
    if not len(p.row):
        return []
    out = {}

    def add(q: Pieces, k: int, *rest) -> None:
        out.setdefault((int(q.row[k]), int(q.number[k]), rest[0]), (*rest, int(q.offsets[k + 1] - q.offsets[k])))

    whole = _judged(p, model)
    named = np.zeros(len(p.row), bool)
    named[[k for k, name, *_ in whole if name != UNKNOWN]] = True
    begin, end, line = stretches(p, model)
    # what a piece with a family has wholly is settled
    first, last = (np.searchsorted(p.offsets, x, side="right") - 1 for x in (begin, end - 1))
    open_ = ~(named[first] & (first == last))
    begin, end, line, first, last = begin[open_], end[open_], line[open_], first[open_], last[open_]
    inside, left = _cut(p, begin, end), np.ones(len(begin), bool)
    settled = named.copy()
    for k, name, *rest in _judged(inside, model, telling=True) if len(begin) else []:
        if name != UNKNOWN:
            left[k], settled[first[k]:last[k] + 1] = False, True
            add(inside, k, name, *rest)
    # a piece is not unknown for the part of a notice that it has
    for k, name, *rest in whole:
        if name != UNKNOWN or not settled[k]:
            add(p, k, name, *rest)
    left &= ~named[first]
    if left.any():
        longer = _cut(p, begin[left], np.minimum(end[left] + AFTER, p.lines[line[left] + 1]))
        for k, _, *rest in _judged(longer, model, telling=True):
            add(longer, k, UNKNOWN, *rest)
    return [(r, n, *rest) for (r, n, _), rest in out.items()]


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, piece, family, probability, template_share, n_words of every notice."""
    model = model or train(sample(docs))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, raw in _rows(batches):
            found = [(ids[r], *rest) for r, *rest in scan_rows(raw, sent.value)]
            if found:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)],
                                                 names=["doc_id", "piece", "family", "probability", "template_share", "n_words"])

    return texts(docs).withColumn("rk", F.lit(0).cast("long")).mapInArrow(
        part, "doc_id long, piece long, family string, probability double, template_share double, n_words long")
