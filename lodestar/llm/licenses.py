"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

A template's class is the power of two at or above its number of words. For each
class present, a text is cut into blocks of half the class's words, and every
three blocks in a row are a window, so an occurrence of a template lies whole in
some window. Templates of fewer than five words are their own only shingle, and
each run of that many words is a window.

Templates of LEAST_BANDED distinct shingles or more have MinHash bands of one row:
window and template share a band if they have the same smallest hash under the
band's hash function. Their number follows from the smallest Jaccard similarity
that such a template and its window may have, so that no band is shared with a
probability of MISS at most. Shorter templates have too few shingles for a
signature: an occurrence holds ``need`` of the m or more, so at least one of any
m - need + 1, and these are their keys.

Keys of the templates set bits in a bitmap of fixed size; windows that it lets
through are joined with the template keys, and every pair is verified:
containment is the share of the template's five-word shingles (words lower-cased,
digits and letters) that the window has.

Defined results: null or wordless texts match nothing; a template without words
matches nothing; a document that holds a template twice gives one row, with its
best and earliest window; rows equal in id and text give one; null ids stay
null; columns other than ids and texts are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import bitmap_of, has_bit, ranked_id, save, steps, strings
from lodestar.llm._text import ALNUM, U, Words, _weights, gathered_words, mix, window_hash, word_hash, words

SHINGLE, BITS = 5, 26
#: Distinct shingles from which on a template is retrieved by bands.
LEAST_BANDED = 5
CONTAINMENT = 0.8
MISS = 4e-6

# Usual license statements, as their licences or common practice give them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
    "mit-conditions": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-short": "Released under the MIT License.",
    # Versions and variants differ in few words, so these begin and end close to what tells them apart.
    "agpl-notice": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-3-clause": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-sa-3.0": "licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "cc-by-sa-4.0": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "has waived all copyright and related or neighboring rights to",
    "epl-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "gpl-2.0-notice": "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    "gpl-2.0-only-notice": "the GNU General Public License version 2 as published by the Free Software Foundation",
    "lgpl-2.1-notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "lgpl-3.0-notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "template string, text string")


def _class(n: np.ndarray) -> np.ndarray:
    """Words below SHINGLE are their own class; else the power of two at or above, 8 at least."""
    return np.where(n < SHINGLE, n, np.maximum(8, 2 ** np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)))


def _shingles(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the shingle that begins at each word (cut at the text's end), and whether it is whole."""
    g = np.zeros(len(h), U)
    whole = np.zeros(len(h), bool)
    if len(h) >= k:
        g[: len(h) - k + 1] = window_hash(h, k, 600 + k)
        left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(len(h))
        whole = left >= k
    return g, whole


def _plan(m: int, cls: int, containment: float) -> tuple[int, int]:
    """Shingle keys and bands of a template of ``m`` distinct shingles; one of the two is 0."""
    need = 1 + int(np.searchsorted(np.arange(1, m + 1) / m, containment))
    if m < LEAST_BANDED:
        return m - need + 1, 0
    return 0, int(np.ceil(np.log(MISS) / np.log1p(-need / (3 * cls // 2 + m - need))))


def _shingle_keys(g: np.ndarray, cls: int) -> np.ndarray:
    return mix(g ^ U(cls << 16 | 0xFFFF))


def _bands(g: np.ndarray, starts: np.ndarray, spans: int, block_doc: np.ndarray, cls: int, bands: int) -> np.ndarray:
    """Band keys of windows of ``spans`` blocks; a row per band, a column per block."""
    keys = []
    for band, a in enumerate(_weights(700, bands)):
        low = np.minimum.reduceat(g * a, starts)
        best = low.copy()
        for s in range(1, spans):
            same = block_doc[s:] == block_doc[:-s]
            best[:-s] = np.where(same, np.minimum(best[:-s], low[s:]), best[:-s])
        keys.append(mix(best ^ U(cls << 16 | band)))
    return np.stack(keys)


def _windows(w: Words, h: np.ndarray, cls: int, bands: int, bitmap: np.ndarray):
    """(first word, text) of each window of a class; (window, key) of those with a key or band that the bitmap has."""
    small = cls < SHINGLE
    k = cls if small else SHINGLE
    g, whole = _shingles(w, h, k)
    at = np.flatnonzero(whole)
    if not len(at):
        return at, at, at, np.zeros(0, U)
    doc = w.doc()[at]
    half, spans = (1, 1) if small else (cls // 2, 3)
    # Blocks of ``half`` shingles from each text's first word on.
    block = (at - w.first[doc]) // half
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (block[1:] != block[:-1])
    starts = np.flatnonzero(new)
    first, text = at[starts], doc[starts]
    keys = _shingle_keys(g[at], cls)
    hit = np.flatnonzero(has_bit(bitmap, keys >> U(64 - BITS)))
    own = np.searchsorted(starts, hit, side="right") - 1
    found, key = [], []
    for s in range(spans):  # a shingle is in the windows that begin with its block or one of the two before
        ok = own >= s
        ok[ok] = text[own[ok] - s] == text[own[ok]]
        found.append(own[ok] - s)
        key.append(keys[hit[ok]])
    if bands:
        banded = _bands(g[at], starts, spans, text, cls, bands)
        band, i = np.nonzero(has_bit(bitmap, banded >> U(64 - BITS)))
        found.append(i)
        key.append(banded[band, i])
    both = np.unique(np.stack([np.concatenate(found).astype(U), np.concatenate(key)]), axis=1)
    return first, text, both[0].astype(np.int64), both[1]


def _template_keys(df: DataFrame, containment: float) -> DataFrame:
    """cls, bands, key and template of each template's keys or bands."""

    def run(batches):
        for b in batches:
            w = words(strings(b.column(1)), ALNUM, lower=True)
            h, n = word_hash(w), np.diff(w.first)
            cls = _class(n)
            for i in np.flatnonzero(n > 0):
                one = Words(w.buf, w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]], np.array([0, n[i]]))
                c = int(cls[i])
                g, whole = _shingles(one, h[w.first[i] : w.first[i + 1]], c if c < SHINGLE else SHINGLE)
                g = np.unique(g[whole])
                few, bands = _plan(len(g), c, containment)
                keys = _bands(g, np.array([0]), 1, np.array([0]), c, bands)[:, 0] if bands else _shingle_keys(g[:few], c)
                k = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(k, x), pa.int32()) for x in (c, bands)), pa.array(keys.view(np.int64)), *(x.take(pa.array([i] * k, pa.int64())) for x in b.columns)],
                    names=["cls", "bands", "key", "template", "template_text"],
                )

    return df.mapInArrow(run, "cls int, bands int, key long, template string, template_text string")


def _candidates(docs: DataFrame, classes: list[tuple[int, int]], bitmap) -> DataFrame:
    """Windows with a key or band that the bitmap has: id, h, cls, key, first word, the window's words."""

    def run(batches):
        for b in steps(batches, "text"):
            w = words(strings(b.column(2)), ALNUM, lower=True)
            h = word_hash(w)
            for cls, bands in classes:
                at, doc, i, key = _windows(w, h, cls, bands, bitmap.value)
                if not len(i):
                    continue
                size = cls if cls < SHINGLE else 3 * cls // 2 + SHINGLE - 1
                pick, back = np.unique(i, return_inverse=True)
                begin = at[pick]
                n = np.minimum(w.first[doc[pick] + 1] - begin, size)
                # The windows' words as texts of their own.
                take = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                sub = Words(w.buf, w.start[take], w.end[take], np.concatenate([[0], np.cumsum(n)]))
                text = gathered_words(sub, np.ones(len(take), bool))
                d = pa.array(doc[i])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(d), b.column(1).take(d), pa.array(np.full(len(i), cls), pa.int32()), pa.array(key.view(np.int64)), pa.array((at - w.first[doc])[i]), text.take(pa.array(back))],
                    names=["id", "h", "cls", "key", "at", "window"],
                )

    return docs.mapInArrow(run, "id long, h long, cls int, key long, at long, window string")


def _verify(pairs: DataFrame) -> DataFrame:
    """Containment of the template's shingles in the window."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n = b.num_rows
            w = words(pa.concat_arrays([strings(b.column(4)), strings(b.column(5))]), ALNUM, lower=True)
            h = word_hash(w)
            size = np.diff(w.first)[n:]
            share = np.zeros(n)
            for k in np.unique(np.minimum(size, SHINGLE)):
                g, whole = _shingles(w, h, int(k))
                side = w.doc()[whole]
                rows = np.minimum(size, SHINGLE)[side % n] == k
                key = np.unique(np.stack([side[rows] % n, side[rows] // n, g[whole][rows].view(np.int64)]), axis=1)
                pair = key[0]
                template = key[1] == 1
                both = np.unique(np.stack([key[0], key[2]]), axis=1, return_counts=True)
                inter = np.bincount(both[0][0][both[1] == 2], minlength=n)
                total = np.bincount(pair[template], minlength=n)
                share = np.where(np.minimum(size, SHINGLE) == k, inter / np.maximum(total, 1), share)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(share)], names=["id", "h", "template", "at", "containment"])

    return pairs.select("id", "h", "template", "at", "window", "template_text").mapInArrow(run, "id long, h long, template string, at long, containment double")


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, *, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, template, containment and first_word of the best window: a row per document and template it holds."""
    known = templates(docs.sparkSession) if known is None else known
    keys = save(_template_keys(known.select("template", "text"), containment), "templates")
    classes = sorted((r["cls"], r["bands"]) for r in keys.groupBy("cls").agg(F.max("bands").alias("bands")).collect())  # at most a few dozen
    bitmap = bitmap_of(keys, "key", BITS)
    rows = docs.select(ranked_id(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    pairs = _candidates(rows, classes, bitmap).join(keys, ["cls", "key"]).drop("cls", "key").dropDuplicates(["id", "h", "template", "at"])
    found = _verify(pairs).filter(F.col("containment") >= containment)
    best = found.groupBy("id", "h", "template").agg(F.max(F.struct("containment", (-F.col("at")).alias("at"))).alias("b"))
    null = F.lit((1 << 63) - 1)
    return best.select(F.when(F.col("id") != null, F.col("id")).alias("doc_id"), "template", F.col("b.containment").alias("containment"), (-F.col("b.at")).alias("first_word"))
