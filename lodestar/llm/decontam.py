"""Benchmark decontamination by winnowing.

An item's windows are its runs of ``window`` words; an item of fewer words is
one window. For items of full windows, every window of 10 words holds six
5-word grams and keeps the smallest gram hash as its fingerprint, so any shared
span of 10 words or more shares a fingerprint. For items of n < 10 words the
gram is the whole item and each gram is kept, with the same guarantee at n.

Fingerprints of the benchmark set bits in a bitmap of fixed size, which every
task gets: it drops document fingerprints that no item has and may let others
through. What passes is joined with the item fingerprints, and a hit is
extended to its window by comparing 128 bits of hash of the window's words.

Defined results: null or wordless texts have no words and no hits; an item
without words has no window; an item without id marks words but isn't listed;
rows equal in id and text count alike; an empty benchmark hits nothing; columns
other than ids and texts are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import bitmap_of, has_bit, ranked_id, save, steps, strings
from lodestar.llm._text import ALNUM, U, window_hash, window_starts, word_hash, words

GRAM = 5
BITMAP_BITS = 26
ROWS = "id long, h long, n_words long, size int, fp long, w1 long, w2 long, starts array<int>"


def _sliding_min(g: np.ndarray, k: int) -> np.ndarray:
    """Smallest of each ``k`` consecutive values."""
    m = g[: len(g) - k + 1].copy()
    for j in range(1, k):
        np.minimum(m, g[j : j + len(m)], out=m)
    return m


def _fingerprints(h: np.ndarray, size: int, gram: int) -> np.ndarray:
    """Per window of ``size`` words: its smallest gram hash."""
    g = window_hash(h, gram, 100 + gram)
    return _sliding_min(g, size - gram + 1) if len(g) >= size - gram + 1 else g[:0]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def _windows(df: DataFrame, sizes: list[int], window: int, bitmap, whole: bool) -> DataFrame:
    """A row per text with its number of words, and rows of windows whose fingerprint the bitmap has.

    ``whole``: texts are items, which have windows of one size only.
    """

    def run(batches):
        bits = None if bitmap is None else bitmap.value
        for b in steps(batches, "text"):
            w = words(strings(b.column(2)), ALNUM, lower=True)
            h = word_hash(w)
            n = np.diff(w.first)
            out = [(np.arange(b.num_rows), n, None)]
            for size in sizes:
                fp = _fingerprints(h, size, GRAM if size == window else size)
                at, doc = window_starts(w.first, size)
                if whole:
                    mine = (n[doc] >= window) if size == window else (n[doc] == size)
                    at, doc = at[mine], doc[mine]
                f = fp[at]
                if bits is not None:
                    hit = has_bit(bits, f >> U(64 - BITMAP_BITS))
                    at, doc, f = at[hit], doc[hit], f[hit]
                if not len(at):
                    continue
                w1, w2 = (window_hash(h, size, s)[at] for s in (200 + size, 300 + size))
                order = np.lexsort((at, w2, w1, doc))
                at, doc, f, w1, w2 = (x[order] for x in (at, doc, f, w1, w2))
                new = np.ones(len(at), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
                i = np.flatnonzero(new)
                out.append((doc[i], None, (size, f[i], w1[i], w2[i], _lists(at - w.first[doc], np.append(i, len(at))))))
            for doc, count, win in out:
                k = len(doc)
                nulls = [pa.nulls(k, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))]
                cols = nulls if win is None else [pa.array(np.full(k, win[0], np.int32)), *(pa.array(x.view(np.int64)) for x in win[1:4]), win[4]]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.nulls(k, pa.int64()) if count is None else pa.array(count, pa.int64()), *cols],
                    names=[c.split()[0] for c in ROWS.split(", ")],
                )

    return df.mapInArrow(run, ROWS)


class Hits(NamedTuple):
    texts: DataFrame  # doc_id (null kept), h, n_words: a row per document
    windows: DataFrame  # id, h, size, starts, item_id: a row per occurring window and item


def find_hits(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> Hits:
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.lit(0).cast("long").alias("h"), F.col(item_text).alias("text"))
    rows = save(_windows(items, list(range(1, window + 1)), window, None, True).filter("size is not null"), "items").drop("h", "n_words", "starts").distinct()
    sizes = sorted(r["size"] for r in rows.select("size").distinct().collect())  # at most ``window`` rows
    bitmap = bitmap_of(rows, "fp", BITMAP_BITS)
    cols = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    found = save(_windows(cols, sizes, window, bitmap, False), "windows")
    texts = found.filter("n_words is not null").select("id", "h", "n_words")
    mine = found.filter("size is not null").select(ranked_id("id").alias("id"), "h", "size", "fp", "w1", "w2", "starts")
    theirs = rows.withColumnRenamed("id", "item_id")
    return Hits(texts, mine.join(theirs, ["size", "fp", "w1", "w2"]).select("id", "h", "size", "starts", "item_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted strings), spans (hit windows as start and size), h (hash of its text)."""
    texts, hits = find_hits(docs, benchmark, **options)
    per = hits.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"), F.collect_set(F.struct("size", "starts")).alias("_spans")
    )
    out = texts.join(per, (ranked_id("id") == F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    none = F.array().cast("array<string>")
    spans = F.flatten(F.transform("_spans", lambda s: F.transform(s["starts"], lambda a: F.struct(a.alias("start"), s["size"].alias("size")))))
    hit = F.size(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.when(F.col("_spans").isNull(), 0).otherwise(hit).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        spans.alias("spans"),
        "h",
    )


def contamination_digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    c = contamination(docs, benchmark, **options)
    return c.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without any occurring window, with all their columns."""
    _, hits = find_hits(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad = hits.select(F.col("id").alias("_id"), F.col("h").alias("_h")).distinct()
    return docs.join(bad, (ranked_id(id_col) == F.col("_id")) & (F.xxhash64(text_col) == F.col("_h")), "left_anti")
