"""Substring deduplication: repeated runs of words are removed wherever they occur again.

A window is ``window`` consecutive words of one document. Pass one counts window
hashes in a count-min sketch: each task emits sparse, gap-coded partial sketches
by slice, slices are merged by Spark, and of the merged sketch only one bit per
cell is kept (counted twice or more). The sketch has a fixed size, ``2 x 2^28``
cells, whatever the corpus holds: it overestimates, so a fuller sketch lets more
windows through but never loses a repeated one. Pass two groups the windows that
are estimated repeated by 96 bits of hash, exactly: each task first keeps one
occurrence per distinct window, and only those are dealt out by hash. Every
occurrence but the earliest (smallest id, then start) covers its words, and
covered words are removed.

Defined results: null or wordless texts keep no words; rows of equal id tie and
don't remove each other's words at the same place; a null id comes after all
others; an empty table gives no rows; columns not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import binaries, ranked_id, save, shuffle_width, steps, strings
from lodestar.llm._text import U, gathered_words, mix, window_hash, window_starts, word_hash, words

WIDTH_BITS = 28
DEPTH = 2
SLICE_BITS = 22
#: Windows that a task holds before it emits, and that one reducing step may hold.
FLUSH = 2_000_000
SLICE_WINDOWS = 4_000_000


def gaps(sorted_values: np.ndarray) -> np.ndarray:
    """Ascending integers as bytes: gaps, where 255 adds 255 and goes on."""
    g = np.diff(sorted_values.astype(np.int64), prepend=0)
    more = g // 255
    out = np.full(len(g) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = g - more * 255
    return out


def ungaps(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(raw, dtype=np.int64)[raw != 255]


def _cells(h: np.ndarray, row: int) -> np.ndarray:
    """Cell of each hash in one row of the sketch: 28 bits that no other row uses."""
    return (h >> U(36 if row == 0 else 4)) & U((1 << WIDTH_BITS) - 1)


def _hashed(batches, window: int):
    """Per step of text: (batch, first word of each text, window starts, their text, h1)."""
    for b in steps(batches, "text"):
        w = words(strings(b.column(b.schema.get_field_index("text"))))
        h = word_hash(w)
        at, doc = window_starts(w.first, window)
        yield b, w, at, doc, window_hash(h, window, 1)[at], h


def sketch(texts: DataFrame, window: int) -> tuple[bytearray, int]:
    """The merged sketch (a bit per cell: counted twice or more) and the number of windows."""

    def partial(batches):
        held, n = [], 0

        def flush():
            h = np.concatenate(held)
            for row in range(DEPTH):
                c = np.sort(_cells(h, row).astype(np.uint32))
                c = c[np.concatenate([[True, True], c[2:] != c[:-2]])[: len(c)]]  # a cell twice at most
                edge = np.searchsorted(c, np.arange((1 << (WIDTH_BITS - SLICE_BITS)) + 1, dtype=np.int64) << SLICE_BITS)
                for s in np.flatnonzero(np.diff(edge)):
                    part = gaps(c[edge[s] : edge[s + 1]] & ((1 << SLICE_BITS) - 1))
                    yield row << (WIDTH_BITS - SLICE_BITS) | int(s), part.tobytes()

        def out(rows):
            rows = list(rows)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([n] + [0] * (len(rows) - 1), pa.int64())], names=["slice", "cells", "n"])

        for *_, h1, _ in _hashed(batches, window):
            if len(h1):
                held.append(h1)
                n += len(h1)
            if n > FLUSH:
                yield out(flush())
                held, n = [], 0
        if n:
            yield out(flush())

    def merge(batches):
        # One slice comes after the other; only the current one is held.
        now, once, twice, n = None, None, None, 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["slice", "cells", "n"])

        for b in batches:
            for s, raw, k in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                if s != now:
                    if now is not None:
                        yield done()
                    now, once, twice, n = s, np.zeros(1 << SLICE_BITS, bool), np.zeros(1 << SLICE_BITS, bool), 0
                c = ungaps(np.frombuffer(raw.as_buffer(), np.uint8))
                twice[c[1:][c[1:] == c[:-1]]] = True
                twice[c] |= once[c]
                once[c] = True
                n += k
        if now is not None:
            yield done()

    slices = DEPTH << (WIDTH_BITS - SLICE_BITS)
    parts = texts.select("text").mapInArrow(partial, "slice int, cells binary, n long")
    merged = parts.repartitionById(slices, F.col("slice")).mapInArrow(merge, "slice int, cells binary, n long")
    bits = bytearray(slices << (SLICE_BITS - 3))  # 64 MB, the sketch's fixed size
    total = 0
    merged = save(merged, "sketch")
    for i in range(0, slices, 16):  # a few MB at a time
        for r in merged.filter(F.col("slice").between(i, i + 15)).collect():
            bits[r["slice"] << (SLICE_BITS - 3) : (r["slice"] + 1) << (SLICE_BITS - 3)] = r["cells"]
            total += r["n"]
    return bits, total


def _repeated(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Estimated twice or more: the bit is set in every row."""
    ok = np.ones(len(h), bool)
    for row in range(DEPTH):
        c = _cells(h, row) | U(row << WIDTH_BITS)
        ok &= (bits[(c >> U(3)).astype(np.int64)] >> (c & U(7)).astype(np.uint8)) & 1 > 0
    return ok


MARKS = "id long, h long, starts binary"


def _marks(id_: np.ndarray, h: np.ndarray, start: np.ndarray) -> pa.RecordBatch | None:
    """Starts of removed windows, a row per document."""
    if not len(id_):
        return None
    order = np.lexsort((start, h, id_))
    id_, h, start = id_[order], h[order], start[order]
    new = np.ones(len(id_), bool)
    new[1:] = (id_[1:] != id_[:-1]) | (h[1:] != h[:-1])
    i = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays([pa.array(id_[i]), pa.array(h[i]), binaries(start.astype("<u4"), np.append(i, len(start)))], names=["id", "h", "starts"])


def _first_of(h1, h2, id_, h, start):
    """Order that groups equal windows by place; whether each is at its group's earliest place; one such entry per text of a group."""
    order = np.lexsort((start, id_, h2, h1))
    h1, h2, id_, h, start = h1[order], h2[order], id_[order], h[order], start[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    group = np.cumsum(new) - 1
    lead = np.flatnonzero(new)
    earliest = (id_ == id_[lead][group]) & (start == start[lead][group])
    return order, earliest, new | (earliest & (h != h[lead][group]))


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """``MARKS`` of every window whose words also start earlier. ``texts``: id, h, text."""
    spark = texts.sparkSession
    raw, total = sketch(texts, window)
    shared = spark.sparkContext.broadcast(raw)
    slices = max(shuffle_width(spark), -(-total // SLICE_WINDOWS))

    def candidates(batches):
        from pyspark import TaskContext

        bits = np.frombuffer(shared.value, np.uint8)
        turn = TaskContext.get().partitionId()
        held, n = [], 0

        def flush():
            nonlocal turn
            h1, h2, id_, h, start = (np.concatenate(x) for x in zip(*held))
            order, earliest, kept = _first_of(h1, h2, id_, h, start)
            again = order[~earliest]
            rows = []
            m = _marks(id_[again], h[again], start[again])
            if m is not None:  # settled here; the reducer passes it on
                turn += 1
                rows.append((turn % slices, None, m))
            keep = order[kept]
            s = (h1[keep] % U(slices)).astype(np.int64)
            o = np.lexsort((start[keep], h[keep], id_[keep], s))
            keep, s = keep[o], s[o]
            edge = np.searchsorted(s, np.arange(slices + 1))
            for k in np.flatnonzero(np.diff(edge)):
                rows.append((int(k), keep[edge[k] : edge[k + 1]], None))
            for k, i, m in rows:
                if m is not None:
                    lens = np.diff(np.frombuffer(m.column(2).buffers()[1], np.int32)[: m.num_rows + 1]) // 4
                    yield k, m.column(0).to_numpy().tobytes(), m.column(1).to_numpy().tobytes(), lens.astype("<u4").tobytes(), b"", b"", b"".join(m.column(2).to_pylist())
                    continue
                new_doc = np.ones(len(i), bool)
                new_doc[1:] = (id_[i][1:] != id_[i][:-1]) | (h[i][1:] != h[i][:-1])
                d = np.flatnonzero(new_doc)
                at = start[i] + np.repeat(np.cumsum(start[i][np.append(d[1:] - 1, len(i) - 1)] + 1) - start[i][np.append(d[1:] - 1, len(i) - 1)] - 1, np.diff(np.append(d, len(i))))
                yield k, id_[i[d]].tobytes(), h[i[d]].tobytes(), np.diff(np.append(d, len(i))).astype("<u4").tobytes(), h1[i].tobytes(), h2[i].tobytes(), gaps(at).tobytes()

        def out(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["slice", "ids", "hs", "lens", "h1", "h2", "at"])

        for b, w, at, doc, h1, h in _hashed(batches, window):
            i = np.flatnonzero(_repeated(bits, h1))
            if len(i):
                h2 = (window_hash(h, window, 2)[at[i]] >> U(32)).astype(np.uint32)
                d = doc[i]
                held.append((h1[i], h2, b.column(0).to_numpy()[d], b.column(1).to_numpy()[d], at[i] - w.first[d]))
                n += len(i)
            if n > FLUSH // 2:
                yield out(flush())
                held, n = [], 0
        if n:
            yield out(flush())

    def settle(batches):
        # A partition is one slice: all windows whose first hash falls in it, one per task and distinct window.
        held, marks = [], []
        for b in batches:
            for r in zip(*(b.column(k) for k in range(1, 7))):
                ids, hs, lens, h1, h2, at = (x.as_buffer() for x in r)
                lens = np.frombuffer(lens, "<u4")
                ids, hs = np.repeat(np.frombuffer(ids, np.int64), lens), np.repeat(np.frombuffer(hs, np.int64), lens)
                if not len(h1):
                    marks.append((ids, hs, np.frombuffer(at, "<u4").astype(np.int64)))
                    continue
                pos = ungaps(np.frombuffer(at, np.uint8))
                last = pos[np.cumsum(lens) - 1] + 1
                base = np.concatenate([[0], last[:-1]])
                held.append((np.frombuffer(h1, np.uint64), np.frombuffer(h2, np.uint32), ids, hs, pos - np.repeat(base, lens)))
        if held:
            h1, h2, ids, hs, start = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order, earliest, _ = _first_of(h1, h2, ids, hs, start)
            again = order[~earliest]
            marks.append((ids[again], hs[again], start[again]))
        if marks:
            ids, hs, start = (np.concatenate(x) for x in zip(*marks))
            to = (mix((ids ^ hs).view(np.uint64)) % U(slices)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            edge = np.searchsorted(to[order], np.arange(slices + 1))
            for k in np.flatnonzero(np.diff(edge)):
                i = order[edge[k] : edge[k + 1]]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(k)], pa.int32()), "ids": [ids[i].tobytes()], "hs": [hs[i].tobytes()], "at": [start[i].astype("<u4").tobytes()]})

    def gather(batches):
        # A partition is one bucket of documents: a row per document with all its marks.
        got = [tuple(np.frombuffer(b.column(k)[i].as_buffer(), t) for k, t in ((1, np.int64), (2, np.int64), (3, "<u4"))) for b in batches for i in range(b.num_rows)]
        m = _marks(*(np.concatenate(x) for x in zip(*got))) if got else None
        if m is not None:
            yield m

    sent = texts.mapInArrow(candidates, "slice int, ids binary, hs binary, lens binary, h1 binary, h2 binary, at binary")
    settled = sent.repartitionById(slices, F.col("slice")).mapInArrow(settle, "bucket int, ids binary, hs binary, at binary")
    return settled.repartitionById(slices, F.col("bucket")).mapInArrow(gather, MARKS)


def dedup_substrings(docs: DataFrame, *, window: int = 20, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space), and the columns in ``keep``."""
    key, h = ranked_id(id_col), F.xxhash64(text_col)
    marks = repeated_windows(docs.select(key.alias("id"), h.alias("h"), F.col(text_col).alias("text")), window)
    marks = marks.select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("starts").alias("_starts"))
    side = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), key.alias("_key"), h.alias("_th"))
    joined = side.join(marks, (F.col("_key") == F.col("_id")) & (F.col("_th") == F.col("_h")), "left")
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = joined.select("_doc", F.col("_text").alias("text"), F.col("_starts").alias("starts"), *kept)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "_doc long, n_words long, n_removed long, kept_text string" + "".join(f", {k} {types[k]}" for k in kept)

    def remove(batches):
        for b in steps(batches, "text"):
            w = words(strings(b.column(1)))
            n = np.diff(w.first)
            cover = np.zeros(len(w.start) + window + 1, np.int32)
            for i, s in enumerate(b.column(2).to_pylist()):
                if s:
                    at = np.frombuffer(s, "<u4").astype(np.int64) + w.first[i]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover)[: len(w.start)] > 0
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), w.first[:-1]) * (n > 0) if b.num_rows else n
            text = gathered_words(w, ~gone)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), text, *b.columns[3:]], names=["_doc", "n_words", "n_removed", "kept_text", *kept])

    out = rows.mapInArrow(remove, schema)
    return out.select(F.col("_doc").alias("doc_id"), "n_words", "n_removed", "kept_text", *(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)))


def dedup_digest(docs: DataFrame, **options) -> DataFrame:
    return dedup_substrings(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
