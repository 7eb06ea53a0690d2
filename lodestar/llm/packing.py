"""Best-fit packing of tokenised documents into sequences (Martello-Toth reduction, then best fit).

``pack`` encodes every document once, cuts only documents longer than a
sequence, and plans on the *histogram of piece lengths*, which has at most
``capacity`` rows however large the corpus is. The plan first fixes, for all
copies of a length at once, the sets that dominate every alternative (the
Martello-Toth reduction), then packs what is left by best fit, longest first.
Pieces find their place by their rank within their length, so no task ever
holds more than its own input split.

Defined results: a null text is an empty document (its end id alone); repeated
rows are packed as often as they occur; a null id is packed and stays null; an
empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm._common import binaries, save
from lodestar.llm.tokens import default_path, encoded

PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, local_rank long"


class Plan(NamedTuple):
    """Slots of the planned sequences: items of ``length`` ranked from ``lo`` fill ``per`` places a sequence."""

    length: np.ndarray
    lo: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


class _Instance:
    """Item lengths with their counts."""

    def __init__(self, hist: dict[int, int], capacity: int):
        self.n = dict(hist)
        self.c = capacity
        self.lens = sorted(k for k, v in hist.items() if v)

    def take(self, pattern: list[int]) -> int:
        """Use up as many copies of ``pattern`` as there are; how many."""
        need = {x: pattern.count(x) for x in pattern}
        k = min(self.n[x] // m for x, m in need.items())
        for x, m in need.items():
            self.n[x] -= k * m
            if not self.n[x]:
                self.lens.pop(bisect_left(self.lens, x))
        return k

    def left(self, x: int, used: list[int]) -> int:
        return self.n.get(x, 0) - used.count(x)

    def smallest(self, used: list[int], k: int) -> list[int]:
        out = []
        for x in self.lens:
            out += [x] * min(self.left(x, used), k - len(out))
            if len(out) == k:
                break
        return out

    def largest(self, most: int, used: list[int]) -> int:
        """The largest item not in ``used`` of at most ``most``; 0 if none."""
        i = bisect_left(self.lens, most + 1) - 1
        while i >= 0 and self.left(self.lens[i], used) <= 0:
            i -= 1
        return self.lens[i] if i >= 0 else 0


def dominating(x: _Instance, j: int) -> list[int] | None:
    """A set with item ``j`` that dominates every feasible set holding it, or None.

    A set dominates another if the other's items can be dealt into groups that
    each fit within one item of the set. Sets of at most three items are tried.
    """
    room = x.c - j
    small = x.smallest([j], 3)
    if not small or small[0] > room:
        return [j]
    if x.left(room, [j]) > 0:
        return [j, room]
    k = x.largest(room, [j])
    if len(small) < 2 or small[0] + small[1] > room:
        return [j, k]
    if len(small) == 3 and sum(small) <= room:
        return None
    best, lesser = 0, 0  # over feasible pairs: the largest sum, and the largest smaller member
    for a in reversed([v for v in x.lens if v <= room and x.left(v, [j]) > 0]):
        b = min(x.largest(room - a, [j, a]), a)
        if b and x.left(b, [j, a]) <= 0:
            b = x.largest(b - 1, [j, a])
        if b:
            best, lesser = max(best, a + b), max(lesser, b)
    if k >= best:
        return [j, k]
    b = x.largest(room - k, [j, k])
    return [j, k, b] if b and lesser <= b else None


def reduce_instance(x: _Instance) -> list[tuple[list[int], int]]:
    """Fix dominating sets, in bulk, until no length has one."""
    fixed, changed = [], True
    while changed:
        changed = False
        for j in sorted(x.lens, reverse=True):
            while x.n.get(j) and (s := dominating(x, j)):
                fixed.append((s, x.take(s)))
                changed = True
    return fixed


def best_fit(x: _Instance) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit decreasing over (length, count): equal sequences are handled as one."""
    open_: dict[int, list] = {}
    rooms: list[int] = []
    done = []

    def add(room, pattern, k):
        if not k:
            return
        if room == 0:
            done.append((pattern, k))
            return
        if room not in open_:
            rooms.insert(bisect_left(rooms, room), room)
            open_[room] = []
        open_[room].append((pattern, k))

    for size in reversed(x.lens):
        n = x.n[size]
        while n:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                pattern, k = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                room, pattern, k = x.c, [], n
            per = room // size
            full = min(k, n // per)
            n -= full * per
            add(room - per * size, [*pattern, (size, per)], full)
            if full < k and n:  # the last one gets what is left, fewer than ``per``
                add(room - n * size, [*pattern, (size, n)], 1)
                full, n = full + 1, 0
            if pattern:
                add(room, pattern, k - full)
    return done + [p for group in open_.values() for p in group]


def plan(hist: dict[int, int], capacity: int) -> Plan:
    x = _Instance(hist, capacity)
    classes = [([(v, 1) for v in s], k) for s, k in reduce_instance(x)]
    classes += best_fit(x)
    rank: dict[int, int] = {}
    rows, seq = [], 0
    for pattern, k in classes:
        off = 0
        for size, per in pattern:
            lo = rank.get(size, 0)
            rows.append((size, lo, per, seq, off))
            rank[size] = lo + k * per
            off += size * per
        seq += k
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return Plan(*a.T.copy(), seq)


def encode_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece, with its ids (unsigned 32-bit, little-endian) and its rank among its task's pieces of that length."""

    def run(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b, ids, bounds in encoded(batches, "text", path):
            n_docs = b.num_rows
            flat = np.insert(ids, bounds[1:], end_id).astype("<u4")
            edge = bounds + np.arange(n_docs + 1)
            total = np.diff(edge)
            k = -(-total // capacity)
            doc = np.repeat(np.arange(n_docs), k)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
            head = total - (k - 1) * capacity  # the first piece may be shorter
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[doc], capacity)
            order = np.argsort(length, kind="stable")
            sizes, first, count = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - np.repeat(first, count) + np.repeat(seen[sizes], count)
            seen[sizes] += count
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    binaries(flat, np.concatenate([edge[doc] + start, edge[-1:]])),
                    pa.array(np.full(len(doc), part), pa.int32()),
                    pa.array(rank),
                ],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, PIECES)


class Packed(NamedTuple):
    pieces: DataFrame  # PIECES, written once in the shared folder
    plan: Plan

    def place(self, pieces: DataFrame) -> DataFrame:
        """Add ``sequence_id`` and ``offset`` to any projection of ``pieces`` that keeps part, length and local_rank."""
        counts = self.pieces.groupBy("part", "length").agg(F.count("*").alias("_n"))
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        base = counts.select("part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
        ranked = pieces.join(base, ["part", "length"])
        keep = [c for c in pieces.columns if c not in ("part", "local_rank")]
        ranked = ranked.select(*keep, (F.col("_base") + F.col("local_rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
        slots = self.plan

        def put(batches):
            key = slots.length << 44 | slots.lo
            for b in batches:
                length = b.column(b.schema.get_field_index("length")).to_numpy()
                rank = b.column(b.schema.get_field_index("sequence_id")).to_numpy()
                i = np.searchsorted(key, length << 44 | rank, side="right") - 1
                nth = rank - slots.lo[i]
                out = [*b.columns[:-2], pa.array(slots.sequence[i] + nth // slots.per[i]), pa.array(slots.offset[i] + nth % slots.per[i] * length)]
                yield pa.RecordBatch.from_arrays(out, names=b.schema.names)

        return ranked.mapInArrow(put, ranked.schema)

    def sequences(self) -> DataFrame:
        """Every piece with its ids and its place."""
        return self.place(self.pieces)


def pack(docs: DataFrame, *, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> Packed:
    pieces = save(encode_pieces(docs, tokenizer or default_path(), capacity, end_id, id_col, text_col), "pieces")
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    return Packed(pieces, plan(hist, capacity))


def pack_digest(docs: DataFrame, **options) -> DataFrame:
    """Per piece: place and CRC-32 of its ids."""
    p = pack(docs, **options)
    narrow = p.pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "local_rank")
    return p.place(narrow).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
