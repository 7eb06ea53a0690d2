"""Physical form of the assign (P6) and assign-and-sum (P6 + A1) steps.

Two forms compute the same thing:

* ``expr``: an unrolled Column expression (K x D literal terms) inside
  whole-stage codegen, followed by Spark's own partial + final hash
  aggregation on ``cid``. Best while the expression stays small: new centre
  values mean a new generated class each round, and a 512-term expression
  measured ~20x slower than ``arrow`` (8-10 s vs 0.4-0.6 s per round on
  2,000 x 64 embeddings, K=8), while at 32 terms it is the faster form
  (~0.6 s vs ~1 s per round on 600,000 lineitem rows).
* ``arrow``: ``mapInArrow`` over Arrow batches with NumPy: each task reads the
  flat feature buffer zero-copy, assigns points in row chunks and emits only
  its partial sums in long form ``(cid, dim, value)``; Spark then sums the
  partials per ``(cid, dim)``. Used when K x D would make the generated method
  too large for the JIT.

Either way each task ships at most ``K x (D + 3)`` numbers to the shuffle,
whatever the number of points, so a hot cluster (a third of all rows in one
``cid``) costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

# Unrolled Column expressions up to this many (centre x dimension) terms (600,000 lineitem rows, 10 rounds:
# 64 terms 7 s in either form, 128 terms 41 s unrolled against 8 s by the kernel).
EXPR_MAX_TERMS = 64
# Most numbers of a centre table in one task closure; larger tables are taken
# block by block, each block lowering the best centre found so far.
MAX_CENTER_NUMBERS = 4_000_000
# Row chunk for the NumPy distance block: rows x K x D doubles stay ~32 MB.
_BLOCK_ELEMS = 4_000_000

# Special ``dim`` codes in the long partial-stat rows.
DIM_COUNT, DIM_WEIGHT, DIM_SSE = -3, -2, -1


def choose_form(k: int, d: int, form: str = "auto") -> str:
    if form not in ("auto", "expr", "arrow"):
        raise ValueError(f"unknown form {form!r}")
    if form != "auto":
        return form
    return "expr" if k * d <= EXPR_MAX_TERMS else "arrow"


def _features_matrix(rb: pa.RecordBatch, features, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows x d float64 matrix, and which rows are whole.

    A null vector, a null element or another length makes a row not whole: it
    belongs to no centre and enters no statistic, as in the expression form.
    """
    if isinstance(features, (list, tuple)):
        cols = [rb.column(rb.schema.get_field_index(c)) for c in features]
        ok = np.ones(rb.num_rows, bool)
        for c in cols:
            ok &= np.asarray(c.is_valid())
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in cols])
        return x.reshape(-1, d), ok
    col = rb.column(rb.schema.get_field_index(features))
    off = np.asarray(col.offsets, dtype=np.int64)
    n = np.diff(off)
    flat = col.values.slice(off[0], off[-1] - off[0])
    ok = np.asarray(col.is_valid()) & (n == d)
    if flat.null_count:
        row = np.repeat(np.arange(len(n)), n)
        ok &= np.bincount(row[np.asarray(flat.is_null())], minlength=len(n)) == 0
    flat = np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64)
    if ok.all():
        return flat.reshape(-1, d), ok
    x = np.zeros((len(n), d))
    good = np.flatnonzero(ok)
    x[good] = flat[(off[good] - off[0])[:, None] + np.arange(d)]
    return x, ok


def _long(ids: np.ndarray, stats: np.ndarray, names, group: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows ``([grp,] cid, dim, value)`` of a (row x 3 + d) table of count, weight, sse and sums."""
    width = stats.shape[1]
    dims = np.tile(np.concatenate([[DIM_COUNT, DIM_WEIGHT, DIM_SSE], np.arange(width - 3)]), len(ids))
    cols = [pa.array(np.repeat(ids, width), pa.int32()), pa.array(dims, pa.int32()), pa.array(stats.ravel(), pa.float64())]
    if group is not None:
        cols.insert(0, pa.array(np.repeat(group, width), pa.int32()))
    return pa.RecordBatch.from_arrays(cols, names=names)


def _sums(lab: np.ndarray, x: np.ndarray, d2: np.ndarray, wt: np.ndarray | None, k: int) -> np.ndarray:
    """Per label: count, weight, weighted squared distance, weighted vector sums."""
    out = np.empty((k, x.shape[1] + 3))
    out[:, 0] = np.bincount(lab, minlength=k)
    out[:, 1] = out[:, 0] if wt is None else np.bincount(lab, wt, k)
    out[:, 2] = np.bincount(lab, d2 if wt is None else wt * d2, k)
    for j in range(x.shape[1]):
        out[:, 3 + j] = np.bincount(lab, x[:, j] if wt is None else wt * x[:, j], k)
    return out


def sq_dists(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``len(a) x len(b)`` squared distances, dimensions summed left to right.

    The same operation order as the unrolled Spark and SQL expressions, so
    ties and thresholds resolve identically; 2-D passes also beat a reduction
    over a short last axis.
    """
    out = np.zeros((a.shape[0], b.shape[0]))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        out += diff * diff
    return out


def tile_blocks(n: int, block_rows: int, parallelism: int) -> int:
    """Blocks for an all-pairs tiling: at most ``block_rows`` rows per block, and
    enough tiles (b * (b + 1) / 2) for two per core."""
    b = max(1, -(-n // block_rows))
    while b * (b + 1) // 2 < 2 * parallelism and b < n:
        b += 1
    return b


#: From this many centres on, and up to this width, centres are searched by their boxes.
INDEX_CENTERS = 512
INDEX_WIDTH = 16
#: Centres of a box, and rows that search together.
LEAF_CENTERS = 32
LEAF_ROWS = 128


class CenterIndex:
    """Centres in boxes: halved along the coordinate of largest spread until a box has few.

    Rows that fall into one box search together. The distances to its own centres
    bound each row's nearest, and only boxes no farther from the rows than the
    largest bound are computed: exact, ties included.
    """

    def __init__(self, c: np.ndarray):
        self.c = c
        self.axis, self.split, self.left, self.right, self.leaf = [], [], [], [], []
        self.members: list[np.ndarray] = []
        todo = [(np.arange(len(c)), -1, False)]
        while todo:
            at, parent, is_right = todo.pop()
            node = len(self.axis)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            spread = np.ptp(c[at], axis=0)
            a = int(np.argmax(spread))
            order = at[np.argsort(c[at, a], kind="stable")]
            half = len(order) // 2
            ends = len(at) <= LEAF_CENTERS or not spread[a] > 0
            self.axis.append(a)
            self.split.append(0.0 if ends else float(c[order[half], a]))
            self.left.append(node)
            self.right.append(node)
            self.leaf.append(len(self.members) if ends else -1)
            if ends:
                self.members.append(np.sort(at))
            else:
                todo += [(order[half:], node, True), (order[:half], node, False)]
        self.axis, self.left, self.right, self.leaf = (np.array(v) for v in (self.axis, self.left, self.right, self.leaf))
        self.split = np.array(self.split)
        self.low = np.array([c[m].min(axis=0) for m in self.members])
        self.high = np.array([c[m].max(axis=0) for m in self.members])
        self.computed = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lab, mind = np.zeros(len(x), np.int64), np.zeros(len(x))
        node = np.zeros(len(x), np.int64)
        while True:
            go = np.flatnonzero(self.leaf[node] < 0)
            if not len(go):
                break
            at = node[go]
            node[go] = np.where(x[go, self.axis[at]] < self.split[at], self.left[at], self.right[at])
        box = self.leaf[node]
        order = np.lexsort((x[:, 0], box))
        edge = np.concatenate([[0], np.flatnonzero(np.diff(box[order])) + 1, [len(x)]])
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
            for s in range(lo, hi, LEAF_ROWS):
                rows = order[s : min(s + LEAF_ROWS, hi)]
                own = self.members[box[rows[0]]]
                y = x[rows]
                bound = sq_dists(y, self.c[own]).min(axis=1).max()
                gap = np.maximum(np.maximum(self.low - y.max(axis=0), y.min(axis=0) - self.high), 0.0)
                near = np.flatnonzero(~((gap * gap).sum(axis=1) > bound * (1 + 1e-9)))
                cand = np.sort(np.concatenate([self.members[i] for i in near]))
                self.computed += len(rows) * (len(own) + len(cand))
                for t in range(0, len(rows), step := max(1, _BLOCK_ELEMS // len(cand))):
                    d2 = sq_dists(y[t : t + step], self.c[cand])
                    j = d2.argmin(axis=1)
                    lab[rows[t : t + step]], mind[rows[t : t + step]] = cand[j], d2[np.arange(len(j)), j]
        return lab, mind


def index_of(c: np.ndarray) -> CenterIndex | None:
    """An index where it pays: many centres of no great width, all of them finite."""
    return CenterIndex(c) if len(c) >= INDEX_CENTERS and 0 < c.shape[1] <= INDEX_WIDTH and np.isfinite(c).all() else None


def _nearest(x: np.ndarray, c: np.ndarray, index: CenterIndex | None = None):
    """Row-chunked argmin; first minimum = lowest id on ties."""
    n, k = x.shape[0], c.shape[0]
    if index is not None and np.isfinite(x).all():
        return index.nearest(x)
    lab = np.empty(n, dtype=np.int64)
    mind = np.empty(n, dtype=np.float64)
    step = max(1, _BLOCK_ELEMS // max(1, k * x.shape[1]))
    for s in range(0, n, step):
        d2 = sq_dists(x[s : s + step], c)
        j = d2.argmin(axis=1)
        lab[s : s + step] = j
        mind[s : s + step] = d2[np.arange(len(j)), j]
    return lab, mind


def arrow_assign_fn(
    centers: Sequence[Sequence[float]],
    ids: Sequence[int],
    features: str = "features",
    update: bool = False,
    compared=None,
):
    """``mapInArrow`` body: append ``cid`` (int) and ``d2`` (double).

    ``compared``: an accumulator that counts the distances computed.

    ``update``: the batch's last two columns are the best centre of earlier
    blocks; a centre of this block replaces it where it is strictly nearer.
    """
    c = np.asarray(centers, dtype=np.float64)
    id_arr = np.asarray(ids, dtype=np.int32)
    d = c.shape[1]

    def fn(batches):
        index = index_of(c)
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x, ok = _features_matrix(rb, features, d)
            lab, mind = _nearest(x, c, index)
            if compared is not None:
                compared.add(len(x) * len(c) if index is None else index.computed)
                if index is not None:
                    index.computed = 0
            cid, cols = id_arr[lab], rb.columns
            if update:
                cols = rb.columns[:-2]
                old_c = rb.column(rb.num_columns - 2).fill_null(0).to_numpy()
                old_d = rb.column(rb.num_columns - 1).fill_null(0).to_numpy()
                keep = ~(mind < old_d)
                cid, mind = np.where(keep, old_c, cid), np.where(keep, old_d, mind)
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(cid, pa.int32(), mask=~ok), pa.array(mind, pa.float64(), mask=~ok)],
                names=[*rb.schema.names[: len(cols)], "cid", "d2"],
            )

    return fn


def arrow_partial_stats_fn(
    centers: Sequence[Sequence[float]],
    ids: Sequence[int],
    features: str = "features",
    weight: str | None = None,
):
    """``mapInArrow`` body: per-task partial (count, weight, sse, sums) in long form."""
    c = np.asarray(centers, dtype=np.float64)
    id_arr = np.asarray(ids, dtype=np.int32)
    k, d = c.shape

    def fn(batches):
        total = np.zeros((k, d + 3))
        index = index_of(c)
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x, ok = _features_matrix(rb, features, d)
            wt = None
            if weight:
                wt = rb.column(rb.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.float64)[ok]
            x = x[ok]
            lab, mind = _nearest(x, c, index)
            total += _sums(lab, x, mind, wt, k)
        live = np.flatnonzero(total[:, 0])
        if len(live):
            yield _long(id_arr[live], total[live], ["cid", "dim", "value"])

    return fn


#: (group, cluster) sums a task holds before it emits them.
GROUP_ROWS = 50_000


def arrow_group_stats_fn(
    centers: Sequence[Sequence[float]],
    ids: Sequence[int],
    group: str,
    features: str = "features",
):
    """Like ``arrow_partial_stats_fn`` but per (group value, cluster), for the
    two-level partial centroids: rows ``(grp, cid, dim, value)``. A task holds at
    most about ``GROUP_ROWS`` sums, however many groups there are."""
    c = np.asarray(centers, dtype=np.float64)
    id_arr = np.asarray(ids, dtype=np.int32)
    k, d = c.shape
    names = ["grp", "cid", "dim", "value"]

    def fn(batches):
        keys, total = np.zeros(0, np.int64), np.zeros((0, d + 3))
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x, ok = _features_matrix(rb, features, d)
            g = rb.column(rb.schema.get_field_index(group)).to_numpy(zero_copy_only=False).astype(np.int64)[ok]
            x = x[ok]
            lab, mind = _nearest(x, c)
            mine, at = np.unique(g * k + lab, return_inverse=True)
            part = _sums(at, x, mind, None, len(mine))
            both, to = np.unique(np.concatenate([keys, mine]), return_inverse=True)
            merged = np.zeros((len(both), d + 3))
            np.add.at(merged, to, np.concatenate([total, part]))
            keys, total = both, merged
            if len(keys) > GROUP_ROWS:
                yield _long(id_arr[keys % k], total, names, keys // k)
                keys, total = np.zeros(0, np.int64), np.zeros((0, d + 3))
        if len(keys):
            yield _long(id_arr[keys % k], total, names, keys // k)

    return fn


def arrow_within_fn(
    centers: Sequence[Sequence[float]],
    ids: Sequence[int],
    radius: float,
    features: str = "features",
    out: str = "canopies",
):
    """``mapInArrow`` body: append ``out`` = ids of centres with distance < radius."""
    c = np.asarray(centers, dtype=np.float64)
    id_arr = np.asarray(ids, dtype=np.int32)
    k, d = c.shape

    def fn(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x, ok = _features_matrix(rb, features, d)
            step = max(1, _BLOCK_ELEMS // max(1, k * d))
            counts, vals = [], []
            for s in range(0, len(x), step):
                inside = (np.sqrt(sq_dists(x[s : s + step], c)) < radius) & ok[s : s + step, None]
                counts.append(inside.sum(axis=1))
                vals.append(id_arr[np.nonzero(inside)[1]])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
            arr = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(vals), pa.int32()))
            yield pa.RecordBatch.from_arrays([*rb.columns, arr], names=[*rb.schema.names, out])

    return fn


def within(a: np.ndarray, b: np.ndarray, radius: float) -> list[np.ndarray]:
    """Per row of ``a``: positions of the rows of ``b`` at distance < radius."""
    out = []
    step = max(1, _BLOCK_ELEMS // max(1, len(b) * a.shape[1]))
    for s in range(0, len(a), step):
        out += [np.flatnonzero(r) for r in np.sqrt(sq_dists(a[s : s + step], b)) < radius]
    return out


def any_within(x: np.ndarray, c: np.ndarray, radius: float) -> np.ndarray:
    """Whether a row of ``x`` has a row of ``c`` at distance <= radius.

    Rows are taken in the order of the coordinate in which ``c`` spreads most, and
    a step of them meets only the slab of ``c`` within the radius of it.
    """
    out = np.zeros(len(x), bool)
    if not len(x) or not len(c):
        return out
    axis = int(np.argmax(np.ptp(c, axis=0))) if c.shape[1] else 0
    if len(c) > 64 and c.shape[1]:
        c = c[np.argsort(c[:, axis], kind="stable")]
        order = np.argsort(x[:, axis], kind="stable")
        room = radius * (1 + 1e-9)
        first = np.searchsorted(c[:, axis], x[order, axis] - room - np.abs(x[order, axis]) * 1e-12, side="left")
        last = np.searchsorted(c[:, axis], x[order, axis] + room + np.abs(x[order, axis]) * 1e-12, side="right")
    else:
        order, first, last = np.arange(len(x)), np.zeros(len(x), np.int64), np.full(len(x), len(c))
    s = 0
    while s < len(x):
        e = min(len(x), s + 256)
        while e > s + 1 and (e - s) * (int(last[e - 1]) - int(first[s])) > _BLOCK_ELEMS:
            e = s + (e - s) // 2
        lo, hi = int(first[s]), int(last[e - 1])
        if lo < hi:
            rows = order[s:e]
            out[rows] = (np.sqrt(sq_dists(x[rows], c[lo:hi])) <= radius).any(axis=1)
        s = e
    return out


class Eligible:
    """Centres of each canopy (in canopy id order), and the pairs that points may form."""

    def __init__(self, center_canopies: Sequence[Sequence[int]], canopy_ids: Sequence[int]):
        self.ids = np.sort(np.asarray(canopy_ids, np.int64))
        n = [len(cs) for cs in center_canopies]
        center = np.repeat(np.arange(len(n)), n)
        at = np.searchsorted(self.ids, np.array([v for cs in center_canopies for v in cs], np.int64))
        order = np.lexsort((center, at))
        self.center = center[order]
        self.first = np.searchsorted(at[order], np.arange(len(self.ids) + 1))

    def pairs(self, col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, centre) pairs sharing a canopy, in order, of a list column of canopy ids."""
        off = np.asarray(col.offsets, np.int64)
        row = np.repeat(np.arange(len(col)), np.diff(off))
        vals = col.values.slice(off[0], off[-1] - off[0]).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(self.ids, vals), max(len(self.ids) - 1, 0))
        known = self.ids[at] == vals if len(self.ids) else np.zeros(len(vals), bool)
        row, at = row[known], at[known]
        n = self.first[at + 1] - self.first[at]
        base = np.cumsum(n) - n
        take = np.arange(int(n.sum())) + np.repeat(self.first[at] - base, n)
        key = np.unique(np.repeat(row, n) * k + self.center[take])
        return key // k, key % k


def _restricted(rb, features, canopies, c: np.ndarray, may: Eligible):
    """Rows with an eligible centre, their nearest one (lowest id on ties), and its squared distance."""
    x, ok = _features_matrix(rb, features, c.shape[1])
    row, cen = may.pairs(rb.column(rb.schema.get_field_index(canopies)), len(c))
    row, cen = row[ok[row]], cen[ok[row]]
    d2 = np.zeros(len(row))
    for j in range(c.shape[1]):  # the pairs alone, left to right like sq_dists
        diff = x[row, j] - c[cen, j]
        d2 += diff * diff
    has, first = np.unique(row, return_index=True)
    if not len(has):
        return x, has, has, d2
    best = np.minimum.reduceat(d2, first)
    hit = np.flatnonzero(d2 == np.repeat(best, np.diff(np.append(first, len(row)))))
    _, lowest = np.unique(row[hit], return_index=True)
    return x, has, cen[hit[lowest]], best


def arrow_restricted_stats_fn(
    centers: Sequence[Sequence[float]],
    ids: Sequence[int],
    center_canopies: Sequence[Sequence[int]],
    canopy_ids: Sequence[int],
    features: str = "features",
    canopies: str = "canopies",
):
    """Partial stats where a point may only join centres sharing a canopy; no other distance is computed."""
    c = np.asarray(centers, dtype=np.float64)
    id_arr = np.asarray(ids, dtype=np.int32)
    k, d = c.shape
    may = Eligible(center_canopies, canopy_ids)

    def fn(batches):
        total = np.zeros((k, d + 3))
        for rb in batches:
            if rb.num_rows:
                x, has, lab, mind = _restricted(rb, features, canopies, c, may)
                total += _sums(lab, x[has], mind, None, k)
        live = np.flatnonzero(total[:, 0])
        if len(live):
            yield _long(id_arr[live], total[live], ["cid", "dim", "value"])

    return fn


def arrow_restricted_assign_fn(
    centers: Sequence[Sequence[float]],
    ids: Sequence[int],
    center_canopies: Sequence[Sequence[int]],
    canopy_ids: Sequence[int],
    features: str = "features",
    canopies: str = "canopies",
):
    """Append ``cid``/``d2`` choosing only centres that share a canopy (else null)."""
    c = np.asarray(centers, dtype=np.float64)
    id_arr = np.asarray(ids, dtype=np.int32)
    may = Eligible(center_canopies, canopy_ids)

    def fn(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            _, has, lab, mind = _restricted(rb, features, canopies, c, may)
            cid, d2, none = np.zeros(rb.num_rows, np.int32), np.zeros(rb.num_rows), np.ones(rb.num_rows, bool)
            cid[has], d2[has], none[has] = id_arr[lab], mind, False
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(cid, mask=none), pa.array(d2, mask=none)], names=[*rb.schema.names, "cid", "d2"])

    return fn
