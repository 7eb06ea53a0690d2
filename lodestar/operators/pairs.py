"""The K closest pairs of distinct vectors and their midpoints.

Exact without emitting pairs and without comparing all of them:

1. A bounded sample (the rows of smallest hash) gives a distance that K pairs
   are within, so the K closest pairs are, too; a pass over all rows in place
   lowers it on larger tables (pairs that happen to be in one batch).
2. One projection that no pair's distance can fall below: a coordinate or the
   distance to a pivot, whichever has the fewest sample pairs within the bound.
   Rows are cut into slices of it at quantiles of a sample that grows with the
   number of slices (``SLICE_SAMPLE`` values each). A row goes to its own slice
   and, as a guest, to the earlier slices within the bound of it.
3. A slice of more than ``block_rows`` rows (a hot value of the projection) is cut
   into blocks by hash; each pair of its blocks is a tile. Every tile is one
   bounded group: in order of the projection a row meets only the rows within
   the bound, and the tile returns its K closest pairs. Spark takes the global
   K (``TakeOrderedAndProject``), which are among those of the tiles.

On larger tables only the K smallest ids of each vector go on: a pair with a later
copy has K pairs of the same two vectors before it or equal to it.

Tables of no more rows than the sample go without the bound: slice and guests
are then one block structure over all rows. Pairs of equal vectors are skipped
(the reference compares points by value); rows are told apart by position, so
ids may repeat. Order: squared distance, ids, midpoint. A row whose vector is
null, holds a null or has another width than ``dim`` takes no part; without
``dim`` all widths are counted (one job) and must agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.plans import physical, storage
from lodestar.plans.storage import local_frame
from lodestar.sources.table import whole_rows

DEFAULT_BLOCK_ROWS = 20_000
#: Rows of the sample that gives the bound, the projection and the slices.
SAMPLE_ROWS = 1024
MAX_SLICES = 1 << 16
#: Sampled values for each slice.
SLICE_SAMPLE = 16
#: From this many rows on, copies are dropped and a pass over all batches lowers the bound first.
BOUND_PASS_ROWS = 50_000
#: Pairs whose distances one step computes.
STEP_PAIRS = 2_000_000

PAIR_SCHEMA = "i bigint, j bigint, d2 double, mid array<double>"


class Projection:
    """A coordinate, or the distance to a pivot: never farther apart than the vectors are."""

    def __init__(self, axis: int | None = None, pivot: np.ndarray | None = None):
        self.axis, self.pivot = axis, pivot

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.axis] if self.pivot is None else np.sqrt(physical.sq_dists(x, self.pivot[None, :])[:, 0])


def _reach(f: np.ndarray, bound: float) -> np.ndarray:
    """``f + bound`` with room for rounding."""
    return f + bound * (1 + 1e-9) + np.abs(f) * 1e-12


class Best:
    """The k closest pairs so far: positions, squared distances; ties by ids, then midpoint."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.a, self.b, self.d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def offer(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> None:
        keep = d > 0  # distinct vectors only
        if len(self.d) >= self.k:
            keep &= d <= self.d[-1]
        a, b, d = a[keep], b[keep], d[keep]
        if len(d) > self.k:
            near = d <= np.partition(d, self.k - 1)[self.k - 1]  # ties with the k-th stay
            a, b, d = a[near], b[near], d[near]
        if not len(d):
            return
        a, b, d = np.concatenate([self.a, a]), np.concatenate([self.b, b]), np.concatenate([self.d, d])
        lo, hi = np.minimum(self.ids[a], self.ids[b]), np.maximum(self.ids[a], self.ids[b])
        mid = (self.x[a] + self.x[b]) / 2.0
        order = np.lexsort((*mid.T[::-1], hi, lo, d))[: self.k]
        self.a, self.b, self.d = a[order], b[order], d[order]


def _compare(best: Best, f: np.ndarray, bound: float, mine: np.ndarray, other: np.ndarray | None = None) -> int:
    """Offer every pair of a row of ``mine`` and one of ``other`` (positions) within ``bound`` by ``f``.

    Without ``other``: every pair of two rows of ``mine``, once. Returns how many distances were computed.
    """
    a = mine[np.argsort(f[mine], kind="stable")]
    b = a if other is None else other[np.argsort(f[other], kind="stable")]
    last = np.searchsorted(f[b], _reach(f[a], bound), side="right")
    first = np.arange(1, len(a) + 1) if other is None else np.searchsorted(f[b], -_reach(-f[a], bound), side="left")
    width = np.maximum(last - first, 0)
    done = np.concatenate([[0], np.cumsum(width)])
    s = 0
    while s < len(a):
        e = max(s + 1, int(np.searchsorted(done, done[s] + STEP_PAIRS, side="right")) - 1)
        w = width[s:e]
        lo, hi = int(first[s]), int(last[e - 1])
        if not w.any():
            pass
        elif 2 * int(w.sum()) > (e - s) * (hi - lo):  # most of them: the whole rectangle
            d = physical.sq_dists(best.x[a[s:e]], best.x[b[lo:hi]])
            place = np.arange(lo, hi)[None, :]
            d[(place < first[s:e, None]) | (place >= last[s:e, None])] = 0.0
            if len(best.d) >= best.k:
                d[d > best.d[-1]] = 0.0
            i, j = np.nonzero(d)
            best.offer(a[s + i], b[lo + j], d[i, j])
        else:
            i = np.repeat(np.arange(s, e), w)
            j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + first[i]
            d = np.zeros(len(i))
            for c in range(best.x.shape[1]):  # left to right, as in physical.sq_dists
                diff = best.x[a[i], c] - best.x[b[j], c]
                d += diff * diff
            best.offer(a[i], b[j], d)
        s = e
    return int(done[-1])


def _result(best: Best, d: int) -> dict:
    i, j = best.ids[best.a], best.ids[best.b]
    mid = (best.x[best.a] + best.x[best.b]) / 2.0
    mids = pa.ListArray.from_arrays(pa.array(np.arange(len(i) + 1) * d, pa.int32()), pa.array(mid.ravel()))
    return {"i": np.minimum(i, j), "j": np.maximum(i, j), "d2": best.d, "mid": mids}


def _blocks(points: DataFrame, n: int, k: int, block_rows: int, dim: int, compared) -> DataFrame:
    """K closest of every tile of two hash blocks, over all rows."""
    nb = physical.tile_blocks(n, block_rows, points.sparkSession.sparkContext.defaultParallelism)
    # Non-unique ids would fall into one block: the vector takes part in the hash.
    blk = points.select(F.pmod(F.xxhash64("id", "features"), F.lit(nb)).cast("int").alias("blk"), "id", "features")
    rep = blk.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))).select(
        F.least("blk", "other").alias("ta"), F.greatest("blk", "other").alias("tb"), "blk", "id", "features"
    )

    def fn(tile: pa.Table) -> pa.Table:
        rb = tile.combine_chunks().to_batches()[0]
        ta, tb, own, ids = (rb.column(rb.schema.get_field_index(c)).to_numpy() for c in ("ta", "tb", "blk", "id"))
        x, _ = physical._features_matrix(rb, "features", dim)
        best = Best(ids, x, k)
        a, b = np.flatnonzero(own == ta[0]), np.flatnonzero(own == tb[0])
        n = _compare(best, np.zeros(len(x)), 0.0, a, None if ta[0] == tb[0] else b)
        if compared is not None:
            compared.add(n)
        return pa.table(_result(best, dim))

    return rep.groupBy("ta", "tb").applyInArrow(fn, PAIR_SCHEMA)


def _plan(sample: np.ndarray, k: int) -> tuple[float, Projection] | None:
    """Bound and projection from the sample; None if it has fewer than k pairs of distinct vectors."""
    best = Best(np.arange(len(sample)), sample, k)
    _compare(best, np.zeros(len(sample)), 0.0, np.arange(len(sample)))
    if len(best.d) < k:
        return None
    bound = float(np.sqrt(best.d[-1]))
    far = [sample[np.argmax(physical.sq_dists(sample, sample[:1])[:, 0])], sample.mean(axis=0)]
    choices = [Projection(axis=j) for j in range(sample.shape[1])] + [Projection(pivot=p) for p in far]

    def near(p: Projection) -> int:
        f = np.sort(p(sample))
        return int((np.searchsorted(f, _reach(f, bound), side="right") - np.arange(len(f))).sum())

    return bound, min(choices, key=near)


def _lower(points: DataFrame, bound: float, by: Projection, k: int, dim: int) -> float:
    """A smaller bound from the pairs that lie in one batch of the table as it is (no shuffle)."""

    def fn(batches):
        for rb in batches:
            x, _ = physical._features_matrix(rb, "features", dim)
            best = Best(np.arange(len(x)), x, k)
            _compare(best, by(x), bound, np.arange(len(x)))
            yield pa.RecordBatch.from_arrays([pa.array(best.d)], ["d2"])

    # The batches' pairs are all different pairs, so their K closest bound the K closest of all.
    got = [r["d2"] for r in points.select("features").mapInArrow(fn, "d2 double").orderBy("d2").limit(k).collect()]
    return float(np.sqrt(got[-1])) if len(got) == k else bound


def _first_copies(points: DataFrame, k: int) -> DataFrame:
    """The rows of the k smallest ids of each vector."""
    w = Window.partitionBy("features").orderBy("id")
    return points.withColumn("copy", F.row_number().over(w)).where(F.col("copy") <= k).select("id", "features")


def _cuts(points: DataFrame, n: int, dim: int, sample: np.ndarray, by: Projection, want: int) -> np.ndarray:
    """Where slices begin: quantiles of a sample of rows by hash, of ``SLICE_SAMPLE`` values a slice at least."""
    f = by(sample)
    if len(f) < min(n, want * SLICE_SAMPLE):

        def project(batches):
            for rb in batches:
                yield pa.RecordBatch.from_arrays([pa.array(by(physical._features_matrix(rb, "features", dim)[0]))], ["f"])

        some = F.pmod(F.xxhash64("features", "id"), F.lit(max(1, n // (want * SLICE_SAMPLE)))) == 0
        rows = points.where(some).select("features").mapInArrow(project, "f double").limit(4 * want * SLICE_SAMPLE)
        f = np.concatenate([f, rows.toArrow().column("f").to_numpy()])
    f = np.sort(f)
    return np.unique(f[np.linspace(0, len(f), want + 1)[1:-1].astype(int)])


def _slices(points: DataFrame, n: int, k: int, block_rows: int, dim: int, sample: np.ndarray, bound: float, by: Projection, compared) -> DataFrame:
    if n >= BOUND_PASS_ROWS:
        bound = min(bound, _lower(points, bound, by, k, dim))
    cores = points.sparkSession.sparkContext.defaultParallelism
    want = min(MAX_SLICES, max(-(-2 * n // block_rows), min(2 * cores, n // 256 + 1)))
    cuts = _cuts(points, n, dim, sample, by, want)

    def deal(batches):
        for rb in batches:
            x, _ = physical._features_matrix(rb, "features", dim)
            f = by(x)
            own = np.searchsorted(cuts, f, side="right")
            first = np.searchsorted(cuts, -_reach(-f, bound), side="left")
            each = own - first + 1
            at = np.repeat(np.arange(len(f)), each)
            slice_ = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each) + first[at]
            rows = rb.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slice_, pa.int32()), pa.array(slice_ == own[at]), pa.array(f[at]), *rows.columns], ["slice", "own", "f", "id", "features"]
            )

    dealt = points.select("id", "features").mapInArrow(deal, "slice int, own boolean, f double, id bigint, features array<double>")
    sizes = {r["slice"]: r["count"] for r in dealt.groupBy("slice").count().where(F.col("count") > block_rows).collect()}
    blocks = F.lit(1)
    if sizes:  # hot slices, at most MAX_SLICES
        nb = [(s, -(-c // block_rows)) for s, c in sizes.items()]
        dealt = dealt.join(F.broadcast(local_frame(points.sparkSession, nb, "slice int, nb int")), "slice", "left")
        blocks = F.coalesce("nb", F.lit(1))
    blk = dealt.withColumn("nb", blocks).withColumn("blk", F.pmod(F.xxhash64("id", "features", "own"), F.col("nb")).cast("int"))
    rep = blk.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "slice", F.least("blk", "other").alias("ta"), F.greatest("blk", "other").alias("tb"), "blk", "own", "f", "id", "features"
    )

    def fn(tile: pa.Table) -> pa.Table:
        rb = tile.combine_chunks().to_batches()[0]
        ta, tb, blk, f, ids = (rb.column(rb.schema.get_field_index(c)).to_numpy() for c in ("ta", "tb", "blk", "f", "id"))
        own = rb.column(rb.schema.get_field_index("own")).to_numpy(zero_copy_only=False)
        x, _ = physical._features_matrix(rb, "features", dim)
        best = Best(ids, x, k)
        home, guest = ([np.flatnonzero((blk == t) & side) for t in (ta[0], tb[0])] for side in (own, ~own))
        # Of two guests, another slice has the pair.
        if ta[0] == tb[0]:
            n = _compare(best, f, bound, home[0]) + _compare(best, f, bound, home[0], guest[0])
        else:
            n = _compare(best, f, bound, home[0], np.concatenate([home[1], guest[1]])) + _compare(best, f, bound, guest[0], home[1])
        if compared is not None:
            compared.add(n)
        return pa.table(_result(best, dim))

    return rep.groupBy("slice", "ta", "tb").applyInArrow(fn, PAIR_SCHEMA)


def closest_pairs(
    points: DataFrame,
    k: int,
    ordered: bool = False,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    id_col: str = "id",
    features: str = "features",
    n: int | None = None,
    dim: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    compared=None,
) -> DataFrame:
    """``(rank, i, j, d2, mid)`` for the k closest pairs of distinct vectors.

    ``ordered=False``: unordered pairs (i < j). ``ordered=True`` counts (i, j)
    and (j, i) separately, so each close pair takes two of the k slots, as in
    the reference's ``cartesian``. ``n``: the number of rows, if known.
    ``compared``: an accumulator that counts the distances computed.
    """
    points, dim = whole_rows(points, features, dim)
    pts = points.select(F.col(id_col).cast("bigint").alias("id"), F.col(features).alias("features"))
    n = pts.count() if n is None else n
    kk = int(k)
    if n >= max(BOUND_PASS_ROWS, sample_rows + 1):
        with storage.prepared(_first_copies(pts, kk), "copies") as few:
            top = _top(few, few.count(), kk, ordered, block_rows, dim, sample_rows, compared)
            return local_frame(points.sparkSession, top.collect(), "rank int, i bigint, j bigint, d2 double, mid array<double>")
    return _top(pts, n, kk, ordered, block_rows, dim, sample_rows, compared)


def _top(pts: DataFrame, n: int, kk: int, ordered: bool, block_rows: int, dim: int, sample_rows: int, compared) -> DataFrame:
    plan = None
    if n > sample_rows:
        rows = pts.select("features").orderBy(F.xxhash64("features", "id"), "id", "features").limit(sample_rows).collect()
        sample = np.array([r["features"] for r in rows], np.float64).reshape(-1, dim)
        plan = _plan(sample, kk) if len(sample) else None
    if plan is None:
        cand = _blocks(pts, n, kk, block_rows, dim, compared)
    else:
        cand = _slices(pts, n, kk, block_rows, dim, sample, *plan, compared)
    if ordered:
        back = F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "d2", "mid")
        cand = cand.select(F.explode(F.array(F.struct("i", "j", "d2", "mid"), back)).alias("r")).select("r.*")
    top = cand.orderBy("d2", "i", "j", "mid").limit(kk)
    w = Window.orderBy("d2", "i", "j", "mid")  # over the k rows of ``top`` only
    return top.withColumn("rank", F.row_number().over(w).cast("int")).select("rank", "i", "j", "d2", "mid")
