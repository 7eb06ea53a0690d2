"""K3, K4, K5: adaptive radius, max-density seeding, density-seeded k-means.

* K3 ``adaptive_radius``: ``sqrt(sum of distances over all ordered pairs) *
  coef``. The sum is quadratic by definition; it is computed exactly as a
  Spark job over tiles: points are hashed into B blocks of at most
  ``block_rows`` rows, each point is sent to the B tiles ``(min(b, j),
  max(b, j))`` it takes part in, and every tile (two blocks, a bounded group)
  returns one partial sum. No pair is materialised as a row and no task holds
  more than two blocks. In one dimension it is N log N, by ranges of sorted values. Pass ``t2=`` to ``kmeans_density`` to skip it.
* K4 ``density_seed``: on a sample (the sampling step is part of the operator:
  70 rows by default), A5/A7 density and squared-distance row sums are tiled
  likewise; each further centre is a scan, an anti-join and an argmax on Spark.
* K5 ``kmeans_density`` = K3 -> sample -> K4 -> K1.

A row whose vector is null, holds a null or has another width than ``dim`` takes
no part. Without ``dim`` all widths are counted (one job) and must agree.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.assign import assign, predict
from lodestar.operators.lloyd import kmeans
from lodestar.operators.plane import plane_distance_sum
from lodestar.plans import physical, storage
from lodestar.plans.storage import local_frame
from lodestar.sources.sample import DEFAULT_SEED, first_rows, seeded_sample
from lodestar.sources.table import whole_rows

DEFAULT_BLOCK_ROWS = 20_000
DEFAULT_COEF = 0.011
MAX_RANGES = 1 << 14
#: From this many rows on, points of the plane are summed by squares.
PLANE_ROWS = 50_000
FAR = 1e150
#: From this width on, distances come from matrix products of so many rows a side.
PRODUCT_WIDTH = 8
PRODUCT_ROWS = 512
#: Squared distances below this share of the squared lengths are computed from the differences.
CLOSE = 1e-3


def _tile_sum(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of Euclidean distances over all (row of a, row of b) pairs."""
    if len(a) == 0 or len(b) == 0:
        return 0.0
    if a.shape[1] >= PRODUCT_WIDTH:
        return _product_sum(a, b)
    step = max(1, 4_000_000 // max(1, len(b)))
    total = 0.0
    for s in range(0, len(a), step):
        total += float(np.sqrt(physical.sq_dists(a[s : s + step], b)).sum())
    return total


def _product_sum(a: np.ndarray, b: np.ndarray) -> float:
    """``_tile_sum`` by matrix products; pairs so close that the difference would lose digits are computed again."""
    mid = b.mean(0)
    a, b = a - mid, b - mid
    na, nb = (a * a).sum(1), (b * b).sum(1)
    total, step = 0.0, PRODUCT_ROWS
    for t in range(0, len(b), step):
        y = b[t : t + step]
        for s in range(0, len(a), step):
            x = a[s : s + step]
            size = na[s : s + step, None] + nb[None, t : t + step]
            d = x @ (y.T * -2.0)
            d += size
            size *= CLOSE
            i, j = np.nonzero(~(d > size))  # NaN, too
            if len(i):
                d[i, j] = ((x[i] - y[j]) ** 2).sum(1)
            total += float(np.sqrt(d, out=d).sum())
    return total


def tiles(points: DataFrame, block_rows: int, *cols) -> DataFrame:
    """Every row once per tile it takes part in: ``ta, tb, blk`` and ``cols``; a tile is two blocks of rows."""
    n = points.count()
    nb = physical.tile_blocks(n, block_rows, points.sparkSession.sparkContext.defaultParallelism)
    blk = points.select(F.pmod(F.xxhash64(*cols), F.lit(nb)).cast("int").alias("blk"), *cols)
    rep = blk.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    return rep.select(F.least("blk", "other").alias("ta"), F.greatest("blk", "other").alias("tb"), "blk", *cols)


def _gap_sum(x: np.ndarray, n: np.ndarray) -> float:
    """Sum of |x_i - x_j| over all unordered pairs of ascending values with counts ``n``: each gap times the pairs across it."""
    below = np.cumsum(n, dtype=np.float64)
    return float((np.diff(x) * below[:-1] * (below[-1] - below[:-1])).sum())


def line_distance_sum(values: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> float:
    """A6 for one dimension in N log N: ``values`` has one column ``x``.

    Equal values become one row with a count first, so none is hot. Distinct
    values are cut into ranges at quantiles; each range sums its own gaps, and of
    two ranges only counts and means matter: of those the driver sees one row a
    range, ``MAX_RANGES`` at most.
    """
    counted = values.where(F.col("x").isNotNull()).groupBy("x").agg(F.count("*").alias("n"))
    with storage.prepared(counted, "line") as counted:
        ranges = min(MAX_RANGES, -(-counted.count() // block_rows))
        cuts = counted.approxQuantile("x", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)) if ranges > 1 else []
        edges = np.unique(np.array(cuts))

        def place(batches):
            for rb in batches:
                at = np.searchsorted(edges, rb.column(0).to_numpy(), side="right")
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *rb.columns], ["part", "x", "n"])

        def fn(part: pa.Table) -> pa.Table:
            x, n = part.column("x").to_numpy(), part.column("n").to_numpy()
            order = np.argsort(x)
            return pa.table({"n": [float(n.sum())], "mean": [float(np.average(x, weights=n))], "inside": [_gap_sum(x[order], n[order])]})

        rows = counted.mapInArrow(place, "part int, x double, n bigint").groupBy("part").applyInArrow(fn, "n double, mean double, inside double").collect()
    rows.sort(key=lambda r: r["mean"])
    between = _gap_sum(np.array([r["mean"] for r in rows]), np.array([r["n"] for r in rows])) if rows else 0.0
    return 2.0 * (sum(r["inside"] for r in rows) + between)


def pair_distance_sum(
    points: DataFrame,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    id_col: str = "id",
    features: str = "features",
    dim: int | None = None,
    plane_rows: int = PLANE_ROWS,
) -> float:
    """Sum of ``||x_i - x_j||`` over all ordered pairs (i, j); in one dimension by sorting, in two by squares."""
    points, dim = whole_rows(points, features, dim)
    if dim == 1:
        return line_distance_sum(points.select(F.get(features, F.lit(0)).alias("x")), block_rows)
    if dim == 2:
        plane = points.select(*(F.get(features, F.lit(i)).alias(c) for i, c in enumerate("xy")))
        ends = plane.agg(F.count("*").alias("n"), *(f(c) for f in (F.min, F.max) for c in "xy")).first()
        if ends["n"] >= plane_rows and not all(math.isfinite(v) for v in ends[1:]):
            return math.nan  # such a row's distance to itself
        if ends["n"] >= plane_rows and all(abs(v) < FAR for v in ends[1:]):  # squares in range
            return plane_distance_sum(plane, ends[1:3], ends[3:])

    def fn(tile: pa.Table) -> pa.Table:
        rb = tile.combine_chunks().to_batches()[0]
        ta, tb, own = (rb.column(rb.schema.get_field_index(c)).to_numpy() for c in ("ta", "tb", "blk"))
        x, _ = physical._features_matrix(rb, features, dim)
        a, b = x[own == ta[0]], x[own == tb[0]]
        if ta[0] != tb[0]:
            return pa.table({"s": [2.0 * _tile_sum(a, b)]})
        # Within a block each pair once, twice over; a row's distance to itself is 0.
        step = 1024
        s = sum(_tile_sum(a[i : i + step], a[i + step :]) * 2 + _tile_sum(a[i : i + step], a[i : i + step]) for i in range(0, len(a), step))
        return pa.table({"s": [s]})

    parts = tiles(points, block_rows, id_col, features).groupBy("ta", "tb").applyInArrow(fn, "s double")
    return float(parts.agg(F.sum("s").alias("s")).first()["s"] or 0.0)


def adaptive_radius(
    points: DataFrame,
    coef: float = DEFAULT_COEF,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    id_col: str = "id",
    features: str = "features",
    dim: int | None = None,
) -> float:
    """K3: ``sqrt(sum of all ordered pair distances) * coef``."""
    return math.sqrt(pair_distance_sum(points, block_rows, id_col, features, dim)) * coef


def density_stats(sample: DataFrame, t2: float, features: str = "features", block_rows: int = DEFAULT_BLOCK_ROWS, dim: int | None = None) -> DataFrame:
    """A5/A7 over a sample ``(seq, id, features)``.

    Adds ``density`` (rows whose **squared** distance is <= t2, self
    included, as the reference compares) and ``rowsum`` (sum of squared
    distances to all sample rows) and ``rowsum_in`` (the same over the rows
    counted in ``density``). Tiles give partial sums per row, Spark adds them.
    """
    thr = float(t2)
    sample, dim = whole_rows(sample, features, dim)

    def fn(tile: pa.Table) -> pa.Table:
        rb = tile.combine_chunks().to_batches()[0]
        ta, tb, own, seq = (rb.column(rb.schema.get_field_index(c)).to_numpy() for c in ("ta", "tb", "blk", "seq"))
        x, _ = physical._features_matrix(rb, features, dim)
        sides = {(int(ta[0]), int(tb[0])), (int(tb[0]), int(ta[0]))}  # each block against the other
        out = []
        for mine, other in sorted(sides):
            i, y = np.flatnonzero(own == mine), x[own == other]
            step = max(1, 4_000_000 // max(1, len(y)))
            for s in range(0, len(i), step):
                d2 = physical.sq_dists(x[i[s : s + step]], y)
                inside = d2 <= thr
                out.append((seq[i[s : s + step]], inside.sum(1), d2.sum(1), np.where(inside, d2, 0.0).sum(1)))
        return pa.table(dict(zip(("seq", "density", "rowsum", "rowsum_in"), (np.concatenate(c) for c in zip(*out)))))

    parts = tiles(sample, block_rows, "seq", features).groupBy("ta", "tb").applyInArrow(fn, "seq int, density bigint, rowsum double, rowsum_in double")
    return sample.join(parts.groupBy("seq").agg(*(F.sum(c).alias(c) for c in ("density", "rowsum", "rowsum_in"))), "seq")


class DensitySeeds(NamedTuple):
    centers: list[list[float]]
    rows: list[tuple[int, int, int, int]]  # (cid, seq, id, density)


def density_seed(
    sample: DataFrame,
    t2: float,
    max_centers: int = 3,
    weight: str = "reference",
    features: str = "features",
    dim: int | None = None,
) -> DensitySeeds:
    """K4 on a ``(seq, id, features)`` sample, a few small Spark jobs per centre.

    The densest row comes first. For each further centre, rows are scanned in
    sample order from where the last scan ended: rows within T2 of a centre are
    covered, and these values drop out; the first other row ends the scan, and
    the row of largest weight among the values left becomes a centre.
    ``weight='reference'`` weighs by the nearest centre's distance and the row
    sum and density of the sample row whose number the nearest centre has;
    ``'density'`` by the candidate's own density and row sum within T2.
    """
    if weight not in ("reference", "density"):
        raise ValueError(f"unknown weight {weight!r}")
    with storage.prepared(density_stats(sample, t2, features, dim=dim), "density-stats") as st:
        top = st.orderBy(F.desc("density"), "seq").limit(1).collect()
        if not top:
            return DensitySeeds([], [])
        chosen, densest = [top[0]], top[0]["density"]
        # The rows that 'reference' weights look up: as many as there may be centres.
        low = {r["seq"]: r["rowsum"] / r["density"] for r in st.where(F.col("seq") < max_centers).select("seq", "rowsum", "density").collect()}
        others = st.where(F.col(features) != F.lit(list(top[0][features])))
        covered, last = F.lit(False), -1
        while len(chosen) < max_centers:
            far = F.sqrt("d2")
            near = assign(others, [list(c[features]) for c in chosen], None, features)
            end = near.where((F.col("seq") > last) & (far > float(t2))).agg(F.min("seq").alias("s")).first()["s"]
            if end is None:
                break
            covered = covered | ((F.col("seq") > last) & (F.col("seq") < end))
            gone = others.where(covered).select(features).unionByName(others.where(F.col("seq").isin([c["seq"] for c in chosen])).select(features))
            left = near.join(gone.distinct(), features, "left_anti")
            if weight == "reference":
                scale = F.coalesce(*(F.when(F.col("cid") == m, F.lit(float(densest) * (1.0 / v) if v else float("inf"))) for m, v in sorted(low.items())))
                w = scale * far
            else:
                w = F.when(F.col("rowsum_in") == 0, F.lit(0.0)).otherwise(F.col("density") * (1.0 / (F.col("rowsum_in") / F.col("density"))) * far)
            best = left.withColumn("w", w).orderBy(F.desc("w"), "seq").limit(1).collect()
            if not best:
                break
            chosen.append(best[0])
            last = end
    return DensitySeeds([list(c[features]) for c in chosen], [(k, int(c["seq"]), int(c["id"]), int(c["density"])) for k, c in enumerate(chosen)])


class DensityResult(NamedTuple):
    centers: DataFrame  # cid int, center array<double>, size bigint, weight double
    trace: DataFrame  # iter int, delta double, sse double, clusters int
    assignments: DataFrame  # id bigint, cid int, d2 double
    radius: DataFrame  # t2 double
    seeds: DataFrame  # cid int, seq int, id bigint, density bigint, center array<double>


def kmeans_density(
    points: DataFrame,
    tol: float = 0.01,
    max_iter: int = 10,
    sample_n: int = 70,
    sample: str = "seeded",
    seed: int = DEFAULT_SEED,
    t2: float | None = None,
    coef: float = DEFAULT_COEF,
    max_centers: int = 3,
    weight: str = "reference",
    form: str = "auto",
    id_col: str = "id",
    features: str = "features",
    dim: int | None = None,
) -> DensityResult:
    """K5: adaptive radius (unless ``t2`` is given), density seeding on a
    ``sample_n`` sample (``'seeded'`` md5 order or ``'first'`` ids), Lloyd."""
    src, dim = whole_rows(points.select(F.col(id_col).alias("id"), F.col(features).alias("features")), "features", dim)
    spark = points.sparkSession
    with storage.prepared(storage.spread(src, "id"), "density") as pts:
        radius = adaptive_radius(pts, coef, dim=dim) if t2 is None else float(t2)
        smp = seeded_sample(pts, sample_n, seed) if sample == "seeded" else first_rows(pts, sample_n)
        with storage.prepared(smp, "sample") as smp:  # drawn once
            seeds = density_seed(smp, radius, max_centers, weight, dim=dim)
        if not seeds.centers:
            raise ValueError("no points")
        res = kmeans(pts, init=seeds.centers, tol=tol, max_iter=max_iter, on_empty="keep", form=form, dim=dim)
    rows = [(*r, c) for r, c in zip(seeds.rows, seeds.centers)]
    return DensityResult(
        res.centers,
        res.trace,
        predict(src, res.centers, form=form),
        local_frame(spark, [(radius,)], "t2 double"),
        local_frame(spark, rows, "cid int, seq int, id bigint, density bigint, center array<double>"),
    )
