"""C3, J4, C5 and K6 with canopies and clusters as tables, for more of them than a task's closure should hold.

* Radius join (C3, F2): points and canopies meet by cell. A cell is the floor of up
  to three coordinates over a side just above the radius: those in which the
  canopies spread most. A canopy goes to the 3^p cells around its own, a point to
  its own cell, so every pair within the radius meets in exactly one cell, and
  only there is the distance taken.
* Restricted assignment (J4, C5): (point, canopy) rows meet (canopy, cluster) rows
  on the canopy id, and each point keeps its nearest cluster (lowest id on ties).

Both are equi-joins. The side with the canopies or clusters is broadcast if its
measured rows times their width stay within ``BROADCAST_BYTES``; else both sides
are shuffled, where Spark splits skewed cells of the point side. Centres, canopies
and memberships never reach the driver; a round brings it the delta and two counts.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.plans import storage
from lodestar.plans.storage import local_frame

#: Largest measured size of a broadcast side.
BROADCAST_BYTES = 64 << 20
CELL_AXES = 3
#: Up to this width a distance is one unrolled expression.
UNROLLED_WIDTH = 32


def sq_dist(a: str, b: str, dim: int) -> F.Column:
    """Squared distance of two array columns, dimensions summed left to right."""
    if dim <= UNROLLED_WIDTH:
        diff = [f"(get({a}, {i}) - get({b}, {i}))" for i in range(dim)]
        return F.expr(" + ".join(f"({d} * {d})" for d in diff) or "0.0D")
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0.0D, (s, v) -> s + v)")


def _sized(side: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(side) if rows * row_bytes <= BROADCAST_BYTES else side.hint("merge")


def radius_join(points: DataFrame, centers: DataFrame, radius: float, dim: int, n_centers: int, broadcast: bool | None = None) -> DataFrame:
    """``points`` (with ``features``) x ``centers`` (with ``center``) at distance < ``radius``, plus ``d2``.

    ``broadcast`` overrides the size check.
    """
    side = float(radius) * (1 + 1e-6)
    low = centers.agg(*[f(F.get("center", F.lit(i))).alias(f"{n}{i}") for i in range(dim) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    spread = sorted(((-(low[f"hi{i}"] - low[f"lo{i}"]) if low[f"hi{i}"] is not None else 0.0, i) for i in range(dim)))
    axes = [i for s, i in spread[:CELL_AXES] if -s > side] or [i for _, i in spread[:1]]
    cells = [f"_cell{a}" for a in axes]
    own, around = points, centers
    for a, c in zip(axes, cells):
        own = own.withColumn(c, F.floor(F.get("features", F.lit(a)) / F.lit(side)))
        at = F.floor(F.get("center", F.lit(a)) / F.lit(side))
        around = around.withColumn(c, F.explode(F.sequence(at - 1, at + 1)))
    rows, width = n_centers * 3 ** len(axes), 8 * (dim + 2 * len(centers.columns) + len(axes))
    if broadcast is not None:
        rows, width = (0, 0) if broadcast else (BROADCAST_BYTES + 1, 1)
    met = own.join(_sized(around, rows, width), cells).drop(*cells)
    return met.withColumn("d2", sq_dist("features", "center", dim)).where(F.sqrt("d2") < float(radius))


def nearest_sharing(pairs: DataFrame, clusters: DataFrame, dim: int, n_rows: int, broadcast: bool | None = None) -> DataFrame:
    """``rid, id, features, cid`` of each point's nearest cluster among those sharing a canopy.

    ``pairs``: ``rid, id, features, canopy``; ``clusters``: ``canopy, cid, center`` (``n_rows`` of them).
    """
    rows, width = n_rows, 8 * (dim + 4)
    if broadcast is not None:
        rows, width = (0, 0) if broadcast else (BROADCAST_BYTES + 1, 1)
    met = pairs.join(_sized(clusters, rows, width), "canopy").withColumn("d2", sq_dist("features", "center", dim))
    best = met.groupBy("rid").agg(F.min(F.struct("d2", "cid")).alias("m"), F.any_value("id").alias("id"), F.any_value("features").alias("features"))
    return best.select("rid", "id", "features", F.col("m.cid").alias("cid"))


def canopy_rounds(points: DataFrame, canopies: DataFrame, n_canopies: int, t2: float, tol: float, max_iter: int, dim: int, broadcast: bool | None = None) -> dict:
    """K6 from its canopies on: all of ``CanopyResult``'s frames, read from tables that stay until ``storage.release``.

    ``points``: ``id, features`` (whole rows); ``canopies``: ``canopy, id, center``.
    """
    spark = points.sparkSession
    pts = storage.held(points.select("id", "features").withColumn("rid", F.monotonically_increasing_id()), "canopy-join-points")
    can = canopies.select("canopy", "center")
    pairs = storage.held(radius_join(pts, can, t2, dim, n_canopies, broadcast).select("rid", "id", "features", "canopy"), "canopy-join-pairs")
    n_points, n_pairs, covered = pts.count(), pairs.count(), pairs.select("rid").distinct().count()
    centers = canopies.select(F.col("canopy").alias("cid"), "center", F.lit(0).cast("bigint").alias("size"), F.lit(True).alias("active"))
    shares, n_shares = canopies.select("canopy", F.col("canopy").alias("cid"), "center"), n_canopies
    last, trace = shares, []
    for it in count(1):
        if it > max_iter or not n_shares:
            break
        last, n_last = shares, n_shares
        best = nearest_sharing(pairs, shares, dim, n_shares, broadcast)
        sums = [F.sum(F.get("features", F.lit(i))).alias(f"s{i}") for i in range(dim)]
        moved = best.groupBy("cid").agg(F.count("*").alias("n"), *sums)
        moved = storage.held(moved.select("cid", "n", F.array(*[F.col(f"s{i}") / F.col("n") for i in range(dim)]).alias("to")), "canopy-join-moved")
        both = moved.join(centers.select("cid", "center"), "cid")
        total = both.agg(F.sum(sq_dist("to", "center", dim)).alias("delta"), F.count("*").alias("n")).first()
        near = radius_join(moved.select("cid", F.col("to").alias("features")), can, t2, dim, n_canopies, broadcast)
        shares = storage.held(near.select("canopy", "cid", F.col("features").alias("center")), "canopy-join-shares")
        n_shares = shares.count()
        alive = shares.select("cid").distinct().withColumn("alive", F.lit(True))
        centers = centers.drop("size", "active").join(moved, "cid", "left").join(alive, "cid", "left")
        centers = storage.held(
            centers.select("cid", F.coalesce("to", "center").alias("center"), F.coalesce("n", F.lit(0)).alias("size"), F.coalesce("alive", F.lit(False)).alias("active")),
            "canopy-join-centers",
        )
        delta = float(total["delta"] or 0.0)
        trace.append((it, delta, int(total["n"])))
        if delta <= tol:
            break
    n_last = n_canopies if not trace else n_last
    return {
        "centers": centers,
        "canopies": canopies,
        "trace": local_frame(spark, trace, "iter int, delta double, clusters int"),
        "assignments": nearest_sharing(pairs, last, dim, n_last, broadcast).select("id", "cid"),
        "uncovered": pts.join(pairs.select("rid").distinct(), "rid", "left_anti").select("id", "features"),
        "membership": local_frame(spark, [(n_points, covered, n_pairs / covered if covered else None)], "points bigint, covered bigint, mean_canopies double"),
    }
