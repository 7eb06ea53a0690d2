"""K1: distributed Lloyd k-means with explicit or seeded centres.

Each round is one Spark job over the persisted points: assign (inlined
centres) -> partial sums per task -> shuffle of at most K rows per task ->
K rows to the driver. The driver computes the new centres and the
convergence delta (sum over centres of squared movement) from those K x D
numbers and inlines them into the next round's plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.assign import assign, centers_from_frame, collect_stats, predict
from lodestar.operators.bounded import BoundedStats
from lodestar.plans import physical, storage
from lodestar.sources.sample import DEFAULT_SEED, sample_key, seed_vectors
from lodestar.functions.vectors import elem_sql
from lodestar.plans.storage import local_frame
from lodestar.sources.text import one_width


class KMeansResult(NamedTuple):
    centers: DataFrame  # cid int, center array<double>, size bigint, weight double
    trace: DataFrame  # iter int, delta double, sse double, clusters int
    assignments: DataFrame  # id bigint, cid int, d2 double (final centres)


CENTER_SCHEMA = "cid int, center array<double>, size bigint, weight double"
ROUND_SCHEMA = "cid int, center array<double>, n bigint, weight double, delta double, sse double, clusters int"
TRACE_SCHEMA = "iter int, delta double, sse double, clusters int"


def sq_movement(a: Sequence[float], b: Sequence[float]) -> float:
    s = 0.0
    for u, v in zip(a, b):
        s += (u - v) * (u - v)
    return s


def resolve_init(
    points: DataFrame,
    k: int | None,
    init,
    seed: int = DEFAULT_SEED,
    distinct_seeds: bool = False,
    features: str = "features",
    id_col: str = "id",
) -> list[list[float]]:
    """Starting centres: an explicit list, a ``(cid, center)`` frame, or
    ``'sample'`` (md5-seeded) / ``'first'`` (lowest ids) picks of ``k`` rows."""
    if isinstance(init, DataFrame):
        return centers_from_frame(init)[1]
    if isinstance(init, str):
        if k is None or k < 1:
            raise ValueError("k >= 1 is required for seeded initialisation")
        return seed_vectors(points, k, seed, distinct_seeds, init, id_col, features)
    cs = [list(map(float, c)) for c in init]
    if k is not None and len(cs) != k:
        raise ValueError(f"{len(cs)} initial centres given for k={k}")
    return cs


def lloyd_rounds(
    points: DataFrame,
    centers: list[list[float]],
    tol: float | None,
    max_iter: int,
    features: str = "features",
    weight: str | None = None,
    on_empty: str = "keep",
    form: str = "auto",
    id_col: str = "id",
    stats=None,
    rounds: storage.Rounds | None = None,
):
    """Iterate on already-prepared points; ``stats`` replaces ``collect_stats`` for them, ``rounds`` keeps every round. Returns (centres, trace rows, last stats).

    Stops after ``max_iter`` rounds or once delta <= ``tol`` (``tol=None``:
    fixed number of rounds). At least one round runs when ``max_iter >= 1``.
    """
    if on_empty not in ("keep", "error", "reseed", "reseed-md5"):
        raise ValueError(f"unknown on_empty {on_empty!r}")
    centers = [list(c) for c in centers]
    trace, last = [], {}
    for it, rows in enumerate(rounds.done() if rounds else [], 1):
        rows = sorted(rows, key=lambda r: r["cid"])
        if [len(r["center"]) for r in rows] != [len(c) for c in centers]:
            raise ValueError("the rounds to go on from have other centres")
        centers = [list(r["center"]) for r in rows]
        last = {r["cid"]: r for r in rows if r["n"]}
        trace.append((it, rows[0]["delta"], rows[0]["sse"], rows[0]["clusters"]))
        if it >= max_iter or tol is not None and rows[0]["delta"] <= tol:
            return centers, trace, last
    for it in range(len(trace) + 1, max_iter + 1):
        rows = stats(centers) if stats else collect_stats(points, centers, None, features, weight, form)
        last = {int(r["cid"]): r for r in rows}
        new = [list(c) for c in centers]
        empty = []
        for cid in range(len(centers)):
            r = last.get(cid)
            if r is None or not r["weight"]:
                empty.append(cid)
                continue
            w = float(r["weight"])
            new[cid] = [s / w for s in r["sums"]]
        if empty and on_empty == "error":
            raise ValueError(f"empty clusters in round {it}: {empty}")
        if empty and on_empty.startswith("reseed"):
            fcols = list(features) if isinstance(features, (list, tuple)) else [features]
            rows_ = points.select(id_col, *fcols)
            if on_empty == "reseed":
                rows_ = assign(rows_, centers, None, features, form).orderBy(F.desc("d2"), F.col(id_col))
            else:
                rows_ = rows_.orderBy(sample_key(id_col), F.col(id_col))
            far = (
                rows_.limit(len(empty))
                .select(*fcols)
                .collect()
            )
            for cid, r in zip(empty, far):
                wide = isinstance(features, (list, tuple))
                new[cid] = [float(v) for v in r] if wide else list(r[0])
        delta = sum(sq_movement(a, b) for a, b in zip(centers, new))
        sse = float(sum(float(r["sse"]) for r in rows))
        trace.append((it, float(delta), sse, len(rows)))
        centers = new
        if rounds:
            told = [(last.get(i, {"n": 0})["n"], float(last.get(i, {"weight": 0.0})["weight"])) for i in range(len(centers))]
            rounds.commit(it, [(i, c, n, w, *trace[-1][1:]) for i, (c, (n, w)) in enumerate(zip(centers, told))], ROUND_SCHEMA)
        if tol is not None and delta <= tol:
            break
    return centers, trace, last


def kmeans(
    points: DataFrame,
    k: int | None = None,
    init="sample",
    tol: float | None = 0.01,
    max_iter: int = 100,
    seed: int = DEFAULT_SEED,
    on_empty: str = "keep",
    weight: str | None = None,
    distinct_seeds: bool = False,
    form: str = "auto",
    features: str = "features",
    id_col: str = "id",
    checkpoint: bool | None = None,
    dim: int | None = None,
    computed: list | None = None,
    resume: str | None = None,
) -> KMeansResult:
    """Lloyd k-means on ``(id, features[, weight])`` rows.

    ``init``: list of vectors, a ``(cid, center)`` DataFrame, ``'sample'``
    (md5-seeded sample of ``k`` rows, see ``sources.sample``) or ``'first'``.
    ``dim``: the vectors' width; without it all widths are checked (one job).
    Rows of another width, or with a null, take no part.
    ``on_empty``: ``'keep'`` (an empty cluster keeps its centre), ``'error'``,
    ``'reseed'`` (farthest point from its centre, lowest id on ties) or
    ``'reseed-md5'`` (points in the order of the seeded sample).
    The points are iterated on as ``plans.storage.prepared`` says.
    ``form='bounds'`` remembers bounds between rounds (see ``operators.bounded``), for
    many centres; ``computed`` then gets each round's number of distances.
    ``resume``: a shared folder to commit every round's centres and trace to; a run
    that finds rounds there goes on after the last one, and ends as one run would.
    """
    spark = points.sparkSession
    cols = [id_col, features] + ([weight] if weight else [])
    seeded = isinstance(init, str)
    if seeded:
        # Only the dimension is needed before the points are prepared; the
        # seeds are then drawn from the persisted copy, so the source is read
        # once (the seeding pass also fills the cache).
        if k is None or k < 1:
            raise ValueError("k >= 1 is required for seeded initialisation")
        kk = k
        d = dim or one_width(points.where(F.col(features).isNotNull()).select(F.size(features).alias("width")))
        if not d:
            raise ValueError("no points")
    else:
        start = resolve_init(points.select(*cols), k, init, seed, distinct_seeds, features, id_col)
        kk, d = len(start), len(start[0])
    # For the expression form, one double column per dimension: scanned
    # vectorized, while an array column is decoded row by row on every round.
    # The Arrow kernel reads the array's flat buffer zero-copy.
    bounds, form = form == "bounds", "arrow" if form == "bounds" else form
    if physical.choose_form(kk, d, form) == "expr":
        feats = [f"_x{i}" for i in range(d)]
        fcols = [F.expr(x).alias(c) for x, c in zip(elem_sql(features, d), feats)]
    else:
        feats, fcols = features, [F.col(features)]
    whole = (F.size(features) == d) & ~F.exists(features, lambda v: v.isNull())
    src = points.where(whole).select(F.col(id_col), *fcols, *([F.col(weight)] if weight else []))
    with storage.prepared(storage.spread(src, id_col), "kmeans", checkpoint) as pts:
        if seeded:
            vec = F.array(*[F.col(c) for c in feats]) if isinstance(feats, list) else F.col(feats)
            start = seed_vectors(pts.select(id_col, vec.alias("_seedvec")), k, seed, distinct_seeds, init, id_col, "_seedvec")
        with ExitStack() as stack:
            stats = BoundedStats(pts, feats, weight, computed, stack) if bounds else None
            centers, trace, last = lloyd_rounds(
                pts, start, tol, max_iter, feats, weight, on_empty, form, id_col, stats, storage.Rounds(spark, resume) if resume else None
            )
    crow = []
    for cid, c in enumerate(centers):
        r = last.get(cid)
        crow.append((cid, c, int(r["n"]) if r else 0, float(r["weight"]) if r else 0.0))
    cdf = local_frame(spark, crow, CENTER_SCHEMA)
    tdf = local_frame(spark, trace, TRACE_SCHEMA)
    adf = predict(points.select(*cols), centers, features, id_col, form)
    return KMeansResult(cdf, tdf, adf)
