"""Two-level ("re-clustered") k-means.

Each outer round:
1. assign every point to the current centres and sum per (bucket, cluster):
   the partial centroids, at most ``buckets x K`` rows, each weighted by the
   points behind it (one Spark job; the bucket is a hash of the id, or a
   given column). They stay a table, written once a round;
2. K2a: the K closest pairs of distinct partial centroids give K midpoints
   as starting centres;
3. K2b: ``inner_iter`` fixed Lloyd rounds over the partial centroids only
   (weighted by default; ``weighted=False`` counts each centroid once, as the
   reference does), an empty cluster reseeded with the centroid farthest from
   its centre (lowest id on ties). Too few pairs or centroids for K seeds leave
   the remaining centres as they were, so there are always K;
4. delta = sum of squared movement between the old and new centres.
The reference compares the new centres with themselves (delta always 0, one
outer round); ``max_iter=1`` reproduces that.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.vectors import elem_sql
from lodestar.operators.assign import assign, collect_stats, predict
from lodestar.operators.lloyd import lloyd_rounds, resolve_init, sq_movement
from lodestar.operators.pairs import closest_pairs
from lodestar.plans import physical, storage
from lodestar.sources.sample import DEFAULT_SEED
from lodestar.plans.storage import local_frame
from lodestar.sources.table import whole_rows

class TwoLevelResult(NamedTuple):
    centers: DataFrame  # cid int, center array<double>
    trace: DataFrame  # iter int, delta double, partials int
    assignments: DataFrame  # id bigint, cid int, d2 double


def partial_centroids(
    points: DataFrame,
    centers: list[list[float]],
    bucket: str = "bucket",
    features: str = "features",
    form: str = "auto",
) -> DataFrame:
    """Per (bucket, cid): ``id = bucket * K + cid``, mean vector, point count as weight.

    Stays a DataFrame (buckets x K rows); tasks hold a bounded number of sums.
    """
    k, d = len(centers), len(centers[0])
    src = points.select(F.col(bucket).cast("int").alias("bucket"), features)
    if physical.choose_form(k, d, form) == "expr" or k * d > physical.MAX_CENTER_NUMBERS:
        xs = elem_sql(features, d)
        g = assign(src, centers, None, features, form).groupBy("bucket", "cid").agg(
            F.count(F.lit(1)).alias("n"), F.count("cid").alias("_known"), *[F.expr(f"sum({x})").alias(f"_s{i}") for i, x in enumerate(xs)]
        )
        g = g.where("_known > 0").select("bucket", "cid", "n", F.array(*[F.col(f"_s{i}") for i in range(d)]).alias("sums"))
    else:
        part = src.mapInArrow(
            physical.arrow_group_stats_fn(centers, list(range(k)), "bucket", features),
            "grp int, cid int, dim int, value double",
        )
        tot = part.groupBy("grp", "cid", "dim").agg(F.sum("value").alias("value"))
        sums = F.array_sort(F.collect_list(F.when(F.col("dim") >= 0, F.struct("dim", "value"))))
        g = tot.groupBy(F.col("grp").alias("bucket"), "cid").agg(
            F.max(F.when(F.col("dim") == physical.DIM_COUNT, F.col("value"))).alias("n"), F.transform(sums, lambda s: s["value"]).alias("sums")
        )
    return g.select(
        (F.col("bucket").cast("bigint") * k + F.col("cid")).alias("id"),
        "bucket",
        "cid",
        F.transform("sums", lambda v: v / F.col("n")).alias("features"),
        F.col("n").cast("double").alias("weight"),
    )


#: Up to this many partial centroids are one partition, so that a round over them needs no shuffle.
ONE_PARTITION = 20_000


def seeds_from_pairs(
    centroids: DataFrame, k: int, ordered: bool = False, old: list[list[float]] | None = None, n: int | None = None, dim: int | None = None
) -> list[list[float]]:
    """Midpoints of the k closest pairs; too few pairs are made up from the
    heaviest centroids, and too few centroids from the centres before (``old``)."""
    mids = [list(r["mid"]) for r in closest_pairs(centroids, k, ordered, n=n, dim=dim).orderBy("rank").collect()]
    if len(mids) < k:
        extra = centroids.orderBy(F.desc("weight"), "id").limit(k - len(mids)).select("features").collect()
        mids += [list(r[0]) for r in extra]
    return mids + [list(c) for c in (old or [])[len(mids) :]]


def inner_kmeans(
    centroids: DataFrame,
    seeds: list[list[float]],
    inner_iter: int = 10,
    weighted: bool = True,
    form: str = "auto",
    reseed: str = "reseed",
) -> list[list[float]]:
    """Fixed rounds of Lloyd over the centroid table, empty clusters reseeded
    (``reseed``: ``'reseed'`` the farthest centroid, ``'reseed-md5'`` in md5 order)."""
    centers, _trace, _last = lloyd_rounds(
        centroids,
        seeds,
        tol=None,
        max_iter=inner_iter,
        features="features",
        weight="weight" if weighted else None,
        on_empty=reseed,
        form=form,
        id_col="id",
    )
    return centers


def kmeans_two_level(
    points: DataFrame,
    k: int,
    init="sample",
    tol: float | None = 0.01,
    max_iter: int = 10,
    inner_iter: int = 10,
    buckets: int = 8,
    bucket_col: str | None = None,
    weighted: bool = True,
    ordered_pairs: bool = False,
    seed: int = DEFAULT_SEED,
    reseed: str = "reseed",
    form: str = "auto",
    id_col: str = "id",
    features: str = "features",
    dim: int | None = None,
) -> TwoLevelResult:
    """K2. Rows of another width than ``dim``, or with a null, take no part; without ``dim`` all widths are counted."""
    spark = points.sparkSession
    bcol = (
        F.col(bucket_col).cast("int")
        if bucket_col
        else F.pmod(F.xxhash64(F.col(id_col)), F.lit(int(buckets))).cast("int")
    )
    points, dim = whole_rows(points, features, dim)
    src = points.select(F.col(id_col).alias("id"), F.col(features).alias("features"), bcol.alias("bucket"))
    with storage.prepared(storage.spread(src, "id"), "two-level") as pts:
        centers = resolve_init(pts, k, init, seed, False, "features", "id")
        trace = []
        for it in range(1, max_iter + 1):
            with storage.prepared(partial_centroids(pts, centers, "bucket", "features", form), "partials") as cent:
                n = cent.count()
                cent = cent.coalesce(1) if n <= ONE_PARTITION else cent
                if len(centers) == 1:
                    (one,) = collect_stats(cent, centers, None, "features", "weight")
                    new = [[s / one["weight"] for s in one["sums"]]]
                else:
                    seeds = seeds_from_pairs(cent, len(centers), ordered_pairs, centers, n, dim)
                    new = inner_kmeans(cent, seeds, inner_iter, weighted, form, reseed)
            delta = sum(sq_movement(a, b) for a, b in zip(centers, new, strict=True))
            trace.append((it, float(delta), n))
            centers = new
            if tol is not None and delta <= tol:
                break
    cdf = local_frame(spark, list(enumerate(centers)), "cid int, center array<double>")
    tdf = local_frame(spark, trace, "iter int, delta double, partials int")
    adf = predict(points.select(F.col(id_col).alias("id"), F.col(features).alias("features")), centers)
    return TwoLevelResult(cdf, tdf, adf)
