"""Canopy k-means.

1. C1 local canopies: inside each bucket, points are scanned in id order and
   a point becomes a local centre iff its distance to every local centre so
   far is > T1. The number of buckets is a parameter, never the row count: a
   new row changes its own bucket's centres alone. Rows of ordinary buckets are
   sorted by Spark and stream through; a task holds the centres of one bucket and
   no bucket whole. A large bucket goes in rounds over all cores.
2. C2 global merge: the same greedy rule with T3 over the local centres in
   (bucket, id, features) order, nulls first, in the same rounds; canopy ids 1..M
   in acceptance order. Candidates and canopies stay on Spark.
3. C3 membership: each point gets the array of canopies with distance < T2;
   points in none are returned as ``uncovered`` and take no further part.
4. Rounds: C5 each point joins the nearest cluster that shares one of its
   canopies (an array-overlap test inside the assignment expression, so no
   join and no shuffle of points), A1/A2 new centres, C4 each moved centre
   gets the canopies within T2 of it, A8 delta over the clusters that got
   points. A cluster with no points or no canopy leaves the active set but
   keeps its last centre.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import canopy_join
from lodestar.functions.vectors import elem_sql, sq_dist_sql, sql_double, with_nearest
from lodestar.operators.assign import collect_stats_sql, assign, stats_from_partials
from lodestar.operators.greedy import greedy_pick, greedy_rounds, ordered, walked
from lodestar.operators.lloyd import sq_movement
from lodestar.plans import physical, storage
from lodestar.plans.storage import local_frame
from lodestar.sources.table import whole_rows

DEFAULT_BUCKETS = 64
#: Rows of a bucket that one task takes by itself.
BUCKET_ROWS = 100_000
MERGE_CHUNK = 20_000
#: Rows without a bucket share this one.
NO_BUCKET = -(1 << 31)


class CanopyResult(NamedTuple):
    centers: DataFrame  # cid int, center array<double>, size bigint, active boolean
    canopies: DataFrame  # canopy int, id bigint, center array<double>
    trace: DataFrame  # iter int, delta double, clusters int
    assignments: DataFrame  # id bigint, cid int  (last round, centres before its update)
    uncovered: DataFrame  # id bigint, features array<double>
    membership: DataFrame  # points bigint, covered bigint, mean_canopies double (over covered points)


def _bucketed(points: DataFrame, buckets: int, bucket_col, id_col) -> DataFrame:
    if bucket_col is not None:
        return points.withColumn("bucket", F.coalesce(F.col(bucket_col).cast("int"), F.lit(NO_BUCKET)))
    return points.withColumn("bucket", F.pmod(F.xxhash64(F.col(id_col)), F.lit(int(buckets))).cast("int"))


def local_canopies(
    points: DataFrame,
    t1: float,
    buckets: int = DEFAULT_BUCKETS,
    bucket_col: str | None = None,
    id_col: str = "id",
    features: str = "features",
    dim: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(bucket, id, features)`` of the local canopy centres.

    A bucket of up to ``bucket_rows`` rows streams through one task. Larger ones
    (the largest first, at most two a core) go in rounds over all cores, see
    ``operators.greedy``; so does ``buckets=1``, the sequential pass over all points.
    """
    pts, dim = whole_rows(_bucketed(points, buckets, bucket_col, id_col), features, dim)
    pts = pts.select("bucket", F.col(id_col).cast("bigint").alias("id"), F.col(features).alias("features"))
    radius = float(t1)

    def fn(batches):
        now, cent = None, None
        for rb in batches:
            if rb.num_rows == 0:
                continue
            own = rb.column(0).to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
            picked = []
            for lo, hi in zip(edge[:-1], edge[1:]):
                x, _ = physical._features_matrix(rb.slice(lo, hi - lo), "features", dim)
                if own[lo] != now:
                    now, cent = own[lo], np.zeros((0, dim))
                i = greedy_pick(x, radius, cent if len(cent) else None)
                cent = np.vstack([cent, x[i]])
                picked += [lo + j for j in i]
            yield rb.take(pa.array(picked, pa.int64()))

    most = 2 * points.sparkSession.sparkContext.defaultParallelism
    large = pts.groupBy("bucket").count().where(F.col("count") > bucket_rows).orderBy(F.desc("count"), "bucket").limit(most)
    large = [r["bucket"] for r in large.collect()]
    small = pts.where(~F.col("bucket").isin(large)) if large else pts
    streamed = small.repartition("bucket").sortWithinPartitions("bucket", "id", "features")
    streamed = streamed.mapInArrow(fn, "bucket int, id bigint, features array<double>")
    if not large:
        return streamed
    rows = ordered(pts.where(F.col("bucket").isin(large)), "bucket", "id", "features").withColumnRenamed("bucket", "grp")
    with storage.prepared(rows, "large-buckets", stored=True) as rows:
        found = greedy_rounds(rows, radius, dim, len(large))
    for table in found:
        streamed = streamed.unionByName(table.select(F.col("grp").alias("bucket"), "id", "features"))
    return streamed


def global_canopies(candidates: DataFrame, t3: float, chunk: int = MERGE_CHUNK, dim: int | None = None) -> DataFrame:
    """``(canopy, id, center)`` from ``(bucket, id, features)`` candidates, in rounds of at most ``chunk`` candidates.

    Canopies are numbered from 1 as they are accepted. The candidates stay on Spark.
    """
    cands, dim = whole_rows(candidates, "features", dim)
    by = ("bucket", "id", "features")
    rows = cands.select("bucket", F.col("id").cast("bigint").alias("id"), F.col("features").cast("array<double>").alias("features"), F.lit(0).alias("grp"))
    first = rows.orderBy(*by).limit(chunk + 1).withColumn("seq", F.monotonically_increasing_id())
    table, ends = walked(first, float(t3), dim, chunk)
    tables, trace = [table], [sum(r["n"] for r in ends)]
    if any(r["more"] for r in ends):  # more candidates than one walk takes
        trace = []
        with storage.prepared(ordered(rows, *by), "candidates", stored=True) as rows:
            tables = greedy_rounds(rows, float(t3), dim, 1, chunk, trace)
    out, before = None, 0
    for table, n in zip(tables, trace):
        part = table.select((F.col("nth") + F.lit(before + 1)).cast("int").alias("canopy"), "id", F.col("features").alias("center"))
        out, before = part if out is None else out.unionByName(part), before + n
    return out


def merge_canopies(candidates: DataFrame, t3: float, chunk: int = MERGE_CHUNK, dim: int | None = None) -> list[tuple[int, int, list[float]]]:
    """C2 as a list ``[(canopy, id, vector)]``, for as many canopies as a driver may hold."""
    return canopy_rows(global_canopies(candidates, t3, chunk, dim))


def canopy_rows(canopies: DataFrame) -> list[tuple[int, int, list[float]]]:
    return [(r["canopy"], r["id"], list(r["center"])) for r in canopies.orderBy("canopy").collect()]


def canopy_membership(
    points: DataFrame,
    canopies: Sequence[tuple[int, Sequence[float]]],
    t2: float,
    features: str = "features",
    form: str = "auto",
) -> DataFrame:
    """Add ``canopies array<int>``: every canopy with distance < T2."""
    ids = [int(c) for c, _ in canopies]
    vecs = [list(map(float, v)) for _, v in canopies]
    if not vecs:
        return points.withColumn("canopies", F.array().cast("array<int>"))
    f = physical.choose_form(len(vecs), len(vecs[0]), form)
    if f == "expr":
        xs = elem_sql(features, len(vecs[0]))
        hits = [f"CASE WHEN sqrt({sq_dist_sql(xs, v)}) < {sql_double(t2)} THEN {c} END" for c, v in zip(ids, vecs)]
        return points.withColumn("canopies", F.expr(f"array_compact(array({', '.join(hits)}))"))
    schema = T.StructType(points.schema.fields + [T.StructField("canopies", T.ArrayType(T.IntegerType()))])
    return points.mapInArrow(physical.arrow_within_fn(vecs, ids, float(t2), features), schema)


def _eligibility(csets: Sequence[Sequence[int]]) -> list[str]:
    return [f"arrays_overlap(canopies, array({', '.join(str(int(c)) for c in cs)}))" for cs in csets]


def restricted_assign(
    memb: DataFrame,
    clusters: dict[int, tuple[list[float], list[int]]],
    canopy_ids: Sequence[int],
    features: str = "features",
    form: str = "auto",
) -> DataFrame:
    """C5 + A3: nearest cluster among those sharing a canopy; rows with none drop."""
    cids = sorted(clusters)
    vecs = [clusters[c][0] for c in cids]
    csets = [clusters[c][1] for c in cids]
    f = physical.choose_form(len(vecs), len(vecs[0]), form)
    if f == "expr":
        # Keep only points sharing a canopy with some cluster, tested on the
        # membership array before any distance: a filter on the derived cid
        # would be pushed below the projections and recompute the distances.
        union = sorted({int(c) for cs in csets for c in cs})
        has = F.expr(f"arrays_overlap(canopies, array({', '.join(map(str, union)) or 'CAST(NULL AS INT)'}))")
        return with_nearest(memb.where(has), features, vecs, cids, _eligibility(csets))
    else:
        schema = T.StructType(
            memb.schema.fields + [T.StructField("cid", T.IntegerType()), T.StructField("d2", T.DoubleType())]
        )
        out = memb.mapInArrow(
            physical.arrow_restricted_assign_fn(vecs, cids, csets, canopy_ids, features), schema
        )
    return out.where(F.col("cid").isNotNull())


def _restricted_stats(memb, clusters, canopy_ids, features, form) -> list:
    cids = sorted(clusters)
    vecs = [clusters[c][0] for c in cids]
    f = physical.choose_form(len(vecs), len(vecs[0]), form)
    if f == "expr":
        csets = [clusters[c][1] for c in cids]
        return collect_stats_sql(
            memb.select(features, "canopies"), vecs, cids, features, None,
            eligible=_eligibility(csets), extra=["canopies"],
        )
    part = memb.select(features, "canopies").mapInArrow(
        physical.arrow_restricted_stats_fn(vecs, cids, [clusters[c][1] for c in cids], canopy_ids, features),
        "cid int, dim int, value double",
    )
    return stats_from_partials(part).select("cid", "n", "sums").collect()


def distinct_points(points: DataFrame, id_col: str = "id", features: str = "features", extra: Sequence[str] = ()) -> DataFrame:
    """A4: points equal by value as one row, with the lowest id (and its extra columns)."""
    aggs = [F.min(F.struct(F.col(id_col).alias("id"), *extra)).alias("m")]
    return points.groupBy(F.col(features).alias("features")).agg(*aggs).select("m.id", "features", *[f"m.{c}" for c in extra])


def find_canopies(pts: DataFrame, t1: float, t3: float, buckets: int = DEFAULT_BUCKETS, bucket_col: str | None = None, dim: int | None = None) -> DataFrame:
    """The global canopies ``(canopy, id, center)`` as a stored table."""
    pts, dim = whole_rows(pts, "features", dim)
    with storage.prepared(local_canopies(pts, t1, buckets, bucket_col, dim=dim), "local-canopies") as cands:
        return global_canopies(cands, t3, dim=dim)


def covered_points(pts: DataFrame, canopies: Sequence[tuple[int, Sequence[float]]], t2: float, cover: str = "drop", form: str = "auto") -> DataFrame:
    """C3 with ``cover='nearest'``: a point in no canopy belongs to its nearest one (else to none)."""
    memb = canopy_membership(pts, canopies, t2, "features", form)
    if cover == "drop" or not canopies:
        return memb
    near = assign(memb, [v for _, v in canopies], [c for c, _ in canopies])
    own = F.when((F.size("canopies") > 0) | F.col("cid").isNull(), F.col("canopies")).otherwise(F.array("cid"))
    return near.select(*pts.columns, own.alias("canopies"))


def kmeans_canopy(
    points: DataFrame,
    t1: float,
    t2: float,
    t3: float,
    tol: float = 0.001,
    max_iter: int = 20,
    distinct: bool = True,
    buckets: int = DEFAULT_BUCKETS,
    bucket_col: str | None = None,
    cover: str = "drop",
    form: str = "auto",
    id_col: str = "id",
    features: str = "features",
    checkpoint: bool | None = None,
    dim: int | None = None,
) -> CanopyResult:
    """K6: canopy k-means; K = number of global canopies.

    Rows whose vector is null, holds a null or has another width than ``dim`` take
    no part; without ``dim`` all widths are counted (one job) and must agree.

    ``distinct=True`` first collapses points equal by value (lowest id kept),
    as the reference keys points by their vector. Loop: while delta > tol and
    rounds < max_iter, with at least one round. ``cover='nearest'`` sends points
    in no canopy to the nearest one instead of leaving them out.
    ``form='join'`` keeps canopies and clusters as tables, see ``operators.canopy_join``;
    so does ``'auto'`` where they have more than ``MAX_CENTER_NUMBERS`` numbers.
    """
    if cover not in ("drop", "nearest"):
        raise ValueError(f"unknown cover {cover!r}")
    spark = points.sparkSession
    extra = [bucket_col] if bucket_col else []
    points, dim = whole_rows(points, features, dim)
    if distinct:
        pts = distinct_points(points, id_col, features, extra)
    else:
        pts = points.select(F.col(id_col).alias("id"), F.col(features).alias("features"), *extra)
    base = pts  # source lineage, for the lazily evaluated outputs
    with storage.prepared(storage.spread(pts, "id"), "canopy-points", checkpoint) as pts:
        found = find_canopies(pts, t1, t3, buckets, bucket_col, dim)
        n = found.count() if form in ("auto", "join") else 0
        if form == "join" or n * dim > physical.MAX_CENTER_NUMBERS and form == "auto":
            if cover != "drop":
                raise ValueError("cover='nearest' needs form='expr' or 'arrow'")
            return CanopyResult(**canopy_join.canopy_rounds(pts, found, n, t2, tol, max_iter, dim))
        canopies = canopy_rows(found)
        canopy_list = [(c, v) for c, _, v in canopies]
        canopy_ids = [c for c, _ in canopy_list]
        where = np.array([v for _, v in canopy_list], dtype=np.float64)
        store = {c: list(v) for c, v in canopy_list}
        active = {c: (list(v), [c]) for c, v in canopy_list}
        trace, sizes, last_active = [], {}, dict(active)
        # Stored first, then filtered: a filter on the derived array would be
        # pushed into the projection and build every array twice.
        with storage.prepared(covered_points(pts.select("id", "features"), canopy_list, t2, cover, form), "canopy-members", checkpoint) as stored:
            memb = stored.where(F.size("canopies") > 0)
            n = F.size("canopies")
            counts = stored.agg(F.count("*").alias("points"), F.count_if(n > 0).alias("covered"), F.avg(F.when(n > 0, n)).alias("mean_canopies")).collect()
            for it in range(1, max_iter + 1):
                if not active:
                    break
                last_active = dict(active)
                rows = _restricted_stats(memb, active, canopy_ids, "features", form)
                new = {int(r["cid"]): [s / float(r["n"]) for s in r["sums"]] for r in rows}
                sizes = {int(r["cid"]): int(r["n"]) for r in rows}
                delta = sum(sq_movement(new[c], store[c]) for c in new)
                store.update(new)
                # C4: the canopies within T2 of each moved centre.
                moved = sorted(new)
                inside = physical.within(np.array([new[c] for c in moved]), where, t2) if moved else []
                active = {c: (new[c], [canopy_ids[i] for i in at]) for c, at in zip(moved, inside) if len(at)}
                trace.append((it, float(delta), len(new)))
                if delta <= tol:
                    break
    crow = [(c, store[c], sizes.get(c, 0), c in active) for c in sorted(store)]
    cdf = local_frame(spark, crow, "cid int, center array<double>, size bigint, active boolean")
    kdf = local_frame(spark, canopies, "canopy int, id bigint, center array<double>")
    tdf = local_frame(spark, trace, "iter int, delta double, clusters int")
    bdf = local_frame(spark, counts, "points bigint, covered bigint, mean_canopies double")
    # Lazy outputs read the source, not the prepared copy that is gone.
    memb_all = covered_points(base.select("id", "features"), canopy_list, t2, cover, form)
    if last_active:
        memb_lazy = memb_all.where(F.size("canopies") > 0)
        adf = restricted_assign(memb_lazy, last_active, canopy_ids, "features", form).select("id", "cid")
    else:
        adf = local_frame(spark, [], "id bigint, cid int")
    udf_ = memb_all.where(F.size("canopies") == 0).select("id", "features")
    return CanopyResult(cdf, kdf, tdf, adf, udf_, bdf)
