"""Nearest-centre assignment and per-cluster sums.

Centres are a driver-side list (K x D numbers) inlined into the plan, so the
"points x centres" product is a projection, not a join: no shuffle, no
broadcast exchange, and the same plan every round. Beyond
``plans.physical.MAX_CENTER_NUMBERS`` numbers they are inlined block by block,
each block lowering the best centre so far: the same answer in one pass.

A row whose vector is null, holds a null or has another length than the centres
gets a null ``cid`` and ``d2`` and enters no statistic, in either form.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vectors import elem_sql, sq_dist_sql, with_nearest
from lodestar.plans import physical


def _fcols(features) -> list[str]:
    return list(features) if isinstance(features, (list, tuple)) else [features]


def _dims(centers: Sequence[Sequence[float]]) -> int:
    if not centers:
        raise ValueError("need at least one centre")
    d = len(centers[0])
    if any(len(c) != d for c in centers):
        raise ValueError("centres differ in length")
    return d


def assign(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    ids: Sequence[int] | None = None,
    features: str = "features",
    form: str = "auto",
    inline_limit: int = physical.MAX_CENTER_NUMBERS,
    compared=None,
) -> DataFrame:
    """Append ``cid`` (nearest centre, lowest position on ties) and ``d2`` to every row.

    Many centres are searched by their boxes (``physical.CenterIndex``); ``compared``,
    an accumulator, counts the distances computed by the Arrow form.
    """
    centers = [list(map(float, c)) for c in centers]
    ids = list(range(len(centers))) if ids is None else [int(i) for i in ids]
    d = _dims(centers)
    f = physical.choose_form(len(centers), d, form)
    if f == "expr":
        return with_nearest(points, features, centers, ids)
    schema = T.StructType(
        points.schema.fields
        + [T.StructField("cid", T.IntegerType()), T.StructField("d2", T.DoubleType())]
    )
    step = max(1, inline_limit // d)
    out = points.mapInArrow(physical.arrow_assign_fn(centers[:step], ids[:step], features, compared=compared), schema)
    for s in range(step, len(centers), step):
        out = out.mapInArrow(physical.arrow_assign_fn(centers[s : s + step], ids[s : s + step], features, True, compared), schema)
    return out


def predict(
    points: DataFrame,
    centers: Sequence[Sequence[float]] | DataFrame,
    features: str = "features",
    id_col: str = "id",
    form: str = "auto",
    inline_limit: int = physical.MAX_CENTER_NUMBERS,
) -> DataFrame:
    """``(id, cid, d2)`` for every point against fixed centres."""
    if isinstance(centers, DataFrame):
        ids, centers = centers_from_frame(centers)
    else:
        ids = None
    return assign(points.select(id_col, *_fcols(features)), centers, ids, features, form, inline_limit).select(
        id_col, "cid", "d2"
    )


def centers_from_frame(
    centers: DataFrame, cid: str = "cid", center: str = "center"
) -> tuple[list[int], list[list[float]]]:
    """Collect a small centre table ordered by id (bounded K x D)."""
    rows = centers.select(cid, center).orderBy(cid).collect()
    return [int(r[0]) for r in rows], [list(map(float, r[1])) for r in rows]


def cluster_stats(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    ids: Sequence[int] | None = None,
    features: str = "features",
    weight: str | None = None,
    form: str = "auto",
) -> DataFrame:
    """Per non-empty cluster: ``cid, n, weight, sse, sums array<double>``.

    ``n`` counts rows, ``weight`` sums the weight column (= n without one),
    ``sse`` sums weight x squared distance, ``sums`` the weighted vectors.
    Spark aggregates partially in every task before the shuffle on ``cid``.
    """
    centers = [list(map(float, c)) for c in centers]
    ids = list(range(len(centers))) if ids is None else [int(i) for i in ids]
    d = _dims(centers)
    f = physical.choose_form(len(centers), d, form)
    cols = _fcols(features) + ([weight] if weight else [])
    pts = points.select(*cols)
    if f == "expr" or len(centers) * d > physical.MAX_CENTER_NUMBERS:
        a = assign(pts, centers, ids, features, f)
        xs = elem_sql(features, d)
        wt = f" * `{weight}`" if weight else ""
        aggs = [
            F.count(F.lit(1)).alias("n"),
            (F.sum(weight) if weight else F.count(F.lit(1)).cast("double")).alias("weight"),
            F.expr(f"sum(d2{wt})").alias("sse"),
        ] + [F.expr(f"sum({xs[i]}{wt})").alias(f"_s{i}") for i in range(d)]
        # The null group goes by an aggregate: a filter on cid would be pushed below the distances.
        got = a.groupBy("cid").agg(*aggs, F.count("cid").alias("_known")).where("_known > 0")
        return got.select("cid", "n", "weight", "sse", F.array(*[F.col(f"_s{i}") for i in range(d)]).alias("sums"))
    part = pts.mapInArrow(
        physical.arrow_partial_stats_fn(centers, ids, features, weight),
        "cid int, dim int, value double",
    )
    return stats_from_partials(part)


def stats_from_partials(part: DataFrame) -> DataFrame:
    """Sum long-form task partials ``(cid, dim, value)`` into one row per cluster."""
    tot = part.groupBy("cid", "dim").agg(F.sum("value").alias("value"))

    def pick(code):
        return F.max(F.when(F.col("dim") == code, F.col("value")))

    return tot.groupBy("cid").agg(
        pick(physical.DIM_COUNT).cast("bigint").alias("n"),
        pick(physical.DIM_WEIGHT).alias("weight"),
        pick(physical.DIM_SSE).alias("sse"),
        F.transform(
            F.array_sort(
                F.collect_list(F.when(F.col("dim") >= 0, F.struct("dim", "value")))
            ),
            lambda s: s["value"],
        ).alias("sums"),
    )


def collect_stats(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    ids: Sequence[int] | None = None,
    features: str = "features",
    weight: str | None = None,
    form: str = "auto",
) -> list[dict]:
    """``cluster_stats`` rows as dicts on the driver (K rows, K x D numbers).

    The Arrow form stops after the single ``(cid, dim)`` shuffle and builds
    the K rows here, saving the second aggregation stage of every round.
    """
    centers = [list(map(float, c)) for c in centers]
    ids = list(range(len(centers))) if ids is None else [int(i) for i in ids]
    d = _dims(centers)
    f = physical.choose_form(len(centers), d, form)
    if f == "expr":
        return collect_stats_sql(points, centers, ids, features, weight)
    if len(centers) * d > physical.MAX_CENTER_NUMBERS:
        return [r.asDict() for r in cluster_stats(points, centers, ids, features, weight, form).collect()]
    cols = _fcols(features) + ([weight] if weight else [])
    part = points.select(*cols).mapInArrow(
        physical.arrow_partial_stats_fn(centers, ids, features, weight),
        "cid int, dim int, value double",
    )
    tot = part.groupBy("cid", "dim").agg(F.sum("value").alias("value")).collect()
    return assemble_long(tot, _dims(centers))


def collect_stats_sql(points, centers, ids, features, weight, eligible=None, extra=()) -> list[dict]:
    """The expression-form round as one SQL statement over a temporary view.

    Same plan as ``cluster_stats`` (distances, minimum, first centre at the
    minimum, partial + final aggregation on ``cid``), but the driver parses
    and analyses one statement instead of one DataFrame per step, which is
    most of the per-round driver time on small inputs.
    """
    spark = points.sparkSession
    d = len(centers[0])
    xs = elem_sql(features, d)
    carry = [f"`{c}`" for c in _fcols(features)] + ([f"`{weight}`"] if weight else [])
    carry += [f"`{c}`" for c in extra]
    dnames = [f"`_d{k}`" for k in range(len(centers))]
    dexpr = []
    for k, (c, n) in enumerate(zip(centers, dnames)):
        e = sq_dist_sql(xs, c)
        if eligible is not None:  # masked centres give null; least() skips nulls
            e = f"CASE WHEN {eligible[k]} THEN {e} END"
        dexpr.append(f"{e} AS {n}")
    m = dnames[0] if len(dnames) == 1 else f"least({', '.join(dnames)})"
    case = " ".join(f"WHEN {n} = `_m` THEN {cid}" for n, cid in zip(dnames, ids))
    wt = f" * `{weight}`" if weight else ""
    wsum = f"sum(`{weight}`)" if weight else "CAST(count(1) AS DOUBLE)"
    sums = ", ".join(f"sum({x}{wt}) AS `_s{i}`" for i, x in enumerate(xs))
    view = f"lodestar_round_{uuid.uuid4().hex[:16]}"
    points.createOrReplaceTempView(view)
    try:
        rows = spark.sql(
            f"SELECT cid, count(1) AS n, {wsum} AS weight, sum(d2{wt}) AS sse, {sums} FROM ("
            f"SELECT {', '.join(carry)}, CAST(CASE {case} END AS INT) AS cid, `_m` AS d2 FROM ("
            f"SELECT {', '.join(carry)}, {', '.join(dnames)}, {m} AS `_m` FROM ("
            f"SELECT {', '.join(carry)}, {', '.join(dexpr)} FROM `{view}`))) GROUP BY cid"
        ).collect()
    finally:
        spark.catalog.dropTempView(view)
    # Rows with no eligible centre form one null-cid group, dropped here: a
    # WHERE on cid would be pushed below the projections and re-evaluate the
    # distances inside the predicate.
    return [
        {"cid": r["cid"], "n": r["n"], "weight": r["weight"], "sse": r["sse"], "sums": [r[f"_s{i}"] for i in range(d)]}
        for r in rows
        if r["cid"] is not None
    ]


def assemble_long(rows, d: int) -> list[dict]:
    out: dict[int, dict] = {}
    for r in rows:
        o = out.setdefault(int(r["cid"]), {"cid": int(r["cid"]), "sums": [0.0] * d})
        dim, v = int(r["dim"]), float(r["value"])
        if dim == physical.DIM_COUNT:
            o["n"] = int(round(v))
        elif dim == physical.DIM_WEIGHT:
            o["weight"] = v
        elif dim == physical.DIM_SSE:
            o["sse"] = v
        else:
            o["sums"][dim] = v
    return [out[k] for k in sorted(out)]


def kmeans_step(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    features: str = "features",
    weight: str | None = None,
    form: str = "auto",
) -> DataFrame:
    """One Lloyd update: ``cid, n, weight, sse, center`` for non-empty clusters."""
    st = cluster_stats(points, centers, None, features, weight, form)
    return st.select(
        "cid",
        "n",
        "weight",
        "sse",
        F.transform("sums", lambda v: v / F.col("weight")).alias("center"),
    )
