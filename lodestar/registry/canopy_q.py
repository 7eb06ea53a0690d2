"""Registered canopy queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typing import NamedTuple

from lodestar.operators.canopy import canopy_rows, covered_points, distinct_points, find_canopies, kmeans_canopy, local_canopies
from lodestar.operators.canopy_join import radius_join
from lodestar.plans.storage import prepared
from lodestar.registry import sqlgen
from lodestar.registry.inputs import DIMS, ROUND, sql_vectors, vectors


class Spec(NamedTuple):
    """Fixed parameters; bucket = id % buckets, in SQL alike, whatever the row count."""

    view: str
    t1: float
    t2: float
    t3: float
    tol: float = 0.001
    max_iter: int = 20
    buckets: int = 4
    cover: str = "drop"


CUST = Spec("cust", 2000.0, 900.0, 2000.0)  # 2 dimensions: the expression form
EMB = Spec("emb", 1.5, 1.38, 1.5, max_iter=4)  # 64 dimensions: the Arrow form
NEAR = CUST._replace(cover="nearest", max_iter=4)
MANY = CUST._replace(t1=6.0, t2=5.0, t3=6.0, max_iter=3)  # nearly as many canopies as points: the join form
ODD = CUST._replace(view="custodd", max_iter=6)
DELTA_ROUND = 3


def _points(spark, sf, q=CUST):
    return vectors(spark, sf, q.view).withColumn("bucket", (F.col("id") % q.buckets).cast("int"))


def _distinct(spark, sf, q=CUST):
    return distinct_points(_points(spark, sf, q), extra=["bucket"])


def canopy_local(spark: SparkSession, sf: str) -> DataFrame:
    return local_canopies(_distinct(spark, sf), CUST.t1, bucket_col="bucket", dim=DIMS[CUST.view]).select("bucket", "id")


def canopy_global(spark: SparkSession, sf: str) -> DataFrame:
    return find_canopies(_distinct(spark, sf), CUST.t1, CUST.t3, bucket_col="bucket", dim=DIMS[CUST.view]).select("canopy", "id")


def _memb(spark, sf, q=CUST):
    """C1 to C3 alone: the rounds aren't needed for memberships."""
    with prepared(_distinct(spark, sf, q), "canopy-points") as pts:
        found = canopy_rows(find_canopies(pts, q.t1, q.t3, bucket_col="bucket", dim=DIMS[q.view]))
    return covered_points(_distinct(spark, sf, q).select("id", "features"), [(c, v) for c, _, v in found], q.t2, q.cover)


def canopy_membership(spark: SparkSession, sf: str) -> DataFrame:
    return _memb(spark, sf).select("id", F.explode("canopies").alias("canopy"))


def canopy_membership_arrow(spark: SparkSession, sf: str) -> DataFrame:
    return _memb(spark, sf, EMB).select("id", F.explode("canopies").alias("canopy"))


def canopy_uncovered(spark: SparkSession, sf: str) -> DataFrame:
    return _memb(spark, sf).where(F.size("canopies") == 0).select("id")


def _run(spark, sf, q=CUST):
    return kmeans_canopy(_points(spark, sf, q), q.t1, q.t2, q.t3, q.tol, q.max_iter, distinct=True, bucket_col="bucket", cover=q.cover, dim=DIMS[q.view])


def _run_many(spark, sf):
    return kmeans_canopy(_points(spark, sf, MANY), MANY.t1, MANY.t2, MANY.t3, MANY.tol, MANY.max_iter, bucket_col="bucket", form="join", dim=DIMS[MANY.view])


def canopy_many(spark: SparkSession, sf: str) -> DataFrame:
    """Canopies and clusters as tables: memberships by cell, assignment by an equi-join on the canopy."""
    return _centers(_run_many(spark, sf))


def canopy_many_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _run_many(spark, sf).assignments.select("id", "cid")


def canopy_many_membership(spark: SparkSession, sf: str) -> DataFrame:
    pts = _distinct(spark, sf, MANY)
    found = find_canopies(pts, MANY.t1, MANY.t3, bucket_col="bucket", dim=DIMS[MANY.view])
    return radius_join(pts.select("id", "features"), found.select("canopy", "center"), MANY.t2, DIMS[MANY.view], found.count()).select("id", "canopy")


def kmeans_canopy_odd(spark: SparkSession, sf: str) -> DataFrame:
    """A table in which some vectors are null, short or hold a null: they take no part."""
    return _centers(_run(spark, sf, ODD))


def _centers(r):
    c = r.centers.select("cid", "active", "size", F.posexplode("center").alias("dim", "_v"))
    return c.select("cid", "active", "size", F.col("dim").cast("int").alias("dim"), F.round("_v", ROUND).alias("value"))


def kmeans_canopy_q(spark: SparkSession, sf: str) -> DataFrame:
    return _centers(_run(spark, sf))


def kmeans_canopy_arrow(spark: SparkSession, sf: str) -> DataFrame:
    return _centers(_run(spark, sf, EMB))


def canopy_assign_arrow(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, EMB).assignments.select("id", "cid")


def kmeans_canopy_cover(spark: SparkSession, sf: str) -> DataFrame:
    return _centers(_run(spark, sf, NEAR))


def canopy_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf).membership.select("points", "covered", F.round("mean_canopies", ROUND).alias("mean_canopies"))


def canopy_trace(spark: SparkSession, sf: str) -> DataFrame:
    t = _run(spark, sf).trace
    return t.select("iter", F.round("delta", DELTA_ROUND).alias("delta"), "clusters")


def canopy_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf).assignments.select("id", "cid")


# --- SQL ---------------------------------------------------------------------
def _greedy_walk(name: str, src: str, part: str | None, radius: float, dim: int) -> str:
    """Recursive greedy pass over ``src(id, f, rn[, part])`` in rn order."""
    dist = "sqrt(" + sqlgen.d2("c", "b.f", dim) + ")"
    test = f"list_min(list_transform(w.cs, lambda c: {dist})) > {radius!r}"
    key = f"{part}, " if part else ""
    join = f"b.{part} = w.{part} AND " if part else ""
    wkey = f"w.{part}, " if part else ""
    return (
        f"{name}({key}rn, ids, cs) AS (SELECT {key}rn, [id], [f] FROM {src} WHERE rn = 1 "
        f"UNION ALL SELECT {wkey}b.rn, "
        f"CASE WHEN {test} THEN list_append(w.ids, b.id) ELSE w.ids END, "
        f"CASE WHEN {test} THEN list_append(w.cs, b.f) ELSE w.cs END "
        f"FROM {name} w JOIN {src} b ON {join}b.rn = w.rn + 1)"
    )


def _sql_base_ctes(q: Spec = CUST) -> list[str]:
    dim = DIMS[q.view]
    return [
        f"cpts AS MATERIALIZED (SELECT min(id) AS id, f FROM ({sql_vectors(q.view)}) GROUP BY f)",
        f"cb AS MATERIALIZED (SELECT id, f, CAST(id % {q.buckets} AS INTEGER) AS bucket, "
        f"row_number() OVER (PARTITION BY id % {q.buckets} ORDER BY id) AS rn FROM cpts)",
        _greedy_walk("walk1", "cb", "bucket", q.t1, dim),
        "loc AS MATERIALIZED (SELECT bucket, unnest(ids) AS id, unnest(cs) AS f FROM walk1 w "
        "WHERE rn = (SELECT max(rn) FROM cb WHERE cb.bucket = w.bucket))",
        "cand AS MATERIALIZED (SELECT id, f, row_number() OVER (ORDER BY bucket, id) AS rn FROM loc)",
        _greedy_walk("walk2", "cand", None, q.t3, dim),
        "gcan AS MATERIALIZED (SELECT CAST(unnest(range(1, len(ids) + 1)) AS INTEGER) AS canopy, "
        "unnest(ids) AS id, unnest(cs) AS c FROM walk2 WHERE rn = (SELECT max(rn) FROM cand))",
        f"inside AS MATERIALIZED (SELECT p.id, p.f, list(g.canopy ORDER BY g.canopy) AS pc FROM cpts p "
        f"JOIN gcan g ON sqrt({sqlgen.d2('p.f', 'g.c', dim)}) < {q.t2!r} GROUP BY p.id, p.f)",
        "memb AS MATERIALIZED (SELECT * FROM inside"
        + (
            ""
            if q.cover == "drop"
            else f" UNION ALL SELECT p.id, p.f, [min({{'d': {sqlgen.d2('p.f', 'g.c', dim)}, 'k': g.canopy}}).k] AS pc "
            "FROM cpts p CROSS JOIN gcan g WHERE p.id NOT IN (SELECT id FROM inside) GROUP BY p.id, p.f"
        )
        + ")",
    ]


def _sql_rounds(q: Spec = CUST) -> list[str]:
    dim = DIMS[q.view]
    sums = ", ".join(f"sum(m.f[{i}])" for i in range(1, dim + 1))
    ctes = ["k0 AS MATERIALIZED (SELECT canopy AS cid, c, [canopy] AS cs, true AS active FROM gcan)"]
    for r in range(1, q.max_iter + 1):
        p = r - 1
        ctes += [
            f"a{r} AS MATERIALIZED (SELECT m.id, min({{'d': {sqlgen.d2('m.f', 'k.c', dim)}, 'k': k.cid}}) AS mm "
            f"FROM memb m JOIN k{p} k ON k.active AND list_has_any(m.pc, k.cs) GROUP BY m.id)",
            f"s{r} AS MATERIALIZED (SELECT a.mm.k AS cid, count(*) AS n, [{sums}] AS s "
            f"FROM a{r} a JOIN memb m ON a.id = m.id GROUP BY a.mm.k)",
            f"n{r} AS MATERIALIZED (SELECT cid, n, {sqlgen.vec_avg('s', 'n', dim)} AS c FROM s{r})",
            f"cs{r} AS MATERIALIZED (SELECT n.cid, list(g.canopy ORDER BY g.canopy) AS cs FROM n{r} n "
            f"JOIN gcan g ON sqrt({sqlgen.d2('n.c', 'g.c', dim)}) < {q.t2!r} GROUP BY n.cid)",
            f"k{r} AS MATERIALIZED (SELECT o.cid, coalesce(n.c, o.c) AS c, "
            f"CASE WHEN x.cid IS NULL THEN [] ELSE x.cs END AS cs, x.cid IS NOT NULL AS active "
            f"FROM k{p} o LEFT JOIN n{r} n ON o.cid = n.cid LEFT JOIN cs{r} x ON o.cid = x.cid)",
            f"d{r} AS MATERIALIZED (SELECT {r} AS it, (SELECT sum({sqlgen.d2('n.c', 'o.c', dim)}) FROM n{r} n "
            f"JOIN k{p} o ON n.cid = o.cid) AS delta, (SELECT count(*) FROM n{r}) AS clusters)",
        ]
    alld = " UNION ALL ".join(f"SELECT * FROM d{r}" for r in range(1, q.max_iter + 1))
    ctes += [
        f"alld AS MATERIALIZED ({alld})",
        f"stop AS MATERIALIZED (SELECT coalesce(min(it) FILTER (WHERE delta <= {q.tol!r}), {q.max_iter}) AS r FROM alld)",
    ]
    for name in ("k", "s", "a"):
        cols = {"k": "cid, c, active", "s": "cid, n", "a": "id, mm"}[name]
        u = " UNION ALL ".join(f"SELECT {r} AS r, {cols} FROM {name}{r}" for r in range(1, q.max_iter + 1))
        ctes.append(f"final_{name} AS MATERIALIZED (SELECT {cols} FROM ({u}) WHERE r = (SELECT r FROM stop))")
    return ctes


def _with(body: str, rounds: bool = False, q: Spec = CUST) -> str:
    ctes = _sql_base_ctes(q) + (_sql_rounds(q) if rounds else [])
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def _sql_centers(q: Spec) -> str:
    return _with(
        "SELECT k.cid, k.active, coalesce(s.n, 0) AS size, CAST(i - 1 AS INTEGER) AS dim, "
        f"round(k.c[i], {ROUND}) AS value FROM final_k k LEFT JOIN final_s s ON k.cid = s.cid, "
        f"range(1, {DIMS[q.view] + 1}) t(i)",
        rounds=True,
        q=q,
    )


MEMBERS = "SELECT id, unnest(pc) AS canopy FROM memb"
ASSIGNED = "SELECT id, mm.k AS cid FROM final_a"

QUERIES = {
    "canopy_local": (canopy_local, _with("SELECT bucket, id FROM loc")),
    "canopy_global": (canopy_global, _with("SELECT canopy, id FROM gcan")),
    "canopy_membership": (canopy_membership, _with(MEMBERS)),
    "canopy_membership_arrow": (canopy_membership_arrow, _with(MEMBERS, q=EMB)),
    "canopy_uncovered": (canopy_uncovered, _with("SELECT id FROM cpts WHERE id NOT IN (SELECT id FROM memb)")),
    "kmeans_canopy": (kmeans_canopy_q, _sql_centers(CUST)),
    "kmeans_canopy_arrow": (kmeans_canopy_arrow, _sql_centers(EMB)),
    "kmeans_canopy_cover": (kmeans_canopy_cover, _sql_centers(NEAR)),
    "kmeans_canopy_odd": (kmeans_canopy_odd, _sql_centers(ODD)),
    "canopy_many": (canopy_many, _sql_centers(MANY)),
    "canopy_many_assign": (canopy_many_assign, _with(ASSIGNED, rounds=True, q=MANY)),
    "canopy_many_membership": (canopy_many_membership, _with(MEMBERS, q=MANY)),
    "canopy_overlap": (
        canopy_overlap,
        _with(
            "SELECT (SELECT count(*) FROM cpts) AS points, count(*) AS covered, "
            f"round(avg(len(pc)), {ROUND}) AS mean_canopies FROM memb"
        ),
    ),
    "canopy_trace": (
        canopy_trace,
        _with(
            f"SELECT CAST(it AS INTEGER) AS iter, round(delta, {DELTA_ROUND}) AS delta, "
            "CAST(clusters AS INTEGER) AS clusters FROM alld WHERE it <= (SELECT r FROM stop)",
            rounds=True,
        ),
    ),
    "canopy_assign": (canopy_assign, _with(ASSIGNED, rounds=True)),
    "canopy_assign_arrow": (canopy_assign_arrow, _with(ASSIGNED, rounds=True, q=EMB)),
}
