"""Registered density queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.operators.density import (
    DEFAULT_COEF,
    density_seed,
    density_stats,
    kmeans_density,
    pair_distance_sum,
)
from lodestar.registry import sqlgen
from lodestar.registry.inputs import DIMS, ROUND, SEED, long_vectors, sql_vectors, table, vectors
from lodestar.sources.table import table_vectors
from lodestar.sources.sample import seeded_sample
from lodestar.plans.storage import local_frame

# Fixed parameters.
RADIUS_VIEW = "emb"  # adaptive radius over all embeddings
SEED_VIEW, SEED_T2, SAMPLE_N = "emb", 1.5, 70  # density stats / seeding on a 70-row sample
ODD_VIEW = "custodd"
KD_VIEW, KD_TOL, KD_MAX_ITER = "cust", 0.01, 10  # density-seeded k-means on customer


def adaptive_radius_q(spark: SparkSession, sf: str) -> DataFrame:
    s = pair_distance_sum(vectors(spark, sf, RADIUS_VIEW), dim=DIMS[RADIUS_VIEW])
    return local_frame(spark, [(round(math.sqrt(s) * DEFAULT_COEF, ROUND),)], "t2 double")


def _sql_radius(view: str) -> str:
    dim = DIMS[view]
    return (
        f"SELECT sqrt(sum(sqrt({sqlgen.d2('a.f', 'b.f', dim)}))) * {DEFAULT_COEF!r} AS t2 "
        f"FROM ({sql_vectors(view)}) a CROSS JOIN ({sql_vectors(view)}) b"
    )


def adaptive_radius_line(spark: SparkSession, sf: str) -> DataFrame:
    """One dimension, all orders: by sorted ranges, not by pairs."""
    pts = table_vectors(table(spark, sf, "orders"), "o_orderkey", feature_cols=["o_totalprice"]).points
    s = pair_distance_sum(pts, block_rows=500, dim=1)
    return local_frame(spark, [(round(math.sqrt(s) * DEFAULT_COEF, ROUND),)], "t2 double")


SQL_RADIUS_LINE = (
    f"SELECT round(sqrt(2 * sum(CAST(2 * rn - n - 1 AS DOUBLE) * x)) * {DEFAULT_COEF!r}, {ROUND}) AS t2 FROM "
    "(SELECT CAST(o_totalprice AS DOUBLE) AS x, row_number() OVER (ORDER BY o_totalprice) AS rn, count(*) OVER () AS n FROM orders)"
)


def adaptive_radius_odd(spark: SparkSession, sf: str) -> DataFrame:
    """A table in which some vectors are null, short or hold a null: they take no part."""
    s = pair_distance_sum(vectors(spark, sf, ODD_VIEW), dim=DIMS[ODD_VIEW])
    return local_frame(spark, [(round(math.sqrt(s) * DEFAULT_COEF, ROUND),)], "t2 double")


SQL_RADIUS = f"SELECT round(t2, {ROUND}) AS t2 FROM ({_sql_radius(RADIUS_VIEW)})"


def _sample(spark, sf):
    return seeded_sample(vectors(spark, sf, SEED_VIEW), SAMPLE_N, SEED)


def density_rank(spark: SparkSession, sf: str) -> DataFrame:
    # The sample is bounded (SAMPLE_N rows), so one ordered window over it is cheap.
    st = density_stats(_sample(spark, sf), SEED_T2, dim=DIMS[SEED_VIEW])
    rank = F.row_number().over(Window.orderBy(F.desc("density"), "seq"))
    return st.select(
        "seq",
        F.col("id").alias("vec_id"),
        "density",
        F.round("rowsum", ROUND).alias("rowsum"),
        (rank == 1).alias("is_max"),
    )


def _sql_sample(view: str, n: int) -> str:
    key = sqlgen.md5_key()
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {key}, id) - 1 AS INTEGER) AS seq, id, f "
        f"FROM ({sql_vectors(view)}) ORDER BY {key}, id LIMIT {n}"
    )


def _sql_stats_ctes(view: str, t2: str) -> list[str]:
    dim = DIMS[view]
    return [
        f"smp AS MATERIALIZED ({_sql_sample(view, SAMPLE_N)})",
        f"st AS MATERIALIZED (SELECT a.seq, a.id, a.f, count(*) FILTER (WHERE {sqlgen.d2('a.f', 'b.f', dim)} <= {t2}) AS dens, "
        f"sum({sqlgen.d2('a.f', 'b.f', dim)}) AS rowsum, "
        f"sum(CASE WHEN {sqlgen.d2('a.f', 'b.f', dim)} <= {t2} THEN {sqlgen.d2('a.f', 'b.f', dim)} ELSE 0 END) AS rowsum_in FROM smp a CROSS JOIN smp b GROUP BY a.seq, a.id, a.f)",
    ]


SQL_DENSITY_RANK = (
    "WITH "
    + ",\n".join(_sql_stats_ctes(SEED_VIEW, repr(SEED_T2)))
    + f"\nSELECT seq, id AS vec_id, dens AS density, round(rowsum, {ROUND}) AS rowsum, "
    "seq = (SELECT seq FROM st ORDER BY dens DESC, seq LIMIT 1) AS is_max FROM st"
)


def density_seed_q(spark: SparkSession, sf: str) -> DataFrame:
    seeds = density_seed(_sample(spark, sf), SEED_T2, dim=DIMS[SEED_VIEW])
    return local_frame(spark, seeds.rows, "cid int, seq int, vec_id bigint, density bigint")


def _sql_seed_ctes(view: str, t2: str, weight: str = "reference") -> list[str]:
    """Greedy max-density seeding (max 3 centres) as two unrolled steps over ``st``."""
    dim = DIMS[view]

    def dist(a, b):
        return f"sqrt({sqlgen.d2(a, b, dim)})"

    def weigh(row, near, d):
        if weight == "reference":
            return f"g1.dmax * (1.0 / ({near}.rowsum / {near}.dens)) * {d}"
        return f"CASE WHEN {row}.rowsum_in = 0 THEN 0 ELSE {row}.dens * (1.0 / ({row}.rowsum_in / {row}.dens)) * {d} END"

    return [
        "g1 AS MATERIALIZED (SELECT seq AS mi, f AS v1, dens AS dmax FROM st ORDER BY dens DESC, seq LIMIT 1)",
        "snap AS MATERIALIZED (SELECT st.* FROM st, g1 WHERE st.f <> g1.v1)",
        # step 1: first scanned row farther than t2 from centre 1
        f"i1 AS MATERIALIZED (SELECT min(seq) AS i FROM snap, g1 WHERE {dist('snap.f', 'g1.v1')} > {t2})",
        "alive1 AS MATERIALIZED (SELECT * FROM snap WHERE f NOT IN "
        "(SELECT f FROM snap, i1 WHERE snap.seq < i1.i))",
        f"w1 AS MATERIALIZED (SELECT a.seq, a.f, {weigh('a', 's0', dist('a.f', 'g1.v1'))} AS w "
        "FROM alive1 a, g1, (SELECT * FROM st WHERE seq = 0) s0, i1 WHERE i1.i IS NOT NULL)",
        "g2 AS MATERIALIZED (SELECT seq AS s2, f AS v2 FROM w1 ORDER BY w DESC, seq LIMIT 1)",
        "alive2 AS MATERIALIZED (SELECT a.* FROM alive1 a, g2 WHERE a.f <> g2.v2)",
        # step 2: continue the scan after i1 with two centres
        f"i2 AS MATERIALIZED (SELECT min(seq) AS i FROM snap, i1, g1, g2 WHERE snap.seq > i1.i AND "
        f"least({dist('snap.f', 'g1.v1')}, {dist('snap.f', 'g2.v2')}) > {t2})",
        "alive2b AS MATERIALIZED (SELECT * FROM alive2 WHERE f NOT IN "
        "(SELECT f FROM snap, i1, i2 WHERE snap.seq > i1.i AND snap.seq < i2.i))",
        f"w2 AS MATERIALIZED (SELECT a.seq, a.f, a.dens, a.rowsum_in, {dist('a.f', 'g1.v1')} AS e1, {dist('a.f', 'g2.v2')} AS e2 "
        "FROM alive2b a, g1, g2, i2 WHERE i2.i IS NOT NULL)",
        f"w2b AS MATERIALIZED (SELECT w2.seq, w2.f, {weigh('w2', 'sm', 'least(e1, e2)')} AS w "
        "FROM w2, g1, st sm WHERE sm.seq = CASE WHEN e1 <= e2 THEN 0 ELSE 1 END)",
        "g3 AS MATERIALIZED (SELECT seq AS s3, f AS v3 FROM w2b ORDER BY w DESC, seq LIMIT 1)",
        "seeds AS MATERIALIZED (SELECT 0 AS cid, mi AS seq FROM g1 UNION ALL SELECT 1, s2 FROM g2 "
        "UNION ALL SELECT 2, s3 FROM g3)",
    ]


SQL_DENSITY_SEED = (
    "WITH "
    + ",\n".join(_sql_stats_ctes(SEED_VIEW, repr(SEED_T2)) + _sql_seed_ctes(SEED_VIEW, repr(SEED_T2)))
    + "\nSELECT CAST(s.cid AS INTEGER) AS cid, s.seq, st.id AS vec_id, st.dens AS density "
    "FROM seeds s JOIN st ON s.seq = st.seq"
)


def kmeans_density_q(spark: SparkSession, sf: str) -> DataFrame:
    res = kmeans_density(
        vectors(spark, sf, KD_VIEW), tol=KD_TOL, max_iter=KD_MAX_ITER, sample_n=SAMPLE_N, seed=SEED, dim=DIMS[KD_VIEW]
    )
    return long_vectors(res.centers, ["cid"], "center")


def density_seed_weighted(spark: SparkSession, sf: str) -> DataFrame:
    seeds = density_seed(_sample(spark, sf), SEED_T2, weight="density", dim=DIMS[SEED_VIEW])
    return local_frame(spark, seeds.rows, "cid int, seq int, vec_id bigint, density bigint")


SQL_DENSITY_SEED_WEIGHTED = (
    "WITH "
    + ",\n".join(_sql_stats_ctes(SEED_VIEW, repr(SEED_T2)) + _sql_seed_ctes(SEED_VIEW, repr(SEED_T2), "density"))
    + "\nSELECT CAST(s.cid AS INTEGER) AS cid, s.seq, st.id AS vec_id, st.dens AS density "
    "FROM seeds s JOIN st ON s.seq = st.seq"
)


def _sql_kmeans_density() -> str:
    dim = DIMS[KD_VIEW]
    t2 = "(SELECT t2 FROM rad)"
    pre = [f"rad AS MATERIALIZED ({_sql_radius(KD_VIEW)})"]
    pre += _sql_stats_ctes(KD_VIEW, t2) + _sql_seed_ctes(KD_VIEW, t2)
    c0 = "SELECT CAST(s.cid AS INTEGER) AS cid, st.f AS c FROM seeds s JOIN st ON s.seq = st.seq"
    ctes, final = sqlgen.lloyd_ctes(sql_vectors(KD_VIEW), c0, dim, KD_TOL, KD_MAX_ITER)
    return sqlgen.with_(pre + ctes, sqlgen.long_out(final, "cid", "c", dim))


QUERIES = {
    "adaptive_radius": (adaptive_radius_q, SQL_RADIUS),
    "adaptive_radius_line": (adaptive_radius_line, SQL_RADIUS_LINE),
    "adaptive_radius_odd": (adaptive_radius_odd, f"SELECT round(t2, {ROUND}) AS t2 FROM ({_sql_radius(ODD_VIEW)})"),
    "density_rank": (density_rank, SQL_DENSITY_RANK),
    "density_seed": (density_seed_q, SQL_DENSITY_SEED),
    "density_seed_weighted": (density_seed_weighted, SQL_DENSITY_SEED_WEIGHTED),
    "kmeans_density": (kmeans_density_q, _sql_kmeans_density()),
}
