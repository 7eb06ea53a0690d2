"""Registered two-level queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.pairs import closest_pairs
from lodestar.operators.two_level import (
    inner_kmeans,
    kmeans_two_level,
    partial_centroids,
    seeds_from_pairs,
)
from lodestar.registry import sqlgen
from lodestar.registry.inputs import DIMS, ROUND, SEED, long_vectors, sql_vectors, table, vectors
from lodestar.sources.sample import seed_vectors
from lodestar.plans.storage import local_frame, prepared

# Fixed parameters.
PAIR_VIEW, PAIR_K = "supp", 5  # closest supplier pairs
SLICE_K = 20  # closest customers
VIEW, K, BUCKETS = "emb", 8, 2  # embeddings, 8 centres, buckets = vec_id % 2
INNER = 10
TWO = dict(tol=1e-4, max_iter=3)


def pair_distance_topk(spark: SparkSession, sf: str) -> DataFrame:
    top = closest_pairs(vectors(spark, sf, PAIR_VIEW), PAIR_K, dim=DIMS[PAIR_VIEW])
    return top.select(
        "rank",
        "i",
        "j",
        F.round("d2", ROUND).alias("d2"),
        *[F.round(F.col("mid")[q], ROUND).alias(f"m{q}") for q in range(DIMS[PAIR_VIEW])],
    )


def pair_equal_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that aren't unique, in several tiles."""
    top = closest_pairs(vectors(spark, sf, "suppn"), PAIR_K, block_rows=30, dim=DIMS["suppn"])
    return top.select("rank", "i", "j", F.round("d2", ROUND).alias("d2"), *[F.round(F.col("mid")[q], ROUND).alias(f"m{q}") for q in range(2)])


def _pair_rows(top: DataFrame) -> DataFrame:
    return top.select("rank", "i", "j", F.round("d2", ROUND).alias("d2"), *[F.round(F.col("mid")[q], ROUND).alias(f"m{q}") for q in range(2)])


def pair_distance_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Closest customers by slices of one projection; only slices within the bound meet."""
    return _pair_rows(closest_pairs(vectors(spark, sf, "cust"), SLICE_K, dim=DIMS["cust"], sample_rows=64, block_rows=100))


def pair_distance_odd(spark: SparkSession, sf: str) -> DataFrame:
    """A table in which some vectors are null, short or hold a null: they form no pair."""
    return _pair_rows(closest_pairs(vectors(spark, sf, "custodd"), SLICE_K, dim=DIMS["custodd"]))


def _sql_pairs(src: str, k: int, dim: int, unique: bool = True) -> str:
    mid = "[" + ", ".join(f"(a.f[{i}] + b.f[{i}]) / 2" for i in range(1, dim + 1)) + "]"
    d = sqlgen.d2("a.f", "b.f", dim)
    rows = src if unique else f"(SELECT row_number() OVER (ORDER BY id, f) AS rid, * FROM {src})"
    once = "a.id < b.id" if unique else "a.rid < b.rid"
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY d2, i, j, mid) AS INTEGER) AS rank, i, j, d2, mid FROM "
        f"(SELECT least(a.id, b.id) AS i, greatest(a.id, b.id) AS j, {d} AS d2, {mid} AS mid FROM {rows} a JOIN {rows} b "
        f"ON {once} WHERE {d} > 0 ORDER BY d2, i, j, mid LIMIT {k})"
    )


def _sql_pair_rows(view: str) -> str:
    return (
        f"SELECT rank, i, j, round(d2, {ROUND}) AS d2, round(mid[1], {ROUND}) AS m0, round(mid[2], {ROUND}) AS m1 "
        f"FROM ({_sql_pairs('(' + sql_vectors(view) + ')', SLICE_K, 2)})"
    )


SQL_PAIR_EQUAL_IDS = (
    f"SELECT rank, i, j, round(d2, {ROUND}) AS d2, round(mid[1], {ROUND}) AS m0, round(mid[2], {ROUND}) AS m1 "
    f"FROM ({_sql_pairs('(' + sql_vectors('suppn') + ')', PAIR_K, 2, unique=False)})"
)
SQL_PAIR_TOPK = (
    f"SELECT rank, i, j, round(d2, {ROUND}) AS d2, "
    + ", ".join(f"round(mid[{q + 1}], {ROUND}) AS m{q}" for q in range(DIMS[PAIR_VIEW]))
    + f" FROM ({_sql_pairs(f'({sql_vectors(PAIR_VIEW)})', PAIR_K, DIMS[PAIR_VIEW])})"
)


def _centroids(spark, sf):
    pts = vectors(spark, sf, VIEW).withColumn("bucket", (F.col("id") % BUCKETS).cast("int"))
    return partial_centroids(pts, seed_vectors(pts, K, SEED), "bucket")


def closest_pair_seed(spark: SparkSession, sf: str) -> DataFrame:
    top = closest_pairs(_centroids(spark, sf), K, dim=DIMS[VIEW])
    return long_vectors(top.select("rank", "i", "j", F.round("d2", ROUND).alias("d2"), "mid"), ["rank", "i", "j", "d2"], "mid")


def _reseed(spark, sf, how):
    with prepared(_centroids(spark, sf), "centroids") as cent:
        centers = inner_kmeans(cent, seeds_from_pairs(cent, K, ordered=True, dim=DIMS[VIEW]), INNER, weighted=False, reseed=how)
    return long_vectors(local_frame(spark, list(enumerate(centers)), "cid int, center array<double>"), ["cid"], "center")


def kmeans_reseed(spark: SparkSession, sf: str) -> DataFrame:
    return _reseed(spark, sf, "reseed")


def kmeans_reseed_md5(spark: SparkSession, sf: str) -> DataFrame:
    return _reseed(spark, sf, "reseed-md5")


FEW_INIT = [[0.0], [1.0], [5.0], [6.0]]


def two_level_few_partials(spark: SparkSession, sf: str) -> DataFrame:
    """Two distinct values and four centres: fewer partial centroids than K, K centres all the same."""
    li = table(spark, sf, "lineitem")
    pts = li.select(F.expr("l_orderkey * 8 + l_linenumber").alias("id"), F.array(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("features"))
    res = kmeans_two_level(pts, 4, init=FEW_INIT, buckets=1, max_iter=1, inner_iter=1, dim=len(FEW_INIT[0]))
    return res.centers.select("cid", F.round(F.col("center")[0], ROUND).alias("value"))


# Seeds: the midpoint of the one pair, the two centroids by weight, the last centre as it was. The two centroids
# choose the second and third; the empty first and fourth get the centroids in id order.
SQL_FEW = (
    "WITH v AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS v, count(*) AS n FROM lineitem GROUP BY 1), "
    "o AS (SELECT list(v ORDER BY n DESC, v) AS h FROM v) "
    "SELECT CAST(0 AS INTEGER) AS cid, CAST(0 AS DOUBLE) AS value UNION ALL SELECT 1, CAST(h[1] AS DOUBLE) FROM o "
    "UNION ALL SELECT 2, CAST(h[2] AS DOUBLE) FROM o UNION ALL SELECT 3, CAST(1 AS DOUBLE)"
)


def kmeans_two_level_q(spark: SparkSession, sf: str) -> DataFrame:
    pts = vectors(spark, sf, VIEW).withColumn("bucket", (F.col("id") % BUCKETS).cast("int"))
    res = kmeans_two_level(
        pts, K, init="sample", inner_iter=INNER, bucket_col="bucket", weighted=True, seed=SEED, dim=DIMS[VIEW], **TWO
    )
    return long_vectors(res.centers, ["cid"], "center")


# --- SQL ---------------------------------------------------------------------
def _sql_partials(prefix: str, centers: str) -> str:
    """Partial centroids per (bucket, cid) of the view against ``centers(cid, c)``."""
    dim = DIMS[VIEW]
    avg = "[" + ", ".join(f"sum(a.f[{i}]) / count(*)" for i in range(1, dim + 1)) + "]"
    return (
        f"{prefix}pc AS MATERIALIZED (SELECT CAST(a.bucket * {K} + a.m.k AS BIGINT) AS id, "
        f"a.m.k AS cid, {avg} AS f, CAST(count(*) AS DOUBLE) AS w FROM "
        f"(SELECT p.id, p.f, CAST(p.id % {BUCKETS} AS INTEGER) AS bucket, "
        f"min({{'d': {sqlgen.d2('p.f', 'c.c', dim)}, 'k': c.cid}}) AS m "
        f"FROM ({sql_vectors(VIEW)}) p CROSS JOIN {centers} c GROUP BY p.id, p.f) a GROUP BY a.bucket, a.m.k)"
    )


def _sql_seed_pairs(prefix: str, ordered: bool) -> str:
    """``{prefix}sd(cid, c)``: midpoints of the K closest pairs of partial centroids."""
    dim = DIMS[VIEW]
    d = sqlgen.d2("a.f", "b.f", dim)
    mid = "[" + ", ".join(f"(a.f[{i}] + b.f[{i}]) / 2" for i in range(1, dim + 1)) + "]"
    cond = "a.id <> b.id" if ordered else "a.id < b.id"
    return (
        f"{prefix}sd AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY d2, i, j) - 1 AS INTEGER) AS cid, "
        f"mid AS c FROM (SELECT a.id AS i, b.id AS j, {d} AS d2, {mid} AS mid FROM {prefix}pc a "
        f"JOIN {prefix}pc b ON {cond} WHERE {d} > 0 ORDER BY d2, i, j LIMIT {K}))"
    )


def _sql_closest_pair_seed() -> str:
    dim = DIMS[VIEW]
    ctes = [f"s0 AS MATERIALIZED ({sqlgen.seeds(VIEW, K)})", _sql_partials("", "s0")]
    body = _sql_pairs("pc", K, dim)
    return sqlgen.with_(
        ctes,
        f"SELECT rank, i, j, round(d2, {ROUND}) AS d2, CAST(q - 1 AS INTEGER) AS dim, "
        f"round(mid[q], {ROUND}) AS value FROM ({body}), range(1, {dim + 1}) t(q)",
    )


def _sql_kmeans_reseed(how: str = "reseed") -> str:
    dim = DIMS[VIEW]
    ctes = [f"s0 AS MATERIALIZED ({sqlgen.seeds(VIEW, K)})", _sql_partials("", "s0"), _sql_seed_pairs("", True)]
    inner, final = sqlgen.lloyd_ctes(
        "SELECT id, f FROM pc", "SELECT cid, c FROM sd", dim, None, INNER, on_empty=how, prefix="i_"
    )
    return sqlgen.with_(ctes + inner, sqlgen.long_out(final, "cid", "c", dim))


def _sql_kmeans_two_level() -> str:
    dim = DIMS[VIEW]
    ctes = [f"o0 AS MATERIALIZED ({sqlgen.seeds(VIEW, K)})"]
    outs = []
    for t in range(1, TWO["max_iter"] + 1):
        pre = f"t{t}_"
        ctes.append(_sql_partials(pre, f"o{t - 1}"))
        ctes.append(_sql_seed_pairs(pre, False))
        inner, final = sqlgen.lloyd_ctes(
            f"SELECT id, f, w FROM {pre}pc", f"SELECT cid, c FROM {pre}sd", dim, None, INNER,
            on_empty="reseed", weighted=True, prefix=f"{pre}i_",
        )
        ctes += inner
        ctes.append(f"o{t} AS MATERIALIZED (SELECT cid, c FROM {final})")
        ctes.append(
            f"od{t} AS MATERIALIZED (SELECT {t} AS it, sum({sqlgen.d2('a.c', 'b.c', dim)}) AS delta "
            f"FROM o{t - 1} a JOIN o{t} b ON a.cid = b.cid)"
        )
        outs.append(f"SELECT {t} AS r, cid, c FROM o{t}")
    alld = " UNION ALL ".join(f"SELECT * FROM od{t}" for t in range(1, TWO["max_iter"] + 1))
    ctes.append(
        f"ostop AS MATERIALIZED (SELECT coalesce(min(it) FILTER (WHERE delta <= {TWO['tol']!r}), "
        f"{TWO['max_iter']}) AS r FROM ({alld}))"
    )
    ctes.append(
        f"ofinal AS MATERIALIZED (SELECT cid, c FROM ({' UNION ALL '.join(outs)}) WHERE r = (SELECT r FROM ostop))"
    )
    return sqlgen.with_(ctes, sqlgen.long_out("ofinal", "cid", "c", dim))


QUERIES = {
    "pair_distance_topk": (pair_distance_topk, SQL_PAIR_TOPK),
    "closest_pair_seed": (closest_pair_seed, _sql_closest_pair_seed()),
    "pair_distance_slices": (pair_distance_slices, _sql_pair_rows("cust")),
    "pair_distance_odd": (pair_distance_odd, _sql_pair_rows("custodd")),
    "pair_equal_ids": (pair_equal_ids, SQL_PAIR_EQUAL_IDS),
    "two_level_few_partials": (two_level_few_partials, SQL_FEW),
    "kmeans_reseed_md5": (kmeans_reseed_md5, _sql_kmeans_reseed("reseed-md5")),
    "kmeans_reseed": (kmeans_reseed, _sql_kmeans_reseed()),
    "kmeans_two_level": (kmeans_two_level_q, _sql_kmeans_two_level()),
}
