"""Registered queries for scans, sampling, assignment and Lloyd (S1, S2, T2,
P1, P6, J1, A1, A2, A8, A13, K1, K7), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.assign import cluster_stats, kmeans_step, predict
from lodestar.operators.lloyd import kmeans
from lodestar.registry import sqlgen
from lodestar.registry.inputs import DIMS, ROUND, SEED, long_vectors, sql_vectors, table, vectors
from lodestar.plans.storage import shared_path
from lodestar.sources.sample import seed_vectors, seeded_sample
from lodestar.sources.table import table_vectors
from lodestar.sources.text import parse_tagged, read_text_vectors

# Fixed parameters of the registered queries.
NEAREST_K = 8  # first 8 embeddings by vec_id are the fixed centres
STEP_K = 5  # lineitem one-step update from 5 seeded centres
LLOYD = dict(k=8, tol=1e-6, max_iter=20)  # embeddings
LLOYD_LI = dict(k=8, tol=0.01, max_iter=10)  # lineitem
BOUNDS_LI = dict(k=32, tol=0.01, max_iter=10)  # lineitem, bounds kept between rounds
SAMPLE_N = 20


# --- S2 --------------------------------------------------------------------
def vector_scan(spark: SparkSession, sf: str) -> DataFrame:
    pts = vectors(spark, sf, "emb")
    return pts.select(F.col("id").alias("vec_id"), F.posexplode("features").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("int").alias("dim"), "value"
    )


SQL_VECTOR_SCAN = (
    f"SELECT id AS vec_id, CAST(i - 1 AS INTEGER) AS dim, f[i] AS value "
    f"FROM ({sql_vectors('emb')}), range(1, len(f) + 1) t(i)"
)


# --- S1 --------------------------------------------------------------------
def _order_lines(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("string")
    cust = F.col("o_custkey").cast("string")
    month = F.month("o_orderdate").cast("string")
    line = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat_ws(",", price, F.lit("x"), month))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat_ws(",", price, cust))
        .otherwise(F.concat_ws(",", price, cust, month))
    )
    return o.select(F.col("o_orderkey").alias("id"), line.alias("value"))


def text_vector_scan(spark: SparkSession, sf: str) -> DataFrame:
    # One pass: accepted and rejected lines come out of the same parse.
    tagged = parse_tagged(_order_lines(spark, sf), "value", "id", ",", dim=3)
    ok = F.col("reason").isNull()
    return tagged.select(
        F.col("id").alias("o_orderkey"),
        F.coalesce(F.col("reason"), F.lit("ok")).alias("reason"),
        *[F.when(ok, F.col("features")[i]).alias(f"f{i}") for i in range(3)],
    )


SQL_TEXT_VECTOR_SCAN = """
WITH src AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderpriority = '1-URGENT'
           THEN concat_ws(',', CAST(o_totalprice AS VARCHAR), 'x', CAST(month(o_orderdate) AS VARCHAR))
         WHEN o_orderpriority = '2-HIGH'
           THEN concat_ws(',', CAST(o_totalprice AS VARCHAR), CAST(o_custkey AS VARCHAR))
         ELSE concat_ws(',', CAST(o_totalprice AS VARCHAR), CAST(o_custkey AS VARCHAR),
                        CAST(month(o_orderdate) AS VARCHAR)) END AS line
  FROM orders),
p AS (SELECT id, list_transform(string_split(line, ','), lambda v: TRY_CAST(v AS DOUBLE)) AS f FROM src),
t AS (SELECT id, f, CASE WHEN list_count(f) < len(f) THEN 'non_numeric'
                         WHEN len(f) <> 3 THEN 'width' ELSE 'ok' END AS reason FROM p)
SELECT id AS o_orderkey, reason,
  CASE WHEN reason = 'ok' THEN f[1] END AS f0,
  CASE WHEN reason = 'ok' THEN f[2] END AS f1,
  CASE WHEN reason = 'ok' THEN f[3] END AS f2
FROM t
"""


def text_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines as files: written to the shared folder and read back by the text source."""
    path = shared_path(spark, "lines")
    _order_lines(spark, sf).select("value").write.text(path)
    got = read_text_vectors(spark, path, dim=3)
    f = [F.col("features")[i].alias(f"f{i}") for i in range(3)]
    none = [F.lit(None).cast("double").alias(f"f{i}") for i in range(3)]
    return got.points.select(F.lit("ok").alias("reason"), *f).unionByName(got.rejects.select("reason", *none))


SQL_TEXT_FILE_SCAN = f"SELECT reason, f0, f1, f2 FROM ({SQL_TEXT_VECTOR_SCAN})"


RAGGED_DIM = 64


def ragged_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of two widths, the first row's the wrong one: ``dim`` says which counts."""
    e = table(spark, sf, "embeddings")
    cut = e.select("vec_id", F.expr(f"slice(embedding, 1, {RAGGED_DIM} - CAST(vec_id % 7 = 0 AS INT) * 3)").alias("v"))
    got = table_vectors(cut, "vec_id", array_col="v", dim=RAGGED_DIM)
    kept = got.points.select(F.col("id").alias("vec_id"), F.lit(True).alias("kept"), F.size("features").cast("long").alias("width"))
    width = F.size(F.from_json("line", "array<double>")).cast("long").alias("width")
    return kept.unionByName(got.rejects.select(F.col("id").alias("vec_id"), F.lit(False).alias("kept"), width))


SQL_RAGGED = (
    "SELECT vec_id, w = 64 AS kept, w AS width FROM (SELECT vec_id, "
    "CAST(len(embedding) - CASE WHEN vec_id % 7 = 0 THEN 3 ELSE 0 END AS BIGINT) AS w FROM embeddings)"
)


# --- T2 --------------------------------------------------------------------
def seeded_sample_q(spark: SparkSession, sf: str) -> DataFrame:
    s = seeded_sample(vectors(spark, sf, "emb"), SAMPLE_N, SEED)
    return s.select("seq", F.col("id").alias("vec_id"))


SQL_SEEDED_SAMPLE = (
    f"SELECT CAST(row_number() OVER (ORDER BY {sqlgen.md5_key()}, id) - 1 AS INTEGER) AS seq, id AS vec_id "
    f"FROM ({sql_vectors('emb')}) ORDER BY {sqlgen.md5_key()}, id LIMIT {SAMPLE_N}"
)


# --- P1 / P6 / J1 ----------------------------------------------------------
def _first_centers(spark, sf, view, k):
    return seed_vectors(vectors(spark, sf, view), k, how="first")


def nearest_center(spark: SparkSession, sf: str) -> DataFrame:
    pts = vectors(spark, sf, "emb")
    cs = _first_centers(spark, sf, "emb", NEAREST_K)
    return predict(pts, cs).select(
        F.col("id").alias("vec_id"), "cid", F.round("d2", ROUND).alias("d2")
    )


LARGE_K = 150  # centres, inlined 40 at a time


def large_k_assign(spark: SparkSession, sf: str) -> DataFrame:
    pts = vectors(spark, sf, "emb")
    cs = _first_centers(spark, sf, "emb", LARGE_K)
    return predict(pts, cs, inline_limit=40 * DIMS["emb"]).select(F.col("id").alias("vec_id"), "cid", F.round("d2", ROUND).alias("d2"))


def _sql_nearest(view: str, centers_sql: str, dim: int) -> str:
    return (
        f"SELECT p.id, min({{'d': {sqlgen.d2('p.f', 'c.c', dim)}, 'k': c.cid}}) AS m "
        f"FROM ({sql_vectors(view)}) p CROSS JOIN ({centers_sql}) c GROUP BY p.id, p.f"
    )


SQL_NEAREST_CENTER = (
    f"SELECT id AS vec_id, m.k AS cid, round(m.d, {ROUND}) AS d2 FROM "
    f"({_sql_nearest('emb', sqlgen.seeds('emb', NEAREST_K, 'first'), DIMS['emb'])})"
)


SQL_LARGE_K = (
    f"SELECT id AS vec_id, m.k AS cid, round(m.d, {ROUND}) AS d2 FROM "
    f"({_sql_nearest('emb', sqlgen.seeds('emb', LARGE_K, 'first'), DIMS['emb'])})"
)


# --- A1 / A2 / A13 ---------------------------------------------------------
def cluster_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    pts = vectors(spark, sf, "emb")
    cs = _first_centers(spark, sf, "emb", NEAREST_K)
    st = cluster_stats(pts, cs)
    return long_vectors(
        st.select("cid", "n", F.round("sse", ROUND).alias("sse"), "sums"), ["cid", "n", "sse"], "sums"
    )


def _sql_cluster_stats() -> str:
    dim = DIMS["emb"]
    sums = ", ".join(f"sum(p.f[{i}])" for i in range(1, dim + 1))
    body = (
        f"SELECT a.m.k AS cid, count(*) AS n, round(sum(a.m.d), {ROUND}) AS sse, [{sums}] AS s "
        f"FROM ({_sql_nearest('emb', sqlgen.seeds('emb', NEAREST_K, 'first'), dim)}) a "
        f"JOIN ({sql_vectors('emb')}) p ON a.id = p.id GROUP BY a.m.k"
    )
    return sqlgen.long_out(f"({body})", "cid, n, sse", "s", dim)


def kmeans_step_q(spark: SparkSession, sf: str) -> DataFrame:
    pts = vectors(spark, sf, "li")
    cs = seed_vectors(pts, STEP_K, SEED)
    st = kmeans_step(pts, cs)
    return long_vectors(st.select("cid", "n", "center"), ["cid", "n"], "center")


def _sql_kmeans_step() -> str:
    dim = DIMS["li"]
    sums = ", ".join(f"sum(a.f[{i}])" for i in range(1, dim + 1))
    body = (
        f"SELECT a.m.k AS cid, count(*) AS n, {sqlgen.vec_avg(f'[{sums}]', 'count(*)', dim)} AS c "
        f"FROM (SELECT p.rid, p.f, min({{'d': {sqlgen.d2('p.f', 'c.c', dim)}, 'k': c.cid}}) AS m "
        f"FROM (SELECT row_number() OVER () AS rid, * FROM ({sql_vectors('li')})) p "
        f"CROSS JOIN ({sqlgen.seeds('li', STEP_K)}) c GROUP BY p.rid, p.f) a GROUP BY a.m.k"
    )
    return sqlgen.long_out(f"({body})", "cid, n", "c", dim)


# --- K1 / A8 / K7 ----------------------------------------------------------
def _lloyd(spark, sf, view, params):
    pts = vectors(spark, sf, view)
    return kmeans(
        pts, params["k"], init="sample", tol=params["tol"], max_iter=params["max_iter"], seed=SEED, dim=DIMS[view]
    )


def kmeans_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    return long_vectors(_lloyd(spark, sf, "emb", LLOYD).centers, ["cid"], "center")


def kmeans_trace(spark: SparkSession, sf: str) -> DataFrame:
    t = _lloyd(spark, sf, "emb", LLOYD).trace
    return t.select(
        "iter", F.round("delta", ROUND).alias("delta"), F.round("sse", ROUND).alias("sse"), "clusters"
    )


def kmeans_predict(spark: SparkSession, sf: str) -> DataFrame:
    a = _lloyd(spark, sf, "emb", LLOYD).assignments
    return a.select(F.col("id").alias("vec_id"), "cid", F.round("d2", ROUND).alias("d2"))


def kmeans_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return long_vectors(_lloyd(spark, sf, "li", LLOYD_LI).centers, ["cid"], "center")


def kmeans_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """K = 32 with bounds kept between rounds: most points compute one distance a round."""
    r = kmeans(vectors(spark, sf, "li"), BOUNDS_LI["k"], tol=BOUNDS_LI["tol"], max_iter=BOUNDS_LI["max_iter"], seed=SEED, form="bounds", dim=DIMS["li"])
    return long_vectors(r.centers, ["cid"], "center")


def _sql_lloyd(view: str, params: dict, what: str) -> str:
    dim = DIMS[view]
    ctes, final = sqlgen.lloyd_ctes(
        sql_vectors(view), sqlgen.seeds(view, params["k"]), dim, params["tol"], params["max_iter"]
    )
    if what == "centers":
        return sqlgen.with_(ctes, sqlgen.long_out(final, "cid", "c", dim))
    if what == "trace":
        return sqlgen.with_(
            ctes,
            f"SELECT CAST(it AS INTEGER) AS iter, round(delta, {ROUND}) AS delta, "
            f"round(sse, {ROUND}) AS sse, CAST(clusters AS INTEGER) AS clusters FROM rounds",
        )
    return sqlgen.with_(
        ctes,
        f"SELECT id AS vec_id, m.k AS cid, round(m.d, {ROUND}) AS d2 FROM "
        f"(SELECT p.id, min({{'d': {sqlgen.d2('p.f', 'c.c', dim)}, 'k': c.cid}}) AS m "
        f"FROM pts p CROSS JOIN {final} c GROUP BY p.rid, p.id)",
    )


QUERIES = {
    "kmeans_bounds": (kmeans_bounds, _sql_lloyd("li", BOUNDS_LI, "centers")),
    "vector_scan": (vector_scan, SQL_VECTOR_SCAN),
    "text_vector_scan": (text_vector_scan, SQL_TEXT_VECTOR_SCAN),
    "text_file_scan": (text_file_scan, SQL_TEXT_FILE_SCAN),
    "ragged_table_scan": (ragged_table_scan, SQL_RAGGED),
    "large_k_assign": (large_k_assign, SQL_LARGE_K),
    "seeded_sample": (seeded_sample_q, SQL_SEEDED_SAMPLE),
    "nearest_center": (nearest_center, SQL_NEAREST_CENTER),
    "cluster_stats": (cluster_stats_q, _sql_cluster_stats()),
    "kmeans_step": (kmeans_step_q, _sql_kmeans_step()),
    "kmeans_lloyd": (kmeans_lloyd, _sql_lloyd("emb", LLOYD, "centers")),
    "kmeans_trace": (kmeans_trace, _sql_lloyd("emb", LLOYD, "trace")),
    "kmeans_predict": (kmeans_predict, _sql_lloyd("emb", LLOYD, "predict")),
    "kmeans_lineitem": (kmeans_lineitem, _sql_lloyd("li", LLOYD_LI, "centers")),
}
