"""Vector views over the driver tables, shared by the Spark queries and the SQL.

Each view has the same ids and features on both sides:

* ``emb``: ``embeddings`` -> ``(vec_id, embedding as array<double>)``, D = 64.
* ``li``: ``lineitem`` -> ``(l_orderkey*8 + l_linenumber, [quantity,
  extendedprice, discount, tax])``. The id is not unique; seeding breaks ties
  by the vector, so picks stay fixed.
* ``cust``: ``customer`` -> ``(c_custkey, [c_acctbal, c_nationkey])``.
* ``part``: ``part`` -> ``(p_partkey, [p_retailprice, p_size])``.
* ``supp``: ``supplier`` -> ``(s_suppkey, [s_acctbal, s_nationkey])``;
  ``suppn`` has the same vectors under the nation's key, which isn't unique.
* ``custodd``: ``cust`` with vectors that are null, short or hold a null, by the
  customer's key. They stay in the Spark view, and operators leave them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.sources.table import table_vectors

SEED = 20222132
ROUND = 6

VIEWS = {
    # name: (table, id expression (Spark SQL and DuckDB alike), feature columns or None, array col)
    "emb": ("embeddings", "vec_id", None, "embedding"),
    "li": (
        "lineitem",
        "l_orderkey * 8 + l_linenumber",
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        None,
    ),
    "cust": ("customer", "c_custkey", ["c_acctbal", "c_nationkey"], None),
    "part": ("part", "p_partkey", ["p_retailprice", "p_size"], None),
    "supp": ("supplier", "s_suppkey", ["s_acctbal", "s_nationkey"], None),
    "suppn": ("supplier", "s_nationkey", ["s_acctbal", "s_nationkey"], None),
}

DIMS = {"emb": 64, "li": 4, "cust": 2, "part": 2, "supp": 2, "suppn": 2, "custodd": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """``(id bigint, features array<double>)`` for one view."""
    if view == "custodd":
        odd = "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN slice(features, 1, 1) WHEN id % 13 = 0 THEN array(features[0], NULL) ELSE features END"
        return vectors(spark, sf_dir, "cust").select("id", F.expr(odd).alias("features"))
    tbl, id_expr, cols, arr = VIEWS[view]
    df = table(spark, sf_dir, tbl).withColumn("_id", F.expr(id_expr))
    return table_vectors(df, "_id", feature_cols=cols, array_col=arr, dim=DIMS[view]).points


def sql_vectors(view: str) -> str:
    """DuckDB ``SELECT id, f`` for the same view (whole vectors alone)."""
    if view == "custodd":
        return f"SELECT * FROM ({sql_vectors('cust')}) WHERE id % 7 <> 0 AND id % 11 <> 0 AND id % 13 <> 0"
    tbl, id_expr, cols, arr = VIEWS[view]
    if arr is not None:
        f = f"CAST({arr} AS DOUBLE[])"
    else:
        f = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in cols) + "]"
    return f"SELECT CAST({id_expr} AS BIGINT) AS id, {f} AS f FROM {tbl}"


def long_vectors(df: DataFrame, key_cols: list[str], vec_col: str, digits: int = ROUND) -> DataFrame:
    """Explode a vector column to ``(keys..., dim, value)`` rounded rows."""
    return df.select(*key_cols, F.posexplode(vec_col).alias("dim", "_v")).select(
        *key_cols, F.col("dim").cast("int").alias("dim"), F.round("_v", digits).alias("value")
    )
