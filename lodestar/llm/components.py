"""Connected components of a link table, as joins (large-star and small-star rounds).

Each round points every node at the smallest node it knows; the link table
never leaves the cluster, is written to the shared folder each round, and the
rounds end when it no longer changes. Hot nodes only ever meet in an
aggregation with map-side combine and in joins that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import save


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    far = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return far.filter("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node (a > b) and its smaller neighbours are linked to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    near = links.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
    return near.select(F.col("x.b").alias("a"), F.col("x.m").alias("b")).filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``links`` (columns a, b) that isn't its component's smallest."""
    links = save(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    was = _state(links)
    while was[0]:
        links = save(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == was:
            break
        was = now
    return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
