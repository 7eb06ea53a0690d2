"""Seeded, partition-independent sampling without replacement.

Rows are ranked by ``md5("<id>:<seed>")`` (id breaks the practically
impossible hash tie) and the first ``n`` are kept. The ranking depends only
on the id, so the sample is the same however the input is partitioned, and
the same ordering is one ``ORDER BY md5(...)`` in SQL. ``orderBy().limit()``
plans as ``TakeOrderedAndProject``: every task keeps its own top ``n`` and
only ``n x tasks`` rows reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEED = 20222132


def sample_key(id_col: str = "id", seed: int = DEFAULT_SEED):
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{int(seed)}")))


def seeded_sample(
    points: DataFrame, n: int, seed: int = DEFAULT_SEED, id_col: str = "id"
) -> DataFrame:
    """``n`` rows in md5 order plus ``seq`` (0-based position in the sample)."""
    if n < 0:
        raise ValueError("n must be >= 0")
    top = (
        points.withColumn("_key", sample_key(id_col, seed))
        .orderBy("_key", id_col)
        .limit(int(n))
    )
    w = Window.orderBy("_key", id_col)
    return top.withColumn("seq", (F.row_number().over(w) - 1).cast("int")).drop("_key")


def first_rows(points: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The ``n`` lowest ids (file order for text input) plus ``seq``."""
    top = points.orderBy(id_col).limit(int(n))
    w = Window.orderBy(id_col)
    return top.withColumn("seq", (F.row_number().over(w) - 1).cast("int"))


def seed_vectors(
    points: DataFrame,
    k: int,
    seed: int = DEFAULT_SEED,
    distinct: bool = False,
    how: str = "sample",
    id_col: str = "id",
    features: str = "features",
) -> list[list[float]]:
    """K starting centres as a driver list (K x D numbers).

    ``distinct=True`` skips rows whose vector equals an earlier pick, so no
    two seeds coincide: each distinct vector is ranked by its first row, with
    the copies collapsed map-side. One plan per mode at every ``k``.
    """
    # The vector itself breaks ties, so non-unique ids still give fixed seeds.
    order = [F.col(id_col), F.col(features)]
    if how == "sample":
        order = [sample_key(id_col, seed)] + order
    if how not in ("sample", "first"):
        raise ValueError(f"unknown seeding {how!r}")
    if distinct:
        keyed = points.select(F.struct(*order).alias("_o"), F.col(features).alias("_f"))
        rows = keyed.groupBy("_f").agg(F.min("_o").alias("_o")).orderBy("_o").limit(k).select("_f").collect()
    else:
        rows = points.orderBy(*order).limit(k).select(features).collect()
    if len(rows) < k:
        raise ValueError(f"k={k} exceeds the number of available{' distinct' if distinct else ''} points")
    return [list(r[0]) for r in rows]
