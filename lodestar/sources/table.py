"""Any table with numeric columns (or a numeric array column) -> vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.sources.text import ParsedVectors, one_width


#: Up to this width null elements are looked for one by one, so that the tests reach the scan.
UNROLLED_WIDTH = 32


def whole_rows(df: DataFrame, features: str = "features", dim: int | None = None) -> tuple[DataFrame, int]:
    """Rows whose vector has width ``dim`` and no null, and that width (0 for no rows).

    Without ``dim`` all widths are counted (one job); more than one is an error.
    """
    if dim is None:
        dim = one_width(df.where(F.col(features).isNotNull()).select(F.size(features).alias("width")))
    ok = F.size(features) == F.lit(dim)
    if dim <= UNROLLED_WIDTH:
        for i in range(dim):
            ok = ok & F.get(F.col(features), F.lit(i)).isNotNull()
    else:
        ok = ok & ~F.exists(features, lambda v: v.isNull())
    return df.where(ok), dim


def table_vectors(
    df: DataFrame,
    id_col: str,
    feature_cols: Sequence[str] | None = None,
    array_col: str | None = None,
    weight_col: str | None = None,
    dim: int | None = None,
) -> ParsedVectors:
    """Project ``(id, features[, weight])`` from a table.

    Exactly one of ``feature_cols`` (numeric columns packed in order) or
    ``array_col`` (a numeric array, cast element-wise to double) is used.
    Rows with a null id, a null vector or a null element go to ``rejects``.
    With ``array_col``, rows of another length than ``dim`` do too; without
    ``dim`` all lengths are counted (one job) and more than one is an error, so
    no single row decides.
    Only the named columns are selected, so Parquet reads just those.
    """
    if (feature_cols is None) == (array_col is None):
        raise ValueError("pass exactly one of feature_cols or array_col")
    if feature_cols is not None:
        feats = F.array(*[F.col(c).cast("double") for c in feature_cols])
        dim = len(feature_cols)
    else:
        feats = F.col(array_col).cast("array<double>")
    cols = [F.col(id_col).cast("bigint").alias("id"), feats.alias("features")]
    if weight_col is not None:
        cols.append(F.col(weight_col).cast("double").alias("weight"))
    proj = df.select(*cols)
    if feature_cols is not None:
        # Null checks on the source columns stay inside generated code.
        bad = F.col("id").isNull()
        for i in range(len(feature_cols)):
            bad = bad | F.col("features")[i].isNull()
    else:
        bad = F.col("id").isNull() | F.col("features").isNull() | F.exists(
            "features", lambda v: v.isNull()
        )
    if dim is None:
        dim = one_width(proj.where(~bad).select(F.size("features").alias("width")))
    if feature_cols is None:
        bad = bad | (F.size("features") != F.lit(dim))
    if weight_col is not None:
        bad = bad | F.col("weight").isNull()
    tagged = proj.withColumn("_bad", bad)
    keep = [c for c in proj.columns]
    points = tagged.where(~F.col("_bad")).select(*keep)
    rejects = tagged.where(F.col("_bad")).select(
        "id", F.to_json(F.col("features")).alias("line"), F.lit("invalid").alias("reason")
    )
    return ParsedVectors(points, rejects)
