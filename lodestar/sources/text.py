"""Delimited text -> vectors, with a second frame for rejected lines.

A line is accepted when every field casts to double and the field count
equals the dataset dimension. Blank, ragged or non-numeric lines go to
``rejects`` with a reason instead of failing the job. Trailing ``\\r``
(CRLF files) and ``.28``-style decimals cast cleanly.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ParsedVectors(NamedTuple):
    points: DataFrame  # id bigint, features array<double>
    rejects: DataFrame  # id bigint, line string, reason string


def _fields(value_col: str, sep: str):
    parts = F.split(F.col(value_col), re.escape(sep))
    return F.transform(parts, lambda v: v.try_cast("double"))


def one_width(widths: DataFrame) -> int:
    """The only value of the column ``width`` over all rows (0 for no rows); an error if there are several."""
    found = [r["width"] for r in widths.groupBy("width").count().orderBy(F.desc("count"), "width").limit(3).collect()]
    if len(found) > 1:
        raise ValueError(f"rows differ in width ({found} and perhaps more); pass dim= to say which one counts")
    return int(found[0]) if found else 0


def infer_dim(df: DataFrame, value_col: str = "value", sep: str = ",") -> int:
    """Width of the non-blank lines, which must agree (one job over all of them; pass ``dim`` to skip)."""
    lines = df.where(F.length(F.trim(F.col(value_col))) > 0)
    d = one_width(lines.select(F.size(F.split(F.col(value_col), re.escape(sep))).alias("width")))
    if not d:
        raise ValueError("no non-blank line to infer the dimension from")
    return d


def parse_tagged(
    df: DataFrame,
    value_col: str = "value",
    id_col: str = "id",
    sep: str = ",",
    dim: int | None = None,
) -> DataFrame:
    """Every line once: ``id, line, features, reason`` (reason null = accepted).

    One pass over the text serves both outcomes; ``parse_vectors`` splits it.
    """
    if dim is None:
        dim = infer_dim(df, value_col, sep)
    parsed = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(value_col).alias("line"),
        _fields(value_col, sep).alias("features"),
    )
    has_null = F.exists("features", lambda v: v.isNull())
    reason = (
        F.when(F.col("line").isNull() | has_null, F.lit("non_numeric"))
        .when(F.size("features") != F.lit(dim), F.lit("width"))
    )
    return parsed.withColumn("reason", reason)


def parse_vectors(
    df: DataFrame,
    value_col: str = "value",
    id_col: str = "id",
    sep: str = ",",
    dim: int | None = None,
) -> ParsedVectors:
    """Parse a string column of delimited numbers into ``features``.

    ``df`` must carry ``id_col``; the result keeps it as ``id``. Using both
    frames reads the input twice; persist ``parse_tagged`` to read it once.
    """
    tagged = parse_tagged(df, value_col, id_col, sep, dim)
    points = tagged.where(F.col("reason").isNull()).select("id", "features")
    rejects = tagged.where(F.col("reason").isNotNull()).select("id", "line", "reason")
    return ParsedVectors(points, rejects)


def read_text_vectors(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    dim: int | None = None,
    ids: str = "content",
) -> ParsedVectors:
    """Read delimited text files (no header) as vectors.

    ``ids='content'``: the id is a 64-bit hash of the line, so it is the same
    however files are split and read (equal lines share an id).
    ``ids='position'``: ids rise with the line order inside a file
    (``monotonically_increasing_id``), but depend on how files are split.
    """
    if ids not in ("content", "position"):
        raise ValueError(f"unknown ids {ids!r}")
    key = F.xxhash64("value") if ids == "content" else F.monotonically_increasing_id()
    return parse_vectors(spark.read.text(path).withColumn("id", key), "value", "id", sep, dim)
