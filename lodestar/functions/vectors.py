"""Column builders for dense vectors stored as ``array<double>``.

Everything here is SQL text, so distances and nearest-centre choices run inside whole-stage codegen on the executors.
Constant vectors (centres, canopy centres) are inlined as literals: they are
small (K x D numbers, size-checked by the callers) and keep each round's plan
flat, with no join and no lineage growth from round to round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def sql_double(v: float) -> str:
    """A Spark SQL double literal that parses back to exactly ``v``."""
    v = float(v)
    if v != v or v in (float("inf"), float("-inf")):
        return f"CAST('{v!r}' AS DOUBLE)".replace("inf", "Infinity").replace("nan", "NaN")
    return f"({v!r}D)"


def elem_sql(features, d: int) -> list[str]:
    """SQL text of the vector elements: one column per dimension, or the array's.

    The first element of an array of another length is null, and so are all its
    distances: such a row belongs to no centre, as a row with a null does.
    """
    if isinstance(features, (list, tuple)):
        return [f"`{c}`" for c in features]
    first = f"CASE WHEN size(`{features}`) = {d} THEN get(`{features}`, 0) END"
    return [first if i == 0 else f"get(`{features}`, {i})" for i in range(d)]


def sq_dist_sql(xs: Sequence[str], center: Sequence[float]) -> str:
    """Unrolled squared distance as SQL text (left-to-right sum)."""
    terms = []
    for x, c in zip(xs, center):
        diff = f"({x} - {sql_double(c)})"
        terms.append(f"({diff} * {diff})")
    return " + ".join(terms) if terms else "(0.0D)"


def with_nearest(
    df: DataFrame,
    features,
    centers: Sequence[Sequence[float]],
    ids: Sequence[int] | None = None,
    eligible: Sequence[str] | None = None,
) -> DataFrame:
    """Append ``cid`` (int) and ``d2`` (double) of the nearest constant centre.

    ``features`` is an array column name or a list of per-dimension columns.
    Three projections: the per-centre distances, their minimum, then the
    first centre at that minimum (lowest id on ties). Catalyst does not
    collapse a projection whose non-trivial outputs are used more than once,
    so every distance is computed once per row. The expressions are built as
    SQL text, parsed once on the JVM: building them node by node from Python
    cost ~1 s of driver time per round. ``eligible`` (SQL boolean text, one
    per centre) masks centres out; a row with none eligible gets nulls.
    """
    ids = list(range(len(centers))) if ids is None else [int(i) for i in ids]
    d = len(centers[0]) if centers else 0
    xs = elem_sql(features, d)
    base = [f"`{c}`" for c in df.columns]
    dexpr = []
    for k, c in enumerate(centers):
        e = sq_dist_sql(xs, c)
        if eligible is not None:
            e = f"CASE WHEN {eligible[k]} THEN {e} END"
        dexpr.append(f"{e} AS `_d{k}`")
    names = [f"`_d{k}`" for k in range(len(centers))]
    step1 = df.selectExpr(*base, *dexpr)
    m = names[0] if len(names) == 1 else f"least({', '.join(names)})"
    step2 = step1.selectExpr(*base, *names, f"{m} AS `_m`")
    case = " ".join(f"WHEN {n} = `_m` THEN {cid}" for n, cid in zip(names, ids))
    return step2.selectExpr(*base, f"CAST(CASE {case} END AS INT) AS cid", "`_m` AS d2")
