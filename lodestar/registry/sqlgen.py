"""DuckDB SQL builders for the oracle side (lists are 1-based there)."""

from __future__ import annotations

from lodestar.registry.inputs import ROUND, SEED, sql_vectors


def d2(a: str, b: str, dim: int) -> str:
    """Unrolled squared distance, summed left to right like the Spark side."""
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, dim + 1))


def md5_key(id_expr: str = "id", seed: int = SEED) -> str:
    return f"md5(concat(CAST({id_expr} AS VARCHAR), ':{seed}'))"


def seeds(view: str, k: int, how: str = "sample", seed: int = SEED) -> str:
    """``cid INTEGER, c DOUBLE[]``: the k picks of ``sources.sample.seed_vectors``."""
    order = f"{md5_key('id', seed)}, id, f" if how == "sample" else "id, f"
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS cid, f AS c "
        f"FROM ({sql_vectors(view)}) ORDER BY {order} LIMIT {k}"
    )


def long_out(src: str, keys: str, vec: str, dim: int, digits: int = ROUND) -> str:
    return (
        f"SELECT {keys}, CAST(i - 1 AS INTEGER) AS dim, round({vec}[i], {digits}) AS value "
        f"FROM {src}, range(1, {dim + 1}) t(i)"
    )


def vec_avg(sums: str, denom: str, dim: int) -> str:
    return "[" + ", ".join(f"{sums}[{i}] / {denom}" for i in range(1, dim + 1)) + "]"


def lloyd_ctes(
    pts: str,
    c0: str,
    dim: int,
    tol: float | None,
    max_iter: int,
    on_empty: str = "keep",
    weighted: bool = False,
    prefix: str = "",
) -> tuple[list[str], str]:
    """CTE chain of ``max_iter`` Lloyd rounds (names prefixed by ``prefix``).

    ``pts`` yields ``id, f`` (and ``w`` when ``weighted``); ``c0`` yields
    ``cid, c``. Returns (ctes, final) where ``final`` names the stopping
    round's centres ``(cid, c)``; ``{prefix}rounds`` holds ``(it, delta, sse,
    clusters)`` up to the stop. ``on_empty='reseed'`` gives the e-th empty
    cluster (by cid) the e-th farthest point from its centre (ties: lowest id),
    ``'reseed-md5'`` the e-th point of the seeded sample's order.
    """
    P = prefix
    wcol = ", p.w" if weighted else ""
    ctes = [
        f"{P}pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM ({pts}))",
        f"{P}c0 AS MATERIALIZED ({c0})",
    ]
    wt = "a.w * " if weighted else ""
    sums = ", ".join(f"sum({wt}a.f[{i}])" for i in range(1, dim + 1))
    for r in range(1, max_iter + 1):
        p = r - 1
        ctes.append(
            f"{P}a{r} AS MATERIALIZED (SELECT p.id, p.f{wcol}, min({{'d': {d2('p.f', 'c.c', dim)}, 'k': c.cid}}) AS m "
            f"FROM {P}pts p CROSS JOIN {P}c{p} c GROUP BY p.rid, p.id, p.f{wcol})"
        )
        wsum = "sum(a.w)" if weighted else "count(*)"
        ctes.append(
            f"{P}s{r} AS MATERIALIZED (SELECT a.m.k AS cid, {wsum} AS n, sum({wt}a.m.d) AS sse, [{sums}] AS s "
            f"FROM {P}a{r} a GROUP BY a.m.k)"
        )
        if on_empty.startswith("reseed"):
            rank = "a.m.d DESC, a.id" if on_empty == "reseed" else f"{md5_key('a.id')}, a.id"
            ctes.append(
                f"{P}e{r} AS MATERIALIZED (SELECT o.cid, row_number() OVER (ORDER BY o.cid) AS er FROM {P}c{p} o "
                f"WHERE o.cid NOT IN (SELECT cid FROM {P}s{r}))"
            )
            ctes.append(
                f"{P}far{r} AS MATERIALIZED (SELECT a.f, row_number() OVER (ORDER BY {rank}) AS fr "
                f"FROM {P}a{r} a)"
            )
            ctes.append(
                f"{P}c{r} AS MATERIALIZED (SELECT o.cid, CASE WHEN s.n IS NOT NULL THEN {vec_avg('s.s', 's.n', dim)} "
                f"WHEN fa.f IS NOT NULL THEN fa.f ELSE o.c END AS c FROM {P}c{p} o "
                f"LEFT JOIN {P}s{r} s ON o.cid = s.cid LEFT JOIN {P}e{r} e ON o.cid = e.cid "
                f"LEFT JOIN {P}far{r} fa ON fa.fr = e.er)"
            )
        else:
            ctes.append(
                f"{P}c{r} AS MATERIALIZED (SELECT o.cid, CASE WHEN s.n IS NULL THEN o.c "
                f"ELSE {vec_avg('s.s', 's.n', dim)} END AS c FROM {P}c{p} o LEFT JOIN {P}s{r} s ON o.cid = s.cid)"
            )
        ctes.append(
            f"{P}d{r} AS MATERIALIZED (SELECT {r} AS it, (SELECT sum({d2('o.c', 'n.c', dim)}) FROM {P}c{p} o "
            f"JOIN {P}c{r} n ON o.cid = n.cid) AS delta, (SELECT sum(sse) FROM {P}s{r}) AS sse, "
            f"(SELECT count(*) FROM {P}s{r}) AS clusters)"
        )
    alld = " UNION ALL ".join(f"SELECT * FROM {P}d{r}" for r in range(1, max_iter + 1))
    stop = (
        f"SELECT coalesce(min(it) FILTER (WHERE delta <= {tol!r}), {max_iter}) AS r FROM {P}alld"
        if tol is not None
        else f"SELECT {max_iter} AS r"
    )
    ctes.append(f"{P}alld AS MATERIALIZED ({alld})")
    ctes.append(f"{P}stop AS MATERIALIZED ({stop})")
    ctes.append(f"{P}rounds AS MATERIALIZED (SELECT * FROM {P}alld WHERE it <= (SELECT r FROM {P}stop))")
    allc = " UNION ALL ".join(f"SELECT {r} AS r, cid, c FROM {P}c{r}" for r in range(1, max_iter + 1))
    ctes.append(
        f"{P}final AS MATERIALIZED (SELECT cid, c FROM ({allc}) WHERE r = (SELECT r FROM {P}stop))"
    )
    return ctes, f"{P}final"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
