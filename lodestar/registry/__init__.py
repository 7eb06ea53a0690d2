"""Registered queries: one Spark DataFrame builder and one DuckDB oracle per name.

The Spark builders take ``(spark, sf_dir)`` and read the driver's Parquet
tables; the oracle SQL runs on the same tables registered as DuckDB views.
A ``None`` oracle marks an operator checked against brute force in tests
instead (see ``tests/``).
"""

from __future__ import annotations


def all_queries() -> dict:
    from lodestar.registry import canopy_q, density_q, lloyd_q, two_level_q

    out = {}
    for mod in (lloyd_q, canopy_q, density_q, two_level_q):
        out.update(mod.QUERIES)
    return out
