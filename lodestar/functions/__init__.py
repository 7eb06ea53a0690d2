"""Vector expressions (distances, nearest centre)."""

from lodestar.functions.vectors import elem_sql, sq_dist_sql, with_nearest

__all__ = ["elem_sql", "sq_dist_sql", "with_nearest"]
