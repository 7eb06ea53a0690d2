"""lodestar: k-means family clustering of dense vectors as Spark DataFrame jobs."""

import sys as _sys

# The Arrow / pandas task functions are closures over this package's helpers.
# Pickle the package by value so Python workers need only NumPy, pandas and
# Arrow, not an installed copy of lodestar (no --py-files step on a cluster).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship with --py-files
    pass

from lodestar.operators import (
    KMeansResult,
    assign,
    cluster_stats,
    kmeans,
    kmeans_step,
    predict,
)
from lodestar.sources import (
    parse_vectors,
    read_text_vectors,
    seed_vectors,
    seeded_sample,
    table_vectors,
)

__all__ = [
    "KMeansResult",
    "assign",
    "cluster_stats",
    "kmeans",
    "kmeans_step",
    "parse_vectors",
    "predict",
    "read_text_vectors",
    "seed_vectors",
    "seeded_sample",
    "table_vectors",
]
