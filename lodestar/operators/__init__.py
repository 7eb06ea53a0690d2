"""Clustering operators over ``(id, features)`` DataFrames."""

from lodestar.operators.assign import (
    assign,
    centers_from_frame,
    cluster_stats,
    kmeans_step,
    predict,
)
from lodestar.operators.lloyd import KMeansResult, kmeans, lloyd_rounds, resolve_init

__all__ = [
    "KMeansResult",
    "assign",
    "centers_from_frame",
    "cluster_stats",
    "kmeans",
    "kmeans_step",
    "lloyd_rounds",
    "predict",
    "resolve_init",
]
