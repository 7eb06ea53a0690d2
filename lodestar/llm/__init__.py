"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

from lodestar.llm.queries import QUERIES

__all__ = ["QUERIES"]
