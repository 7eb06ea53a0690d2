"""Sources: delimited text and table scans to ``(id, features)``, seeded samples."""

from lodestar.sources.sample import (
    DEFAULT_SEED,
    first_rows,
    sample_key,
    seed_vectors,
    seeded_sample,
)
from lodestar.sources.table import table_vectors
from lodestar.sources.text import ParsedVectors, infer_dim, parse_tagged, parse_vectors, read_text_vectors

__all__ = [
    "DEFAULT_SEED",
    "ParsedVectors",
    "first_rows",
    "infer_dim",
    "parse_tagged",
    "parse_vectors",
    "read_text_vectors",
    "sample_key",
    "seed_vectors",
    "seeded_sample",
    "table_vectors",
]
