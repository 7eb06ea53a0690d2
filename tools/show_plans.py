"""Print the physical plans of the per-round jobs (``explain('formatted')``).

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lodestar.operators.assign import cluster_stats, predict  # noqa: E402
from lodestar.operators.canopy import canopy_membership, restricted_assign  # noqa: E402
from lodestar.plans import local_session  # noqa: E402
from lodestar.registry.inputs import vectors  # noqa: E402
from lodestar.sources.sample import seed_vectors  # noqa: E402


def main(sf_dir: str) -> None:
    spark = local_session(8)
    li = vectors(spark, sf_dir, "li")
    cs = seed_vectors(li, 8)
    print("=== Lloyd round, expression form (lineitem, K=8, D=4) ===")
    cluster_stats(li, cs).explain("formatted")
    emb = vectors(spark, sf_dir, "emb")
    ce = seed_vectors(emb, 8)
    print("=== Lloyd round, Arrow form (embeddings, K=8, D=64) ===")
    cluster_stats(emb, ce).explain("formatted")
    print("=== predict (projection, no join) ===")
    predict(li, cs).explain("formatted")
    cust = vectors(spark, sf_dir, "cust")
    canopies = [(1, [0.0, 0.0]), (2, [5000.0, 10.0])]
    memb = canopy_membership(cust, canopies, 3000.0)
    print("=== canopy-restricted assignment (array overlap, no join) ===")
    restricted_assign(memb, {1: ([0.0, 0.0], [1]), 2: ([5000.0, 10.0], [1, 2])}, [1, 2]).groupBy(
        "cid"
    ).agg(F.count("*")).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
