"""Benchmark: headline clustering queries on $BENCH_SF_DIR at local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is timed end to end (plan + run + collect). Before timing, every
headline query runs once on the smallest scale factor, so JIT and code
generation warm-up is not billed to the first timed query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "kmeans_lineitem",  # K1 Lloyd, 600k x 4 at sf0.1, 8 centres, up to 10 rounds
    "kmeans_lloyd",  # K1 on 64-dim embeddings (Arrow kernel)
    "kmeans_step",  # one assign + aggregate round on lineitem
    "nearest_center",  # P6 / J1 assignment
    "text_vector_scan",  # S1 parse with rejects
    "kmeans_canopy",  # K6 canopy k-means on customer
    "adaptive_radius",  # K3 exact all-pairs sum (tiled)
    "kmeans_density",  # K5 = K3 + K4 + K1 on customer
    "kmeans_two_level",  # K2 on embeddings
    "pair_distance_topk",  # K2a closest pairs over supplier
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from lodestar.plans import local_session
    from lodestar.registry import all_queries

    spark = local_session(cpus, "lodestar-bench")
    qs = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for n in names:  # warm-up pass on the smallest tables
        qs[n][0](spark, warm if os.path.isdir(warm) else sf_dir).collect()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n][0](spark, sf_dir).collect()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
