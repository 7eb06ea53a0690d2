import json
import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest

from lodestar import kmeans
from lodestar.operators.canopy import (
    canopy_membership,
    global_canopies,
    greedy_pick,
    kmeans_canopy,
    local_canopies,
    merge_canopies,
)
from lodestar.operators.greedy import greedy_rounds, ordered
from models import blobs, canopy_kmeans


@pytest.mark.parametrize("n,d,t", [(178, 13, (12, 8, 12)), (150, 4, (5, 2.5, 5)), (47, 35, (20, 13, 21))])
@pytest.mark.parametrize("form", ["auto", "arrow"])
@pytest.mark.parametrize("distinct", [True, False])
def test_against_model(frame, n, d, t, form, distinct):
    x = blobs(n, d, 5, seed=d, spread=1.5)
    r = kmeans_canopy(frame(x.tolist()), *t, tol=0.001, max_iter=20, buckets=1, form=form, distinct=distinct)
    if distinct:
        _, at = np.unique(x, axis=0, return_index=True)
        x = x[np.sort(at)]
    canopies, covered, deltas, sizes = canopy_kmeans(x, *t, 0.001, 20)
    assert canopies > 1 and r.canopies.count() == canopies
    assert r.membership.first().covered == covered
    assert [v.delta for v in r.trace.orderBy("iter").collect()] == pytest.approx(deltas)
    assert [v.size for v in r.centers.orderBy("cid").collect()] == sizes


def test_a_new_row_changes_its_own_bucket_alone(frame):
    x = np.random.default_rng(6).uniform(0, 10, (600, 2)).tolist()
    one = local_canopies(frame(x[:599]), 2.0, buckets=8).collect()
    two = local_canopies(frame(x), 2.0, buckets=8).collect()
    changed = {(r.bucket, r.id) for r in one} ^ {(r.bucket, r.id) for r in two}
    assert len({bucket for bucket, _ in changed}) <= 1


def test_only_eligible_pairs_are_compared():
    import pyarrow as pa

    from lodestar.plans.physical import Eligible

    may = Eligible([[1], [1, 3], [2], []], [1, 2, 3])
    row, cen = may.pairs(pa.array([[1], [2], [], [3, 1], [2, 3]], pa.list_(pa.int32())), 4)
    assert list(zip(row.tolist(), cen.tolist())) == [(0, 0), (0, 1), (1, 2), (3, 0), (3, 1), (4, 1), (4, 2)]
    assert len(row) < 5 * 4


def test_uncovered_points_may_join_the_nearest(frame):
    pts = frame([[0.0], [0.3], [9.0], [10.0], [30.0]])
    r = kmeans_canopy(pts, 5, 0.5, 5, buckets=1, cover="nearest", max_iter=1)
    assert r.uncovered.count() == 0 and r.assignments.count() == 5
    assert {x.id: x.cid for x in r.assignments.collect()} == {0: 1, 1: 1, 2: 2, 3: 2, 4: 3}


def test_greedy_thresholds():
    x = np.array([[0.0], [1.0], [2.0], [2.5], [4.0]])
    # strict '>' : a point exactly at T1 from a centre does not become a centre
    assert greedy_pick(x, 2.0) == [0, 3]
    assert greedy_pick(x, 1.0) == [0, 2, 4]


def test_membership_strict_and_multi(frame):
    pts = frame([[0.0], [1.0], [2.0], [5.0]])
    m = {r.id: list(r.canopies) for r in canopy_membership(pts, [(1, [0.0]), (2, [2.0])], 1.0).collect()}
    assert m == {0: [1], 1: [], 2: [2], 3: []}  # distance exactly T2 is outside
    m2 = {r.id: list(r.canopies) for r in canopy_membership(pts, [(1, [0.0]), (2, [2.0])], 1.5).collect()}
    assert m2[1] == [1, 2] and m2[3] == []


def test_chunked_merge_equals_single_pass(spark, frame):
    rng = np.random.default_rng(11)
    vecs = rng.uniform(0, 10, size=(400, 2)).tolist()
    pts = frame(vecs)
    cands = local_canopies(pts, 1.0, buckets=3).cache()
    one = merge_canopies(cands, 1.5)
    small = merge_canopies(cands, 1.5, chunk=7)
    assert [(c, i) for c, i, _ in one] == [(c, i) for c, i, _ in small]
    rows = sorted(((r.bucket, r.id), list(r.features)) for r in cands.collect())
    order = [v for _, v in rows]
    want = greedy_pick(np.array(order), 1.5)
    assert [i for _, i, _ in one] == [rows[w][0][1] for w in want]


def test_uncovered_points_leave(frame):
    pts = frame([[0.0], [0.5], [10.0], [30.0]])
    r = kmeans_canopy(pts, 5, 1, 5, buckets=1)
    assert sorted(x.id for x in r.uncovered.collect()) == []
    r2 = kmeans_canopy(pts, 5, 0.4, 100, buckets=1)  # global merge keeps only the first canopy
    assert sorted(x.id for x in r2.uncovered.collect()) == [1, 2, 3]


def test_huge_t2_equals_lloyd(frame):
    pts = frame(blobs(178, 13, 4, seed=5).tolist())
    r = kmeans_canopy(pts, 12, 1e9, 12, tol=0.0, max_iter=30, buckets=1)
    seeds = [list(x.center) for x in r.canopies.orderBy("canopy").collect()]
    distinct = pts.dropDuplicates(["features"])
    k1 = kmeans(distinct, init=seeds, tol=0.0, max_iter=30)
    a = [[round(v, 6) for v in x.center] for x in r.centers.orderBy("cid").collect()]
    b = [[round(v, 6) for v in x.center] for x in k1.centers.orderBy("cid").collect()]
    assert a == b


def test_merge_goes_on_among_equal_ids_and_without_buckets(spark):
    rows = [(0, 1, [0.0, 0.0]), (0, 1, [9.0, 0.0]), (0, 1, [9.0, 9.0]), (0, 2, [0.0, 9.0]), (1, 1, [0.5, 0.0]), (1, None, [30.0, 0.0]), (1, None, [30.0, 30.0])]
    rows += [(None, 5, [60.0, 0.0]), (None, 5, [60.0, 60.0]), (None, 6, [60.0, 1.0])]
    cands = spark.createDataFrame(rows, "bucket int, id bigint, features array<double>")
    want = merge_canopies(cands, 2.0)
    assert [c for c, _, _ in want] == list(range(1, 9))
    for chunk in (1, 2, 3):
        assert merge_canopies(cands, 2.0, chunk=chunk) == want


def test_rows_without_a_bucket_share_one(spark):
    rows = [(i, [float(i), 0.0], None if i % 2 else 3) for i in range(20)]
    pts = spark.createDataFrame(rows, "id bigint, features array<double>, b int")
    got = {(r.id, r.bucket) for r in local_canopies(pts, 4.5, bucket_col="b").collect()}
    assert {i for i, b in got if b == 3} == {0, 6, 12, 18} and {i for i, b in got if b != 3} == {1, 7, 13, 19}
    one = merge_canopies(local_canopies(pts, 4.5, bucket_col="b"), 0.5, chunk=1)
    assert sorted(i for _, i, _ in one) == [0, 1, 6, 7, 12, 13, 18, 19]


def _walk_in_order(x, radius):
    out = []
    for i, v in enumerate(x):
        if all(np.sqrt(((v - x[j]) ** 2).sum()) > radius for j in out):
            out.append(i)
    return out


@pytest.mark.parametrize("d,radius", [(1, 2.0), (2, 4.0), (5, 30.0)])
def test_rounds_equal_the_sequential_walk(frame, d, radius):
    x = np.random.default_rng(d).uniform(0, 100, (700, d)).round(1)
    x[600:] = x[:100]
    want = _walk_in_order(x, radius)
    for parts in (1, 5):
        got = local_canopies(frame(x.tolist(), parts=parts), radius, buckets=1, bucket_rows=50)
        assert sorted(r.id for r in got.collect()) == want
    trace = []
    pts = ordered(frame(x.tolist(), parts=3), "id").selectExpr("0 as grp", "seq", "id", "features").cache()
    tables = greedy_rounds(pts, radius, d, head_rows=40, trace=trace)
    assert len(tables) > 2 and sum(trace) == len(want)
    assert [r.id for t in tables for r in t.orderBy("seq").collect()] == want


def test_large_and_small_buckets_together(spark):
    x = np.random.default_rng(3).uniform(0, 50, (600, 2)).round(1)
    bucket = [0 if i < 400 else 1 if i < 500 else None if i < 560 else 2 for i in range(600)]
    pts = spark.createDataFrame([(i, v.tolist(), b) for i, (v, b) in enumerate(zip(x, bucket))], "id bigint, features array<double>, b int")
    got = local_canopies(pts, 6.0, bucket_col="b", bucket_rows=90).collect()
    for b in (0, 1, None, 2):
        rows = [i for i in range(600) if bucket[i] == b]
        want = [rows[j] for j in _walk_in_order(x[rows], 6.0)]
        assert sorted(r.id for r in got if r.id in set(rows)) == want


def test_more_canopies_than_one_walk_takes(frame):
    x = np.random.default_rng(8).uniform(0, 1000, (900, 2)).round(1)
    cands = local_canopies(frame(x.tolist()), 5.0, buckets=4).cache()
    rows = sorted(((r.bucket, r.id), list(r.features)) for r in cands.collect())
    want = [rows[i][0][1] for i in _walk_in_order(np.array([v for _, v in rows]), 8.0)]
    got = global_canopies(cands, 8.0, chunk=100).orderBy("canopy").collect()
    assert len(want) > 300 and [r.id for r in got] == want and [r.canopy for r in got] == list(range(1, len(want) + 1))


def test_one_bucket_uses_all_cores(tmp_path):
    """With all rows in one bucket, no task takes over twice the median's rows (from Spark's event log)."""
    code = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark.sql import SparkSession
        from pyspark.sql import functions as F
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.eventLog.enabled", "true")
                 .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
                 .config("spark.eventLog.dir", "file://{tmp_path}").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate())
        import lodestar.operators.greedy as greedy
        from lodestar.operators.canopy import local_canopies
        greedy.HEAD_ROWS = 500
        pts = spark.range(0, 60000, numPartitions=8).select("id", F.array(F.rand(3) * 100, F.rand(4) * 100).alias("features"))
        pts.write.parquet("file://{tmp_path}/pts")
        greedy.greedy_rounds.__defaults__ = (1, 500, None)
        print("FOUND", local_canopies(spark.read.parquet("file://{tmp_path}/pts"), 5.0, buckets=1, bucket_rows=1000, dim=2).count())
        """
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "FOUND" in out.stdout, out.stderr[-2000:]
    (log,) = [p for p in tmp_path.iterdir() if p.is_file() and p.name.startswith("local-")]
    rows: dict = {}
    for line in log.read_text().splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            n = m["Input Metrics"]["Records Read"] + m["Shuffle Read Metrics"]["Total Records Read"]
            rows.setdefault(e["Stage ID"], []).append(n)
    busy = [sorted(r) for r in rows.values() if sum(r) > 30_000]  # stages that go over most of the table
    assert len(busy) >= 3
    for r in busy:
        assert len(r) >= 4 and r[-1] <= 2 * max(r[len(r) // 2], 1), busy


def test_odd_rows_become_no_canopy(spark):
    whole = [(i, [float(i % 6), float(i // 6)]) for i in range(36)]
    odd = [(50, None), (51, [1.0]), (52, [None, 2.0]), (53, [90.0, 1.0, 2.0])]
    a = kmeans_canopy(spark.createDataFrame(whole, "id bigint, features array<double>"), 3, 2.5, 3, buckets=2, max_iter=3)
    for rows in (odd + whole, whole + odd):
        pts = spark.createDataFrame(rows, "id bigint, features array<double>")
        b = kmeans_canopy(pts, 3, 2.5, 3, buckets=2, max_iter=3, dim=2, distinct=rows[0] == odd[0])
        assert b.canopies.orderBy("canopy").collect() == a.canopies.orderBy("canopy").collect()
        assert b.centers.orderBy("cid").collect() == a.centers.orderBy("cid").collect()
        assert b.membership.first() == a.membership.first()
        assert {r.id for r in b.assignments.collect()} <= set(range(36)) and b.uncovered.count() == a.uncovered.count()
        with pytest.raises(ValueError, match="width"):
            kmeans_canopy(pts, 3, 2.5, 3)


@pytest.mark.parametrize("d,broadcast", [(2, True), (5, False)])
def test_join_form_equals_the_list_form(frame, monkeypatch, d, broadcast):
    from lodestar.operators import canopy_join

    if not broadcast:
        monkeypatch.setattr(canopy_join, "BROADCAST_BYTES", -1)
    x = np.random.default_rng(d).uniform(-40, 40, (300, d)).round(1)
    r = {2: (9, 7, 9), 5: (40, 34, 40)}[d]
    a = kmeans_canopy(frame(x.tolist()), *r, buckets=2, max_iter=2, form="arrow")
    b = kmeans_canopy(frame(x.tolist()), *r, buckets=2, max_iter=2, form="join")
    assert a.canopies.count() > 10 and b.canopies.orderBy("canopy").collect() == a.canopies.orderBy("canopy").collect()
    assert b.assignments.orderBy("id").collect() == a.assignments.orderBy("id").collect()
    assert sorted(v.id for v in b.uncovered.collect()) == sorted(v.id for v in a.uncovered.collect())
    assert b.membership.first() == a.membership.first()
    for one, two in zip(a.centers.orderBy("cid").collect(), b.centers.orderBy("cid").collect(), strict=True):
        assert (one.cid, one.size, one.active) == (two.cid, two.size, two.active) and two.center == pytest.approx(one.center)
    assert [v.delta for v in b.trace.orderBy("iter").collect()] == pytest.approx([v.delta for v in a.trace.orderBy("iter").collect()])


def test_join_plan_follows_the_measured_size(frame):
    from lodestar.operators.canopy_join import radius_join

    pts = frame(np.random.default_rng(1).uniform(0, 9, (50, 2)).tolist())
    can = pts.selectExpr("cast(id as int) as canopy", "features as center")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small, large = radius_join(pts, can, 1.0, 2, 50), radius_join(pts, can, 1.0, 2, 10**9)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    assert sorted(small.select("id", "canopy").collect()) == sorted(large.select("id", "canopy").collect())
