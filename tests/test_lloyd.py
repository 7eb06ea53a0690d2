import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar import kmeans, predict
from models import blobs, lloyd
from lodestar.operators.assign import assign, cluster_stats


def _sizes_sse(res):
    rows = res.assignments.groupBy("cid").agg(F.count("*").alias("n"), F.sum("d2").alias("s")).orderBy("cid").collect()
    return [r.n for r in rows], sum(r.s for r in rows)


@pytest.mark.parametrize("form", ["expr", "arrow"])
def test_tie_goes_to_lowest_id(frame, form):
    pts = frame([[0.0, 0.0], [2.0, 0.0], [1.0, 0.0]])
    out = {r.id: r.cid for r in assign(pts, [[1.0, 1.0], [1.0, -1.0], [3.0, 0.0]], form=form).collect()}
    assert out[2] == 0  # equidistant from centres 0 and 1
    assert out[1] in (0, 2)


def test_forms_agree(frame):
    x = blobs(180, 13, 3, seed=4)
    x[:, 12] *= 100
    pts, seeds = frame(x.tolist()), x[:3].tolist()
    got = [{r.cid: (r.n, [round(v, 6) for v in r.sums]) for r in cluster_stats(pts, seeds, form=f).collect()} for f in ("expr", "arrow")]
    assert got[0] == got[1]


@pytest.mark.parametrize("n,d,k,form", [(150, 4, 3, "auto"), (178, 13, 3, "expr"), (178, 13, 3, "arrow"), (47, 35, 4, "auto")])
def test_against_model(frame, n, d, k, form):
    x = blobs(n, d, k, seed=n, spread=2.0)
    res = kmeans(frame(x.tolist()), k, init="first", tol=0.01, max_iter=100, form=form)
    c, rounds, sizes, sse = lloyd(x, x[:k], 0.01, 100)
    assert res.trace.count() == rounds
    got_sizes, got_sse = _sizes_sse(res)
    assert got_sizes == sizes and got_sse == pytest.approx(sse)
    assert np.allclose([list(r.center) for r in res.centers.orderBy("cid").collect()], c)


def test_explicit_seeds(frame):
    x = blobs(120, 2, 3, seed=1)
    seeds = [[0.0, 0.0], [5.0, 5.0], [9.0, 1.0]]
    res = kmeans(frame(x.tolist()), init=seeds, tol=0.01, max_iter=100)
    assert res.trace.count() == lloyd(x, seeds, 0.01, 100)[1]


def _odd(spark):
    rows = [(0, [0.0, 0.0]), (1, [4.0, 4.0]), (2, None), (3, [1.0, None]), (4, [1.0]), (5, [4.0, 5.0, 6.0]), (6, [])]
    return spark.createDataFrame(rows, "id bigint, features array<double>")


@pytest.mark.parametrize("form", ["expr", "arrow"])
def test_null_and_ragged_rows_belong_to_no_centre(spark, form):
    centers = [[0.0, 1.0], [4.0, 4.0]]
    got = {r.id: (r.cid, r.d2) for r in predict(_odd(spark), centers, form=form).collect()}
    assert got == {0: (0, 1.0), 1: (1, 0.0), **{i: (None, None) for i in range(2, 7)}}
    st = {r.cid: (r.n, list(r.sums)) for r in cluster_stats(_odd(spark), centers, form=form).collect()}
    assert st == {0: (1, [0.0, 0.0]), 1: (1, [4.0, 4.0])}
    res = kmeans(_odd(spark), init=centers, tol=0.0, max_iter=5, form=form)
    assert [(list(r.center), r.size) for r in res.centers.orderBy("cid").collect()] == [([0.0, 0.0], 1), ([4.0, 4.0], 1)]


def test_mixed_widths_need_a_dim(spark):
    with pytest.raises(ValueError, match="differ in width"):
        kmeans(_odd(spark), 1, init="first")
    assert kmeans(_odd(spark), 2, init="first", dim=2).centers.count() == 2


def test_centre_blocks_give_the_same_answer(frame, monkeypatch):
    from lodestar.plans import physical

    rng = np.random.default_rng(8)
    x = rng.integers(0, 5, (120, 3)).astype(float)  # ties between blocks
    c = rng.integers(0, 5, (40, 3)).astype(float)
    pts = frame(x.tolist())
    want = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1).tolist()
    got = {r.id: r.cid for r in predict(pts, c.tolist(), form="arrow", inline_limit=21).collect()}
    assert [got[i] for i in range(120)] == want
    one = kmeans(pts, init=c.tolist(), tol=0.0, max_iter=3, form="arrow")
    monkeypatch.setattr(physical, "MAX_CENTER_NUMBERS", 60)
    two = kmeans(pts, init=c.tolist(), tol=0.0, max_iter=3, form="arrow")
    assert np.allclose(*([list(r.center) for r in k.centers.orderBy("cid").collect()] for k in (one, two)))


def test_failure_midway_leaves_no_copy(spark, frame):
    import os

    from lodestar.plans.storage import checkpoint_dir

    base = checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(base))
    with pytest.raises(ValueError):
        kmeans(frame([[0.0], [1.0]]), 3, init="sample", checkpoint=True)  # fails after the copy was made
    with pytest.raises(ValueError):
        kmeans(frame([[0.0], [1.0]]), init=[[0.0], [9.0]], on_empty="error", max_iter=3, checkpoint=True)
    assert set(os.listdir(base)) == before


def test_large_scans_are_not_copied(spark, tmp_path):
    from lodestar.plans.storage import plain_scan, prepared, spread

    src = str(tmp_path / "many")
    spark.range(100).selectExpr("id", "array(cast(id as double)) as features").repartition(6).write.parquet(src)
    df = spark.read.parquet(src).where("id > 3").select("id", "features")
    assert plain_scan(df) and not plain_scan(df.distinct())
    with prepared(spread(df)) as got:
        assert got is df
    with prepared(df.distinct()) as got:
        assert got is not df and got.count() == 96


def test_empty_cluster_policies(frame):
    pts = frame([[0.0], [0.1], [10.0], [10.1]])
    seeds = [[0.0], [10.0], [100.0]]
    keep = kmeans(pts, init=seeds, tol=0.0, max_iter=3, on_empty="keep")
    assert [list(r.center) for r in keep.centers.orderBy("cid").collect()][2] == [100.0]
    with pytest.raises(ValueError):
        kmeans(pts, init=seeds, tol=0.0, max_iter=3, on_empty="error")
    re = kmeans(pts, init=seeds, tol=0.0, max_iter=1, on_empty="reseed")
    # farthest point from its centre: 10.1 (d2 0.01) vs 0.1 (0.01): lowest id wins -> id 1
    assert list(re.centers.orderBy("cid").collect()[2].center) == [0.1]


def test_k1_and_identical_points(frame):
    same = frame([[1.0, 1.0]] * 5)
    res = kmeans(same, 1, init="first", tol=0.0, max_iter=5)
    assert list(res.centers.first().center) == [1.0, 1.0]
    assert res.trace.count() == 1  # delta 0 on the first round


def test_k_greater_than_n(frame):
    with pytest.raises(ValueError):
        kmeans(frame([[0.0], [1.0]]), 3, init="first")
    with pytest.raises(ValueError):
        kmeans(frame([[0.0], [0.0], [0.0]]), 2, init="first", distinct_seeds=True)


def test_large_tol_still_runs_one_round(frame):
    res = kmeans(frame([[0.0], [1.0], [5.0]]), 2, init="first", tol=1e9, max_iter=10)
    assert res.trace.count() == 1


def test_repartition_invariance_and_cost_monotone(spark, frame):
    rng = np.random.default_rng(7)
    vecs = np.vstack([rng.normal(c, 0.3, size=(60, 3)) for c in ([0, 0, 0], [3, 3, 0], [0, 3, 3])]).tolist()
    a = kmeans(frame(vecs), 3, init="sample", tol=1e-9, max_iter=30)
    b = kmeans(frame(vecs, parts=5), 3, init="sample", tol=1e-9, max_iter=30)
    ca = [[round(x, 9) for x in r.center] for r in a.centers.orderBy("cid").collect()]
    cb = [[round(x, 9) for x in r.center] for r in b.centers.orderBy("cid").collect()]
    assert ca == cb
    sse = [r.sse for r in a.trace.orderBy("iter").collect()]
    assert all(x >= y - 1e-9 for x, y in zip(sse, sse[1:]))


def test_predict_against_numpy(frame):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 5))
    c = rng.normal(size=(20, 5))  # 100 terms: expression form; also force arrow
    for form in ("expr", "arrow"):
        got = {r.id: r.cid for r in predict(frame(x.tolist()), c.tolist(), form=form).collect()}
        want = ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        assert [got[i] for i in range(200)] == want.tolist()


def test_weighted_stats(spark):
    df = spark.createDataFrame([(1, [0.0], 1.0), (2, [2.0], 3.0)], "id bigint, features array<double>, weight double")
    for form in ("expr", "arrow"):
        r = cluster_stats(df, [[1.0]], weight="weight", form=form).first()
        assert r.n == 2 and r.weight == 4.0 and list(r.sums) == [6.0]


def test_checkpointed_points(spark, frame):
    import os

    from lodestar.plans.storage import checkpoint_dir

    base = checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(base))
    vecs = [[float(i % 5), float(i % 3)] for i in range(60)]
    a = kmeans(frame(vecs), 3, init="first", tol=0.0, max_iter=10, checkpoint=False)
    b = kmeans(frame(vecs), 3, init="first", tol=0.0, max_iter=10, checkpoint=True)
    ca = [list(r.center) for r in a.centers.orderBy("cid").collect()]
    cb = [list(r.center) for r in b.centers.orderBy("cid").collect()]
    assert ca == cb
    assert b.assignments.count() == 60  # lazy output reads the source, not the deleted copy
    left = {n for n in set(os.listdir(base)) - before if n.startswith("lodestar-")}
    assert not left  # the written copy is removed once the operator is done


@pytest.mark.parametrize("d,k", [(1, 700), (2, 3000), (4, 600), (9, 600)])
def test_boxes_of_centres_give_the_same_answer(d, k):
    from lodestar.plans import physical

    rng = np.random.default_rng(d)
    c = rng.uniform(0, 50, (k, d)).round(1)
    c[::7] = c[0]  # ties between equal centres
    x = np.concatenate([rng.uniform(-5, 55, (1500, d)), c[:200], np.full((30, d), 25.0)])
    index = physical.index_of(c)
    lab, mind = physical._nearest(x, c, index)
    want, dist = physical._nearest(x, c)
    assert (lab == want).all() and (mind == dist).all()
    assert index.computed < (0.2 if d <= 2 else 1.1) * len(x) * k
    assert physical.index_of(np.full((600, d), 3.0)).nearest(x)[0].max() == 0


def test_large_k_counts_its_distances(spark, frame):
    x = np.random.default_rng(2).uniform(0, 100, (4000, 2))
    c = np.random.default_rng(3).uniform(0, 100, (1000, 2)).tolist()
    seen = spark.sparkContext.accumulator(0)
    got = {r.id: r.cid for r in assign(frame(x.tolist()), c, compared=seen).collect()}
    assert [got[i] for i in range(4000)] == ((x[:, None] - np.array(c)[None]) ** 2).sum(-1).argmin(1).tolist()
    assert 0 < seen.value < 0.3 * 4000 * 1000


@pytest.mark.parametrize("k,weight", [(1, None), (2, None), (9, "w")])
def test_bounds_give_the_same_rounds(spark, k, weight):
    x = blobs(600, 3, 9, seed=k, spread=2.0)
    rows = [(i, v.tolist(), 1.0 + i % 3) for i, v in enumerate(x)] + [(900, None, 1.0), (901, [1.0], 1.0), (902, [None, 1.0, 2.0], 1.0)]
    pts = spark.createDataFrame(rows, "id bigint, features array<double>, w double").repartition(3)
    how = dict(init=x[:k].tolist(), tol=0.0, max_iter=12, weight=weight, dim=3)
    a, seen = kmeans(pts, form="arrow", **how), []
    b = kmeans(pts, form="bounds", computed=seen, **how)
    for one, two in zip(a.centers.orderBy("cid").collect(), b.centers.orderBy("cid").collect(), strict=True):
        assert (one.cid, one.size) == (two.cid, two.size) and two.center == pytest.approx(one.center)
    ta, tb = a.trace.orderBy("iter").collect(), b.trace.orderBy("iter").collect()
    assert len(ta) == len(tb) == len(seen) and [r.clusters for r in ta] == [r.clusters for r in tb]
    assert [r.delta for r in tb] == pytest.approx([r.delta for r in ta]) and [r.sse for r in tb] == pytest.approx([r.sse for r in ta])
    assert a.assignments.orderBy("id").collect() == b.assignments.orderBy("id").collect()


def test_bounds_compute_at_most_half_on_lineitem(spark):
    from lodestar.registry.inputs import vectors

    pts = vectors(spark, "/root/testdata/sf0.01", "li")
    seen = []
    a = kmeans(pts, 32, tol=0.01, max_iter=10, form="bounds", computed=seen, dim=4)
    n = pts.count()
    assert sum(seen) <= 0.5 * n * 32 * len(seen), [s / n for s in seen]
    b = kmeans(pts, 32, tol=0.01, max_iter=10, form="expr", dim=4)
    got, want = (r.trace.orderBy("iter").collect() for r in (a, b))
    assert [r.delta for r in got] == pytest.approx([r.delta for r in want], rel=1e-6)


def test_empty_clusters_with_bounds(frame):
    pts = frame([[0.0], [1.0], [9.0], [10.0]])
    how = dict(init=[[0.0], [100.0], [9.0]], max_iter=4, tol=0.0)
    for policy in ("keep", "reseed"):
        a, b = (kmeans(pts, on_empty=policy, form=f, **how).centers.orderBy("cid").collect() for f in ("arrow", "bounds"))
        assert a == b


@pytest.mark.parametrize("form", ["arrow", "bounds"])
def test_rounds_go_on_after_a_stop(frame, tmp_path, monkeypatch, form):
    from lodestar.operators import bounded, lloyd as module

    x = blobs(300, 3, 6, seed=5, spread=2.0)
    how = dict(init=x[:6].tolist(), tol=0.0, max_iter=9, form=form, dim=3)
    want = kmeans(frame(x.tolist()), **how)
    path = f"file://{tmp_path}/run"
    calls, owner, name = [], (bounded.BoundedStats, "__call__") if form == "bounds" else (module, "collect_stats"), None
    real = getattr(*owner)

    def fails(*a, **k):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("the driver is gone")
        return real(*a, **k)

    monkeypatch.setattr(*owner, fails)
    with pytest.raises(RuntimeError, match="gone"):
        kmeans(frame(x.tolist()), resume=path, **how)
    (tmp_path / "run" / "round=4").mkdir()  # begun, not committed
    got = kmeans(frame(x.tolist()), resume=path, **how)
    rounds = want.trace.count()
    assert len(calls) == rounds + 1 > 4  # three rounds, the failure, and only the rest
    for a, b in zip(want.trace.orderBy("iter").collect(), got.trace.orderBy("iter").collect(), strict=True):
        assert (a.iter, a.clusters) == (b.iter, b.clusters) and b.delta == pytest.approx(a.delta) and b.sse == pytest.approx(a.sse)
    again = kmeans(frame(x.tolist()), resume=path, **how)  # all rounds are there
    assert len(calls) == rounds + 1 and again.centers.orderBy("cid").collect() == got.centers.orderBy("cid").collect()
    with pytest.raises(ValueError, match="other centres"):
        kmeans(frame(x.tolist()), **{**how, "init": x[:4].tolist()}, resume=path)
