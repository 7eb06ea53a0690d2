"""Property tests (hypothesis): brute-force agreement and order invariance."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodestar import kmeans, predict
from lodestar.operators.canopy import greedy_pick, kmeans_canopy

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

small_ints = st.integers(min_value=-4, max_value=4)  # integer grids make exact ties common


def vectors(n, d):
    return st.lists(st.lists(small_ints, min_size=d, max_size=d), min_size=n, max_size=n)


@SETTINGS
@given(vectors(40, 3), vectors(5, 3))
def test_predict_matches_brute_force(frame, pts, cents):
    x, c = np.array(pts, float), np.array(cents, float)
    want = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)  # first minimum = lowest id
    for form in ("expr", "arrow"):
        got = {r.id: r.cid for r in predict(frame(pts), cents, form=form).collect()}
        assert [got[i] for i in range(len(pts))] == want.tolist()


@SETTINGS
@given(vectors(30, 2), st.randoms(use_true_random=False))
def test_kmeans_invariant_to_row_order_and_partitions(frame, pts, rnd):
    ids = list(range(len(pts)))
    order = ids[:]
    rnd.shuffle(order)
    a = kmeans(frame(pts, ids), 3, init="sample", tol=0.0, max_iter=8, distinct_seeds=False)
    b = kmeans(frame([pts[i] for i in order], order, parts=4), 3, init="sample", tol=0.0, max_iter=8)
    ca = [[round(v, 9) for v in r.center] for r in a.centers.orderBy("cid").collect()]
    cb = [[round(v, 9) for v in r.center] for r in b.centers.orderBy("cid").collect()]
    assert ca == cb


@SETTINGS
@given(vectors(25, 2))
def test_canopy_local_pass_matches_sequential_model(frame, pts):
    x = np.array(pts, float)
    model = []
    for i, v in enumerate(x):  # the greedy rule written out plainly
        if all(np.sqrt(((v - x[j]) ** 2).sum()) > 2.0 for j in model):
            model.append(i)
    assert greedy_pick(x, 2.0) == model
    r = kmeans_canopy(frame(pts), 2.0, 1.5, 2.0, buckets=1, distinct=False)
    got = [int(c.id) for c in r.canopies.orderBy("canopy").collect()]
    assert got == model  # one bucket: the global merge keeps all local centres
