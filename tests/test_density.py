import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import density, plane
from lodestar.operators.density import _tile_sum, density_seed, density_stats, kmeans_density, pair_distance_sum
from lodestar.operators.plane import plane_distance_sum
from lodestar.plans import physical
from lodestar.sources import first_rows
from models import blobs, density_seeds, lloyd, sq


def test_pair_sum_brute_force(frame):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).sum()
    assert pair_distance_sum(frame(x.tolist()), block_rows=25) == pytest.approx(want, rel=1e-12)


def plane_shapes():
    rng = np.random.default_rng(8)
    yield "uniform", rng.random((1500, 2))
    yield "lines", np.column_stack([rng.random(1500) * 11000 - 1000, rng.integers(0, 25, 1500)])
    yield "copies", np.repeat(rng.normal(size=(300, 2)), 5, axis=0)
    yield "two scales", np.concatenate([rng.normal(size=(700, 2)) * 1e-3, rng.normal(size=(700, 2)) * 5])


@pytest.mark.parametrize("name,x", list(plane_shapes()), ids=[n for n, _ in plane_shapes()])
def test_pair_sum_in_the_plane(spark, name, x):
    values = spark.createDataFrame(x.tolist(), "x double, y double")
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).sum()
    assert plane_distance_sum(values, x.min(0).tolist(), x.max(0).tolist(), pairs=1 << 12) == pytest.approx(want, rel=1e-13)


def test_odd_rows_take_no_part_in_the_plane(spark):
    x = np.random.default_rng(3).random((400, 2)).tolist()
    odd = [(i, v) for i, v in enumerate([*x, None, [1.0], [1.0, None], [1.0, 2.0, 3.0]])]
    points = spark.createDataFrame(odd, "id bigint, features array<double>")
    a = np.array(x)
    want = np.sqrt(((a[:, None] - a[None]) ** 2).sum(-1)).sum()
    assert pair_distance_sum(points, dim=2, plane_rows=10) == pytest.approx(want, rel=1e-13)


def test_points_that_squares_cannot_part(spark):
    x = np.concatenate([np.random.default_rng(9).normal(size=(1200, 2)), [[1e13, 0.0]]])
    values = spark.createDataFrame(x.tolist(), "x double, y double")
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).sum()
    assert plane_distance_sum(values, x.min(0).tolist(), x.max(0).tolist(), pairs=1 << 18) == pytest.approx(want, rel=1e-13)


def test_one_far_point_makes_no_block_of_all_others(spark, monkeypatch):
    rng, far = np.random.default_rng(10), 1e13
    x = np.concatenate([rng.normal(size=(600, 2)), rng.normal(size=(40, 2)) + [0.0, far / 2], [[far, 0.0]]])
    x = np.concatenate([x, x[:100]])
    values = spark.createDataFrame(x.tolist(), "x double, y double")
    compared, blocks = [], plane._blocks_sum

    def spy(pts, left):
        compared.extend(r.na * r.nb for r in left.select("na", "nb").collect())
        return blocks(pts, left)

    monkeypatch.setattr(plane, "_blocks_sum", spy)
    monkeypatch.setattr(plane, "BLOCK_PAIRS", 1 << 13, raising=False)
    got = plane_distance_sum(values, x.min(0).tolist(), x.max(0).tolist(), pairs=1 << 10)
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).sum()
    assert got == pytest.approx(want, rel=1e-13) and max(compared, default=0) <= 1 << 13


def test_neighbouring_squares_with_trees_of_their_own(spark):
    x = np.random.default_rng(11).normal(size=(300, 2))
    at = (x[:, 0] > 0) * 1 + (x[:, 1] > 0) * 2
    rows = [(int(z), *map(float, p), 1.0) for z, p in zip(at, x)]
    pts = spark.createDataFrame(rows, "z bigint, x double, y double, n double")
    kept = [(0, 0), (1, 1), (0, 1), (1, 3), (2, 3)]  # the others were done by blocks
    left = spark.createDataFrame(kept, "a bigint, b bigint")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = sum((1 if a == b else 2) * d[np.ix_(at == a, at == b)].sum() for a, b in kept)
    assert plane._own_trees(pts, left, 1 << 12) == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("odd", [float("nan"), float("inf")])
def test_values_without_a_distance_need_no_pairs(frame, monkeypatch, odd):
    points = frame([[float(i), 1.0] for i in range(30)] + [[odd, 0.0]])
    assert np.isnan(pair_distance_sum(points, dim=2))
    monkeypatch.setattr(density, "tiles", None)
    assert np.isnan(pair_distance_sum(points, dim=2, plane_rows=10))


@pytest.mark.parametrize("shift", [0.0, 1e3])
def test_tile_sum_by_matrix_products(monkeypatch, shift):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(700, 16)), rng.normal(size=(300, 16)) * 1e-6 + 3]) + shift
    x = np.concatenate([x, x[:100]])  # equal vectors, too
    got, y = _tile_sum(x, x), x[::-1].copy()
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).sum()
    assert got == pytest.approx(want, rel=1e-13) and _tile_sum(y, x[:0]) == 0.0
    monkeypatch.setattr(physical, "sq_dists", None)  # the passes over dimensions aren't used
    assert _tile_sum(y, x) == pytest.approx(want, rel=1e-13)
    assert np.isnan(_tile_sum(np.full((1, 16), np.nan), x))


@pytest.mark.parametrize("n,d,t2,weight", [(150, 4, 1.5, "reference"), (178, 13, 6.0, "reference"), (60, 2, 0.8, "density"), (47, 35, 9.0, "reference")])
def test_seeds_against_model(frame, n, d, t2, weight):
    x = blobs(n, d, 4, seed=n, spread=0.8)
    s = density_seed(first_rows(frame(x.tolist()), 70), t2, weight=weight)
    chosen, dens = density_seeds(x[:70], t2, weight=weight)
    assert [r[1] for r in s.rows] == chosen and [r[3] for r in s.rows] == dens
    assert s.centers == x[chosen].tolist()


def test_density_kmeans_against_model(frame):
    x = blobs(150, 4, 3, seed=12)
    res = kmeans_density(frame(x.tolist()), tol=0.01, max_iter=10, sample_n=70, sample="first")
    t2 = np.sqrt(np.sqrt(sq(x, x)).sum()) * 0.011
    assert res.radius.first().t2 == pytest.approx(t2)
    chosen, _ = density_seeds(x[:70], t2)
    assert [r.seq for r in res.seeds.orderBy("cid").collect()] == chosen
    c, rounds, sizes, sse = lloyd(x, x[chosen], 0.01, 10)
    assert res.trace.count() == rounds
    agg = res.assignments.groupBy("cid").agg(F.count("*").alias("n"), F.sum("d2").alias("s")).orderBy("cid").collect()
    assert [r.n for r in agg] == sizes and sum(r.s for r in agg) == pytest.approx(sse)


def test_given_radius_skips_the_pair_sum(frame):
    res = kmeans_density(frame([[0.0], [0.1], [9.0]]), t2=2.0, sample_n=3, max_iter=2)
    assert res.radius.first().t2 == 2.0 and res.centers.count() == 2


def test_density_weight_option(spark, frame):
    pts = frame([[0.0], [0.1], [0.2], [5.0], [5.1], [9.0]])
    s = density_seed(first_rows(pts, 6), 0.5, weight="density")
    # densities (squared distance <= 0.5): 3, 3, 3, 2, 2, 1 -> first centre 0.0;
    # 0.1 and 0.2 are covered; at 5.0 the weights are 2000 (5.0), 2040 (5.1),
    # 0 (9.0, alone) -> 5.1; at 9.0 the weights are 40 (5.0) and 0 -> 5.0.
    assert s.centers == [[0.0], [5.1], [5.0]]


def test_odd_rows_take_no_part(spark):
    whole = [(i, [float(i), float(i * i % 7)]) for i in range(12)]
    odd = [(20, None), (21, [3.0]), (22, [None, 1.0]), (23, [1.0, 2.0, 3.0]), (24, [])]
    want = spark.createDataFrame(whole, "id bigint, features array<double>")
    a = kmeans_density(want, sample_n=10, max_iter=3)
    for rows in (odd + whole, whole + odd):  # an odd row first decides nothing
        df = spark.createDataFrame(rows, "id bigint, features array<double>")
        assert pair_distance_sum(df, dim=2) == pytest.approx(pair_distance_sum(want))
        st = density_stats(df.selectExpr("cast(id as int) as seq", "id", "features"), 9.0, dim=2)
        assert st.count() == 12 and st.agg({"density": "sum"}).first()[0] == density_stats(want.selectExpr("cast(id as int) as seq", "id", "features"), 9.0).agg({"density": "sum"}).first()[0]
        b = kmeans_density(df, sample_n=10, max_iter=3, dim=2)
        assert b.radius.first()[0] == pytest.approx(a.radius.first()[0])
        assert sorted(map(tuple, b.seeds.select("cid", "id").collect())) == sorted(map(tuple, a.seeds.select("cid", "id").collect()))
        assert b.assignments.count() == 12
        with pytest.raises(ValueError, match="width"):
            pair_distance_sum(df)


@pytest.mark.parametrize("block_rows", [20_000, 7])
def test_one_dimension_by_sorting(frame, block_rows):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 100, 300), np.full(200, 5.0), [1e6, -1e6]])
    want = np.abs(x[:, None] - x[None]).sum()
    assert pair_distance_sum(frame(x[:, None].tolist(), parts=3), block_rows) == pytest.approx(want, rel=1e-12)
    assert pair_distance_sum(frame([[4.0]]), block_rows) == 0.0 and pair_distance_sum(frame([[4.0], [4.0]]), block_rows) == 0.0
    assert pair_distance_sum(frame([[4.0]]).where("id > 5"), block_rows, dim=1) == 0.0
