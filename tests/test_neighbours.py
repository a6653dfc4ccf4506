"""Exact nearest neighbours against all pairs: every metric, any density, small leaves so that points must visit others."""
import numpy as np
import pytest

from churnspark.operators import density as DB
from churnspark.operators import neighbours as NB


def table(spark, pts, ids=None):
    ids = range(len(pts)) if ids is None else ids
    cols = [f"f{j}" for j in range(pts.shape[1])]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in zip(ids, pts)], ["__id", *cols]), cols


def check(spark, pts, k, metric, **more):
    df, cols = table(spark, pts)
    got = {}
    for r in NB.nearest_neighbours(df, cols, k, metric, **more).collect():
        got.setdefault(r["p"], {})[r["rank"]] = (r["q"], r["d"])
    d = NB.metric_of(metric, more.get("p", 2.0)).distance(pts, pts)
    for i in range(len(pts)):
        order = [j for j in np.lexsort((np.arange(len(pts)), d[i])) if j != i][:k]
        mine = got.get(i, {})
        assert sorted(mine) == list(range(1, len(order) + 1))
        assert [mine[r + 1][0] for r in range(len(order))] == order, (metric, i)
        assert np.allclose([mine[r + 1][1] for r in range(len(order))], d[i][order], atol=1e-9)


def clumps(rng, dims):
    """Densities a million times apart and one far point."""
    return np.vstack([rng.random((150, dims)), rng.random((300, dims)) * 1e-6 + 0.3, rng.random((60, dims)) * 1e-3 + 0.7,
                      np.full((1, dims), 50.0)])


@pytest.mark.parametrize("metric", ["manhattan", "euclidean", "chebyshev", "canberra", "cosine"])
def test_neighbours_of_clumps(spark, metric):
    check(spark, clumps(np.random.default_rng(1), 3), 4, metric, leaf=40)


@pytest.mark.parametrize("metric", ["minkowski", "correlation", "hamming", "sqeuclidean", "haversine", "callable"])
def test_neighbours_by_other_metrics(spark, metric):
    pts = np.random.default_rng(2).random((160, 2 if metric == "haversine" else 4))
    if metric == "hamming":
        pts = np.floor(pts * 3)
    fn = (lambda x, y: np.sqrt(np.abs(x[:, None, :] - y[None, :, :])).sum(axis=2)) if metric == "callable" else metric
    check(spark, pts, 3, fn, leaf=30, **({"p": 3.0} if metric == "minkowski" else {}))


def test_unknown_metrics_are_named(spark):
    with pytest.raises(ValueError, match="canberra"):
        NB.metric_of("nonsense")
    with pytest.raises(ValueError, match="triangle"):
        NB.metric_of("minkowski", 0.5)


def test_neighbours_odd_tables(spark):
    df, cols = table(spark, np.array([[0.0, 0.0], [1.0, 0.0], [5.0, 0.0]]))
    got = sorted((r["p"], r["rank"], r["q"]) for r in NB.nearest_neighbours(df, cols, 5).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 1), (2, 2, 0)]  # fewer others than k
    assert NB.nearest_neighbours(df.limit(0), cols, 5).collect() == []
    assert NB.nearest_neighbours(df.limit(1), cols, 5).collect() == []
    holes = spark.createDataFrame([(1, 0.0), (2, None), (3, float("nan")), (4, 1.0)], "`__id` long, f0 double")
    assert sorted((r["p"], r["q"]) for r in NB.nearest_neighbours(holes, ["f0"], 2).collect()) == [(1, 4), (4, 1)]


def test_points_that_no_split_parts(spark):
    """One direction, many lengths: a single place for the cosine distance, dealt out by hash."""
    pts = np.outer(np.arange(1.0, 301.0), [1.0, 2.0])
    df, cols = table(spark, pts)
    out = NB.nearest_neighbours(df, cols, 3, "cosine", leaf=20).collect()
    assert len(out) == 900 and max(r["d"] for r in out) < 1e-12


@pytest.mark.parametrize("metric", ["canberra", "cosine"])
def test_noise_by_other_metrics(spark, metric):
    pts = np.random.default_rng(5).random((120, 2))
    scaled = (pts - pts.min(0)) / (pts.max(0) - pts.min(0))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "k long, a double, b double")
    d = NB.metric_of(metric).distance(scaled, scaled)
    eps = float(np.quantile(d, 0.03))
    core = (d <= eps).sum(1) >= 5
    want = {i for i in range(len(pts)) if not core[i] and not ((d[i] <= eps) & core).any()}
    assert {r["k"] for r in DB.noise_points(df, "k", eps, metric, 5).collect()} == want and want


def test_eps_search_with_a_far_outlier(spark):
    rng = np.random.default_rng(6)
    pts = np.vstack([rng.random((200, 2)) * 1e-7, [[1.0, 1.0]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "k long, a double, b double")
    t, _ = DB.search_eps(df, "k", "manhattan", 5, 0.05, 0.02, 5.0)
    rows = t.collect()
    assert {r["percentage_outliers(%)"] for r in rows[:-1]} == {0.5} and rows[-1]["percentage_outliers(%)"] == 0.0
    assert abs(rows[-1]["eps"] - 2.0) < 1e-9
