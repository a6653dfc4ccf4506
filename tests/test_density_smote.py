import itertools

import numpy as np
from pyspark.sql import functions as F

from churnspark.operators import density as DB
from churnspark.operators import sampling as M


def _brute_noise(pts, eps, k, metric):
    n = len(pts)
    def d(a, b):
        diff = np.abs(a - b)
        return diff.sum() if metric == "manhattan" else (np.sqrt((diff ** 2).sum()) if metric == "euclidean" else diff.max())
    dist = np.array([[d(pts[i], pts[j]) for j in range(n)] for i in range(n)])
    core = (dist <= eps).sum(1) >= k
    return {i for i in range(n) if not core[i] and not ((dist[i] <= eps) & core).any()}


def test_dbscan_noise_matches_brute_force_with_duplicates(spark):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.random((60, 2)), np.tile([[0.5, 0.5]], (25, 1)), rng.random((15, 2)) * 0.1])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "k long, a double, b double")
    scaled = (pts - pts.min(0)) / (pts.max(0) - pts.min(0))
    for metric in ("manhattan", "euclidean", "chebyshev"):
        for eps in (0.05, 0.12):
            got = {r["k"] for r in DB.noise_points(df, "k", eps, metric, 5).collect()}
            assert got == _brute_noise(scaled, eps, 5, metric), (metric, eps)


def test_eps_table_consistent_with_noise_points(spark):
    rng = np.random.default_rng(1)
    pts = rng.random((120, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "k long, a double, b double")
    table, best = DB.search_eps(df, "k", "manhattan", 5, 0.02, 0.02, 1.0)
    rows = table.collect()
    for r in rows[:: max(1, len(rows) // 4)]:
        n_noise = DB.noise_points(df, "k", r["eps"], "manhattan", 5).count()
        assert abs(r["percentage_outliers(%)"] - round(100 * n_noise / 120, 2)) < 1e-9
    assert rows[-1]["percentage_outliers(%)"] == 0.0 or len(rows) == 50


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 0, float(a), float(b)) for i, (a, b) in enumerate(rng.random((80, 2)))]
    rows += [(100 + i, 1, float(a), float(b)) for i, (a, b) in enumerate(rng.random((12, 2)) * 0.3)]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double")
    out = M.smote(df, "y", "k", ["a", "b"], k=5, seed=42)
    counts = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 80, 1: 80}
    syn = out.where(F.col("k").isNull()).collect()
    assert len(syn) == 68
    assert all(0 <= r["a"] <= 0.3 + 1e-12 and 0 <= r["b"] <= 0.3 + 1e-12 for r in syn)   # inside the minority hull box


def test_dbscan_with_a_third_of_rows_identical(spark):
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.random((100, 2)), np.tile([[0.2, 0.7]], (50, 1))])   # 50 of 150 rows are one point
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "k long, a double, b double")
    scaled = (pts - pts.min(0)) / (pts.max(0) - pts.min(0))
    got = {r["k"] for r in DB.noise_points(df, "k", 0.06, "manhattan", 5).collect()}
    assert got == _brute_noise(scaled, 0.06, 5, "manhattan")
    table, _ = DB.search_eps(df, "k", "manhattan", 5, 0.02, 0.02, 1.0)
    for r in table.collect()[:5]:
        exp = len(_brute_noise(scaled, r["eps"], 5, "manhattan"))
        assert abs(r["percentage_outliers(%)"] - round(100 * exp / 150, 2)) < 1e-9


def test_smote_with_a_hot_copy_group(spark):
    rng = np.random.default_rng(4)
    rows = [(i, 0, float(a), float(b)) for i, (a, b) in enumerate(rng.random((90, 2)))]
    rows += [(100 + i, 1, 0.1, 0.1) for i in range(10)]                       # ten identical minority rows
    rows += [(200 + i, 1, float(a), float(b)) for i, (a, b) in enumerate(rng.random((5, 2)) * 0.2)]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double")
    out = M.smote(df, "y", "k", ["a", "b"], k=5, seed=7)
    counts = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 90, 1: 90}
    syn = out.where(F.col("k").isNull()).collect()
    assert all(0 <= r["a"] <= 0.2 + 1e-12 and 0 <= r["b"] <= 0.2 + 1e-12 for r in syn)
