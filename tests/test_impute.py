"""The imputer against a plain round-robin of ridges over numpy rows."""
import math

import numpy as np
import pytest

from churnspark.operators import impute as I


def plain(x, max_iter=10, tol=1e-3):
    """Rows of numbers with nan holes -> filled rows, one target after the other, row by row data."""
    gone = np.isnan(x)
    targets = sorted((j for j in range(x.shape[1]) if gone[:, j].any()), key=lambda j: gone[:, j].sum())
    enough = tol * np.nanmax(np.abs(x))
    z = np.where(gone, np.nanmean(x, axis=0), x)
    for _ in range(max_iter):
        before = z.copy()
        for t in targets:
            others = [j for j in range(x.shape[1]) if j != t]
            seen = ~gone[:, t]
            a, y = z[seen][:, others], z[seen, t]
            m = a.mean(axis=0)
            c = a - m
            coef, _ = I.bayesian_ridge(len(y), np.zeros(len(others)), 0.0, c.T @ c, c.T @ (y - y.mean()), ((y - y.mean()) ** 2).sum())
            z[~seen, t] = y.mean() + (z[~seen][:, others] - m) @ coef
        if np.abs(z - before).sum(axis=1).max() < enough:
            break
    return z


@pytest.fixture(scope="module")
def holes():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + [0, 10, -3, 1000]
    x[rng.random(x.shape) < 0.15] = np.nan
    return x


def frame(spark, x):
    rows = [(i, *[None if math.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)], "s") for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, `b.c` double, d double, `e f` double, other string").repartition(3)


@pytest.mark.parametrize("most", [I.MAX_NUMBERS, 0])
def test_imputer_matches_row_by_row_rounds(spark, holes, monkeypatch, most):
    monkeypatch.setattr(I, "MAX_NUMBERS", most)  # 0: one scan per target
    df = frame(spark, holes)
    out = I.iterative_impute(df, predictors=["a", "b.c", "d", "e f"], max_iter=4 if not most else 10)
    assert out.columns == df.columns
    got = np.array([[r[c] for c in ("a", "b.c", "d", "e f")] for r in out.orderBy("id").collect()])
    want = plain(holes, max_iter=4 if not most else 10)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-7)
    seen = ~np.isnan(holes)
    assert np.allclose(got[seen], holes[seen], rtol=0, atol=0)
    assert {r["other"] for r in out.collect()} == {"s"}


def test_imputer_odd_frames(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a long, b double, c string")
    assert [tuple(r) for r in I.iterative_impute(df).orderBy("a").collect()] == [(1, 0.0, "x"), (2, 0.0, None)]
    full = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert I.iterative_impute(full).collect() == full.collect()
    assert I.iterative_impute(full.limit(0)).collect() == []
    words = spark.createDataFrame([("x",)], "a string")
    assert I.iterative_impute(words).collect() == words.collect()
