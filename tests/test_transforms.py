import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions import dates as D
from churnspark.functions.exprs import try_parse_date
from churnspark.operators import encode as G
from churnspark.operators import outliers as O
from churnspark.operators import skew as K
from churnspark.operators.impute import bayesian_ridge


def test_date_layouts_and_invalid(spark):
    vals = ["2016-01-05", "05-01-2016", "01/05/2016", "5 Jan 2016", "January 5, 2016",
            "2016-02-30", "", " 2016-01-05", "16-01-05", None, "not a date"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r["d"] for r in df.select(try_parse_date("s").alias("d")).collect()]
    jan5 = dt.date(2016, 1, 5)
    assert got == [jan5] * 5 + [None] * 6
    f = df.select(D.parse_and_format(F.col("s"), "%d/%m/%Y").alias("x")).first()["x"]
    assert f == "05/01/2016"


def test_contract_features_and_floor_days(spark):
    df = spark.createDataFrame([("2019-01-01", "2021-01-01", "2019-06-01", "2019-12-31")],
                               "date_activ string, date_end string, date_modif_prod string, date_renewal string")
    cols = ["date_activ", "date_end", "date_modif_prod", "date_renewal"]
    r = D.ContractDateFeatures(dateColumns=cols).transform(df).first()
    assert (r["contract_length"], r["days_until_end"], r["days_until_renewal"], r["days_since_modification"]) == (731, -366, 1, 214)
    ts = spark.createDataFrame([(dt.datetime(2020, 1, 1, 12),)], "t timestamp_ntz")
    out = D.date_columns(ts, ["t"], reference_date="2020-01-01").first()
    assert out["actual_date - t in days"] == -1 and out["t_weekday"] == "Wednesday"


def test_thresholds_and_capping(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=200), [50.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    m = O.ReplaceOutliers().fit(df)
    lo, hi = m.fitted["x"]
    q1, q3 = np.percentile(x, [25, 75])
    assert abs(lo - (q1 - 1.5 * (q3 - q1))) < 1e-9 and abs(hi - (q3 + 1.5 * (q3 - q1))) < 1e-9  # skewed -> Tukey
    capped = [r["x"] for r in m.transform(df).collect()]
    assert max(capped) <= hi + 1e-12 and min(capped) >= lo - 1e-12


def test_scale_encode_fit_on_train_reuse_on_test(spark):
    train = spark.createDataFrame([(1.0, "a", 0), (2.0, "b", 1), (3.0, "a", 0), (4.0, None, 1)], "x double, c string, f int")
    test = spark.createDataFrame([(10.0, "z", 1)], "x double, c string, f int")
    m = G.ScaleEncode().fit(train)
    a, b = m.transform(train), m.transform(test)
    assert a.columns == b.columns == ["x", "f", "c_a", "c_b"]
    r = b.first()
    assert r["c_a"] == 0.0 and r["c_b"] == 0.0 and r["f"] == 1          # unseen -> zeros, binary untouched
    assert abs(r["x"] - (10 - 2.5) / np.std([1, 2, 3, 4.0])) < 1e-12     # population std


def test_yeo_lambda_matches_fine_grid(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.lognormal(size=400), -rng.lognormal(size=50)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = K.fit_yeo_lambdas(df, ["x"])["x"]

    def yj(v, l):
        pos, neg = v >= 0, v < 0
        out = np.empty_like(v)
        out[pos] = np.log1p(v[pos]) if abs(l) < 1e-12 else ((v[pos] + 1) ** l - 1) / l
        out[neg] = -np.log1p(-v[neg]) if abs(l - 2) < 1e-12 else -((1 - v[neg]) ** (2 - l) - 1) / (2 - l)
        return out

    grid = np.linspace(-2, 2, 40001)
    ll = [-len(x) / 2 * np.log(yj(x, l).var()) + (l - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum() for l in grid]
    assert abs(lam - grid[int(np.argmax(ll))]) < 2e-4


def test_reduce_skew_binary_and_power(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v), float(w)) for v, w in zip(rng.lognormal(size=500), rng.normal(size=500))],
                               "a double, b double")
    m = K.ReduceSkew().fit(df)
    ch = m.fitted["choices"]
    assert "a" in ch and "b" not in ch
    out = m.transform(df)
    assert out.columns == ["a", "b"]


def test_bayesian_ridge_recovers_line():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(500, 2))
    y = 3 * X[:, 0] - 2 * X[:, 1] + 1 + rng.normal(scale=0.01, size=500)
    coef, icpt = bayesian_ridge(len(y), X.sum(0), y.sum(), X.T @ X, X.T @ y, y @ y)
    assert np.allclose(coef, [3, -2], atol=1e-2) and abs(icpt - 1) < 1e-2


def test_columns_with_equal_bounds_are_not_capped(spark):
    df = spark.createDataFrame([(1 if i % 10 == 0 else 0, float(i % 7), 7.0) for i in range(200)] + [(0, 900.0, 7.0)], "flag int, x double, same double")
    m = O.ReplaceOutliers().fit(df)
    out = m.transform(df)
    assert out.agg(F.sum("flag")).first()[0] == 20 and out.agg(F.max("x")).first()[0] < 900
    assert set(m.fitted) == {"x"}


def test_timestamps_in_iso_layouts(spark):
    vals = ["2016-01-05T10:00:00", "2016-01-05 10:00:00.25", "2016-01-05T10:00:00.250", "2016-01-05 10:00", "2016-01-05", "2016-13-05T10:00:00", "T10:00:00", "10:00", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(D.coerce_timestamp(df, "s")).collect()]
    ten, part = dt.datetime(2016, 1, 5, 10), dt.datetime(2016, 1, 5, 10, 0, 0, 250_000)
    assert got == [ten, part, part, ten, dt.datetime(2016, 1, 5), None, None, None, None]


def test_timestamps_with_slashes(spark):
    vals = ["2016/01/05 10:00", "2016/1/5", "2016/01/05 10:00:00.5", "1/5/2016 10:00", "01/05/2016 10:00:30", "13/45/2016 10:00", "2016/13/05 10:00", "5/2016"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(D.coerce_timestamp(df, "s")).collect()]
    ten = dt.datetime(2016, 1, 5, 10)
    assert got == [ten, dt.datetime(2016, 1, 5), ten.replace(microsecond=500_000), ten, ten.replace(second=30), None, None, None]
