import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnspark.operators.series import series_features

ROWS = [  # id, price_date, seq, p1, p2  (out of order, tied dates, NULL and NaN, single-row id, constant)
    ("a", "2015-03-01", 3, 3.0, 1.0), ("a", "2015-01-01", 1, 1.0, 1.0), ("a", "2015-02-01", 2, 2.5, 1.0),
    ("a", "2015-03-01", 4, 9.0, 1.0),
    ("b", "2015-01-01", 5, 5.0, None), ("b", "2015-02-01", 6, 4.0, 2.0),
    ("c", "2015-06-01", 7, 7.0, 7.0),
    ("d", "2015-01-01", 8, 1.0, float("nan")), ("d", "2015-01-01", 9, 2.0, 3.0), ("d", "2015-01-02", 10, 2.0, 4.0),
]


def pandas_oracle(rows, cols):
    pdf = pd.DataFrame(rows, columns=["id", "price_date", "seq", *cols]).sort_values("seq")
    out = {}
    for k, g in pdf.groupby("id"):
        g = g.sort_values(["price_date", "seq"], kind="mergesort")
        r = {}
        for c in cols:
            x = g[c].astype(float)
            r[f"mean_{c}"] = x.mean()
            r[f"std_{c}"] = x.std()
            last = g.loc[g["price_date"] == g["price_date"].max()].iloc[0][c]
            first = g.loc[g["price_date"] == g["price_date"].min()].iloc[0][c]
            r[f"last_{c}"] = last
            r[f"difference_{c}"] = last - first
            xs = x.to_numpy()
            if len(xs) >= 2 and not np.isnan(xs).any():
                i = np.arange(len(xs))
                r[f"{c}_slope"] = np.polyfit(i, xs, 1)[0]
            else:
                r[f"{c}_slope"] = float("nan")
        out[k] = r
    return out


def close(a, b):
    na = a is None or (isinstance(a, float) and math.isnan(a))
    nb = b is None or (isinstance(b, float) and math.isnan(b))
    return (na and nb) or (not na and not nb and abs(a - b) <= 1e-9 * max(1.0, abs(b)))


@pytest.mark.parametrize("skew_safe", [True, False])
def test_series_matches_pandas(spark, skew_safe):
    df = spark.createDataFrame(ROWS, "id string, price_date string, seq long, p1 double, p2 double")
    got = {r["id"]: r.asDict() for r in series_features(df, ["p1", "p2"], "id", "price_date", ["seq"],
                                                        skew_safe=skew_safe, n_parts=3).collect()}
    exp = pandas_oracle(ROWS, ["p1", "p2"])
    assert set(got) == set(exp)
    for k, r in exp.items():
        for name, v in r.items():
            assert close(got[k][name], v), (k, name, got[k][name], v)


def test_hot_key_split_over_partitions(spark):
    """One id holds a third of the rows: the skew-safe path must equal the window path."""
    rng = np.random.default_rng(1)
    rows = [("hot", f"2020-01-{1 + i % 28:02d}", i, float(rng.normal())) for i in range(3000)]
    rows += [(f"k{i % 200}", f"2020-02-{1 + i % 28:02d}", 10_000 + i, float(rng.normal())) for i in range(6000)]
    df = spark.createDataFrame(rows, "id string, d string, seq long, v double")
    a = {r["id"]: r for r in series_features(df, ["v"], "id", "d", ["seq"], skew_safe=True, n_parts=16).collect()}
    b = {r["id"]: r for r in series_features(df, ["v"], "id", "d", ["seq"], skew_safe=False).collect()}
    for k in b:
        for c in ("mean_v", "std_v", "last_v", "difference_v", "v_slope"):
            assert close(a[k][c], b[k][c]), (k, c)


def test_families_and_differences(spark):
    df = spark.createDataFrame(ROWS, "id string, price_date string, seq long, p1 double, p2 double")
    out = series_features(df, ["p1", "p2"], "id", "price_date", ["seq"], families={"m": ["p1", "p2"]},
                          differences={"dd": ("p1", "p2")})
    r = {x["id"]: x for x in out.collect()}
    assert close(r["b"]["m"], (4.5 + 2.0) / 2)
    assert close(r["b"]["dd"], 4.5 - 2.0)
    assert out.columns[:6] == ["id", "mean_p1", "mean_p2", "m", "dd", "last_p1"]
