import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions import dist
from churnspark.operators import assoc as V
from churnspark.operators import profile as P
from churnspark.operators.kendall import kendall_many, kendall_s_and_ties, kendall_tau, tau_b_from_stats
from churnspark.operators.quantiles import exact_quantiles


def _t_sf_numeric(t, df):
    x = np.linspace(abs(t), abs(t) + 400, 400001)
    pdf = math.gamma((df + 1) / 2) / (math.sqrt(df * math.pi) * math.gamma(df / 2)) * (1 + x ** 2 / df) ** (-(df + 1) / 2)
    return 2 * np.trapezoid(pdf, x)


def test_tail_probabilities():
    assert abs(dist.t_two_sided(2.0, 10) - _t_sf_numeric(2.0, 10)) < 1e-5
    assert abs(dist.chi2_upper(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(dist.norm_two_sided(1.959963984540054) - 0.05) < 1e-12
    # F(1, d) equals t^2 with d degrees of freedom
    assert abs(dist.f_upper(4.0, 1, 12) - dist.t_two_sided(2.0, 12)) < 1e-12


def test_exact_quantiles_hot_value(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([np.full(500, 7.0), rng.normal(size=1000)])
    df = spark.createDataFrame([("f", float(v)) for v in vals] + [("g", float(v)) for v in vals[:11]], "k string, v double")
    got = {(r["k"], r["q"]): r["quantile"] for r in exact_quantiles(df, ["k"], "v", [0.1, 0.25, 0.5, 0.9]).collect()}
    for q in (0.1, 0.25, 0.5, 0.9):
        assert abs(got[("f", q)] - np.percentile(vals, q * 100)) < 1e-12
        assert abs(got[("g", q)] - np.percentile(vals[:11], q * 100)) < 1e-12


def test_profile_mode_ties_and_moments(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (2.0, "b"), (1.0, "a"), (5.0, None), (float("nan"), "c")],
                               "x double, s string")
    rows = {r["feature"]: r for r in P.univariate_profile(df, round_to=6).collect()}
    assert rows["x"]["mode"] == "1.0" and rows["s"]["mode"] == "a"
    assert rows["x"]["missing"] == 1 and rows["s"]["missing"] == 1
    x = np.array([1.0, 2.0, 2.0, 1.0, 5.0])
    n = len(x)
    m2 = ((x - x.mean()) ** 2).mean()
    g1 = ((x - x.mean()) ** 3).mean() / m2 ** 1.5
    assert abs(rows["x"]["skew"] - round(math.sqrt(n * (n - 1)) / (n - 2) * g1, 6)) < 1e-6
    assert rows["x"]["median"] == 2.0


def test_spearman_and_pearson(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, 300).astype(float)
    y = x + rng.integers(0, 5, 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    sp = V.spearman(df, "x", "y").first()
    rx = np.argsort(np.argsort(x))  # replaced by average ranks below
    import pandas as pd
    exp = pd.Series(x).rank().corr(pd.Series(y).rank())
    assert abs(sp["spearman"] - exp) < 1e-12
    pr = V.pearson_table(df, "y", ["x"]).first()
    assert abs(pr["r"] - np.corrcoef(x, y)[0, 1]) < 1e-12


def _brute_s(x, y):
    s = 0.0
    for i, j in itertools.combinations(range(len(x)), 2):
        s += np.sign(x[j] - x[i]) * np.sign(y[j] - y[i])
    return s


def test_kendall_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.integers(0, 30, 250), np.full(150, 12)]).astype(float)   # heavy tie
    y = (x * 0.3 + rng.integers(0, 10, len(x))).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    st = kendall_s_and_ties(df, "x", "y")
    assert abs(st["s"] - _brute_s(x, y)) < 1e-6
    ties = lambda v: sum(c * (c - 1) / 2 for c in np.unique(v, return_counts=True)[1])
    assert st["n"] == len(x) and st["xtie"][0] == ties(x) and st["ytie"][0] == ties(y)
    tau, p = tau_b_from_stats(st)
    assert -1 <= tau <= 1 and 0 <= p <= 1
    back = kendall_s_and_ties(df, "y", "x")   # the other column's ranks give the same sum
    assert back["s"] == st["s"] and back["xtie"] == pytest.approx(st["ytie"])


def test_kendall_many_has_one_path_for_all_features(spark):
    rng = np.random.default_rng(8)
    a, b, y = rng.normal(size=300), rng.integers(0, 4, 300).astype(float), rng.normal(size=300)
    a[:9], b[20:25] = np.nan, np.nan
    df = spark.createDataFrame([(float(p), float(q), float(r), None) for p, q, r in zip(a, b, y)],
                               "a double, `b.c` double, y double, empty double")
    got = {r["feature"]: r for r in kendall_many(df, "y", ["a", "b.c", "empty"]).collect()}
    assert set(got) == {"a", "b.c"}
    for name, v in (("a", a), ("b.c", b)):
        ok = ~np.isnan(v)
        n = int(ok.sum())
        ties = sum(c * (c - 1) / 2 for c in np.unique(v[ok], return_counts=True)[1])
        tot = n * (n - 1) / 2
        assert got[name]["n"] == n
        assert abs(got[name]["kendalltau"] - _brute_s(v[ok], y[ok]) / math.sqrt((tot - ties) * tot)) < 1e-12


def test_kendall_exact_p_small(spark):
    x = [1.0, 2.0, 3.0, 4.0, 5.0]
    y = [2.0, 1.0, 4.0, 3.0, 5.0]
    r = kendall_tau(spark.createDataFrame(list(zip(x, y)), "x double, y double"), "x", "y").first()
    assert abs(r["kendalltau"] - 0.6) < 1e-12
    assert abs(r["kendalltau_pvalue"] - 0.23333333333333334) < 1e-9   # 2 * 14/120


def test_chi2_yates_and_anova(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5
    df = spark.createDataFrame(rows, "a string, b string")
    obs = np.array([[10, 20], [30, 5]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    d = np.abs(obs - e)
    exp = (((d - np.minimum(0.5, d)) ** 2) / e).sum()
    assert abs(V.chi2_test(df, "a", "b").first()["chi2"] - exp) < 1e-9
    g = spark.createDataFrame([("p", 1.0), ("p", 2.0), ("p", 3.0), ("q", 2.0), ("q", 4.0), ("r", 9.0), ("r", 7.0)],
                              "c string, v double")
    groups = [np.array([1, 2, 3.0]), np.array([2, 4.0]), np.array([9, 7.0])]
    allv = np.concatenate(groups)
    ssb = sum(len(x) * (x.mean() - allv.mean()) ** 2 for x in groups)
    ssw = sum(((x - x.mean()) ** 2).sum() for x in groups)
    f = (ssb / 2) / (ssw / (len(allv) - 3))
    assert abs(V.anova(g, "v", "c").first()["F"] - f) < 1e-9


def test_histogram_auto_bins_like_numpy(spark):
    rng = np.random.default_rng(9)
    x = rng.lognormal(size=700)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    edges = np.histogram_bin_edges(x, bins="auto")
    counts, _ = np.histogram(x, bins=edges)
    got = {r["bin"]: r["count"] for r in P.histogram(df, "x", bins="auto").collect()}
    assert P.auto_bins(df, "x") == len(edges) - 1
    assert [got.get(i, 0) for i in range(len(counts))] == list(counts)


def test_bivariate_table_rows(spark):
    rng = np.random.default_rng(11)
    n = 60
    x = rng.normal(size=n)
    y = 0.4 * x + rng.normal(size=n)
    cat = np.where(rng.random(n) > 0.5, "u", "v")
    tgt = np.where(y > 0, "hi", "lo")
    df = spark.createDataFrame([(float(a), float(b), str(c), str(t)) for a, b, c, t in zip(x, y, cat, tgt)],
                               "x double, y double, c string, t string")
    rows = {r["feature"]: r for r in V.bivariate_table(df.select("x", "y"), "y").collect()}
    r = np.corrcoef(x, y)[0, 1]
    t = r * math.sqrt((n - 2) / (1 - r * r))
    assert rows["x"]["r"] == round(r, 3)
    assert abs(rows["x"]["pearson_pvalue"] - round(_t_sf_numeric(t, n - 2), 3)) <= 1e-3
    cc = {r["feature"]: r for r in V.bivariate_table(df.select("c", "t"), "t").collect()}
    obs = np.array([[((cat == a) & (tgt == b)).sum() for b in ("hi", "lo")] for a in ("u", "v")], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    d = np.abs(obs - e)
    assert abs(cc["c"]["chi2"] - round((((d - np.minimum(0.5, d)) ** 2) / e).sum(), 3)) <= 1e-3


def test_kendall_blocks_count_every_pair_once(spark, monkeypatch):
    """Many blocks on both sides, hot values, ties and weights: the same sum as all pairs; no row for each bit of a rank."""
    from churnspark.operators import kendall
    rng = np.random.default_rng(11)
    n = 900
    x = np.where(rng.random(n) < 0.3, 7.0, rng.integers(0, 200, n)).astype(float)
    y = np.where(rng.random(n) < 0.2, -3.0, np.round(rng.normal(size=n) + x / 100, 2))
    y[:2] = math.inf, -math.inf
    rows = [(float(a), float(b)) for a, b in zip(x, y)]
    brute = _brute_s(x, y)
    assert kendall.pair_signs(x, y, np.ones(n, np.int64)) == brute
    monkeypatch.setattr(kendall, "BLOCK", 40)  # the cells of the blocks are cut into blocks again
    df = spark.createDataFrame(rows, "x double, y double")
    assert kendall.kendall_s_and_ties(df, "x", "y")["s"] == brute
    assert kendall.kendall_s_and_ties(df, "y", "x")["s"] == brute
    heavy = kendall.kendall_s_and_ties(df.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(3)))), "x", "y")
    assert heavy["n"] == 3 * n and heavy["s"] == 9 * brute
    assert {r["feature"]: r["n"] for r in kendall.kendall_many(df.withColumn("one", F.lit(1.0)), "y", ["x", "one"]).collect()} == {"x": n, "one": n}


def test_bivariate_query_reads_a_written_customer_table(spark, sf001, monkeypatch):
    """The customers' features are made once, not once for every job."""
    from churnspark.plans import catalog_queries
    given = []
    monkeypatch.setattr(catalog_queries.V, "bivariate_table", lambda df, target: given.append(df) or df)
    catalog_queries.q_bivariate_table(spark, sf001)
    assert "Exchange" not in given[0]._jdf.queryExecution().executedPlan().toString()
