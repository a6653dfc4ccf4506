"""Radix selection, decisions from bounds, pipeline signatures, tabled Tree SHAP, counts of dropped rows."""
import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from churnspark.operators import encode as G
from churnspark.operators import explain as X
from churnspark.operators import outliers as O
from churnspark.operators import profile as P
from churnspark.operators import prune as PR
from churnspark.operators import selection as S
from churnspark.sources import io as IO


def test_bits_keep_the_order():
    x = np.array([-np.inf, -1e300, -2.5, -1.0, -5e-324, 0.0, 5e-324, 1e-10, 1.0, 2.5, 1e300, np.inf])
    k = S.ordered_bits(x)
    assert (k[1:] > k[:-1]).all()
    assert [S.from_bits(int(v)) for v in k] == list(x)
    assert S.ordered_bits(np.array([-0.0]))[0] == S.ordered_bits(np.array([0.0]))[0]


def test_quantiles_of_many_shapes(spark):
    rng = np.random.default_rng(1)
    n = 3001
    cols = {"normal": rng.normal(size=n), "heavy": np.exp(rng.normal(size=n) * 40), "whole": rng.integers(0, 7, n).astype(float),
            "one": np.full(n, 3.5), "tiny": rng.random(n) * 1e-300, "signs": np.where(rng.random(n) < .5, -0.0, 0.0),
            "ends": np.r_[[-1e308, 1e308], rng.random(n - 2)]}
    holes = rng.random(n) < 0.2
    rows = [tuple(None if holes[i] and c == "normal" else math.nan if holes[i] and c == "heavy" else float(v[i]) for c, v in cols.items())
            for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = S.column_quantiles(df, {c: F.when(~F.isnan(c), F.col(c)) for c in cols}, qs)
    for c, v in cols.items():
        kept = v[~holes] if c in ("normal", "heavy") else v
        assert np.allclose([got[c][q] for q in qs], np.quantile(kept, qs), rtol=1e-12, atol=0), c


def test_quantiles_of_empty_and_single_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    got = S.column_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.5])
    assert got == {"a": {0.5: None}, "b": {0.5: 1.0}}
    assert S.column_quantiles(df, {}, [0.5]) == {}


def test_thresholds_shuffle_no_values(spark):
    df = spark.range(2000).select((F.col("id") % 97).cast("double").alias("a b"), F.sqrt("id").alias("c.d"))
    rows = {r["feature"]: r for r in O.outlier_thresholds(df, ["a b", "c.d"]).collect()}
    assert rows["a b"]["q_1"] == np.quantile(np.arange(2000) % 97, 0.25)
    assert abs(rows["c.d"]["q_3"] - np.quantile(np.sqrt(np.arange(2000)), 0.75)) < 1e-12
    profile = {r["feature"]: r for r in P.univariate_profile(df).collect()}
    assert profile["a b"]["unique"] == 97 and profile["c.d"]["median"] == pytest.approx(np.quantile(np.sqrt(np.arange(2000)), 0.5))


def test_prune_decisions_match_exact_counts(spark):
    n = 4000
    df = spark.range(n).select(
        "id", F.col("id").cast("string").alias("all_differ"), F.lit("x").alias("one_value"),
        F.when(F.col("id") % 50 == 0, F.col("id")).cast("string").alias("mostly_missing"), (F.col("id") % 10).cast("string").alias("few"),
        F.least(F.col("id"), F.lit(3801)).cast("string").alias("just_over"), F.least(F.col("id"), F.lit(3798)).cast("string").alias("just_under"),
        F.when(F.col("id") > 5, F.lit(True)).alias("flag"), F.create_map(F.lit("a"), F.lit(1)).cast("string").alias("text_map"))
    assert set(PR.low_information_columns(df)) == {"all_differ", "one_value", "mostly_missing", "just_over", "flag", "text_map"}
    assert PR.low_information_columns(df.limit(0)) == []


def test_scaled_columns_have_three_values(spark):
    df = spark.createDataFrame([(0.0, 1.0, 5.0, None, 1.0), (1.0, 2.0, 5.0, None, 2.0), (0.0, 3.0, 5.0, None, math.nan)],
                               "two double, three double, one double, none double, two_and_nan double")
    dt = {f.name: f.dataType for f in df.schema.fields}
    assert G.more_than_two_values(df, df.columns, dt) == ["three"]


def test_dropped_rows_are_counted(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 3.0), (4, math.nan), (None, None)], "a long, b double")
    assert PR.missing_rows(df).collect()[0].asDict() == {"rows": 4, "dropped": 3, "kept": 1}
    kept, seen = PR.drop_missing_observed(df)
    assert kept.count() == 1 and seen.get == {"rows": 4, "dropped": 3}


def test_saved_pipelines_refuse_other_frames(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), "ab"[i % 2]) for i in range(20)], "k long, x double, c string")
    model = Pipeline(stages=[G.ScaleEncode(exclude=["k"])]).fit(df)
    path = str(tmp_path / "signed")
    IO.save_pipeline(model, path, example=df, allowed=["label"])
    again = IO.load_pipeline(path, like=df)
    assert again.transform(df).columns == model.transform(df).columns
    assert again.transform(df.withColumn("label", F.lit(1))).count() == 20
    for bad, word in ((df.drop("x"), "missing: x"), (df.withColumn("x", F.col("x").cast("string")), "retyped: x"),
                      (df.withColumn("more", F.lit(1)), "extra: more")):
        with pytest.raises(IO.SignatureError, match=word):
            again.transform(bad)
        with pytest.raises(IO.SignatureError, match=word):
            IO.load_pipeline(path, like=bad)


def test_digest_notices_a_changed_dataset(spark, tmp_path):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    IO.log_dataset(df, str(tmp_path), "t", "here", "training")
    assert IO.stored_digest_matches(spark, str(tmp_path), "t")
    df.where("id <> 7").write.mode("overwrite").parquet(f"{tmp_path}/datasets/t")
    assert not IO.stored_digest_matches(spark, str(tmp_path), "t")


def shapley_by_coalitions(tree, x, n_features):
    """Path-dependent Shapley values straight from the definition: all coalitions, expectations by cover."""
    w, left, right, feat, thr, val, cov = tree

    def worth(j, known):
        if left[j] < 0:
            return val[j]
        if feat[j] in known:
            return worth(left[j] if x[feat[j]] <= thr[j] else right[j], known)
        return (cov[left[j]] * worth(left[j], known) + cov[right[j]] * worth(right[j], known)) / cov[j]
    phi = np.zeros(n_features)
    for i in range(n_features):
        others = [f for f in range(n_features) if f != i]
        for size in range(n_features):
            for s in itertools.combinations(others, size):
                share = math.factorial(size) * math.factorial(n_features - size - 1) / math.factorial(n_features)
                phi[i] += share * (worth(0, {*s, i}) - worth(0, set(s)))
    return w * phi


def random_tree(rng, n_features, depth):
    nodes = []

    def grow(level, cover):
        j = len(nodes)
        nodes.append([-1, -1, -1, 0.0, float(rng.normal()), cover])
        if level < depth and cover > 1:
            share = float(rng.uniform(0.2, 0.8))
            a = grow(level + 1, cover * share)
            b = grow(level + 1, cover * (1 - share))
            nodes[j][:4] = [a, b, int(rng.integers(n_features)), float(rng.normal())]
        return j
    grow(0, 100.0)
    left, right, feat, thr, val, cov = (np.array(c) for c in zip(*nodes))
    return 0.7, left, right, feat, thr, val, cov


@pytest.mark.parametrize("tabled", [8, 1])
def test_tabled_shap_is_the_definition(monkeypatch, tabled):
    monkeypatch.setattr(X, "TABLED", tabled)  # 1: the path for deep trees
    rng = np.random.default_rng(9)
    for depth in (0, 1, 3, 5):
        tree = random_tree(rng, 4, depth)
        x = np.vstack([rng.normal(size=(20, 4)), [[np.nan, 0.0, np.nan, 1.0]]])
        phi = np.zeros((len(x), 4))
        for leaf in X.leaves(tree):
            leaf.add(x, phi)
        want = np.array([shapley_by_coalitions(tree, r, 4) for r in x])
        assert np.allclose(phi, want, atol=1e-12)
