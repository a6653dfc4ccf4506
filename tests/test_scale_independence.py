"""Results that must not depend on the input's size or on the physical plan."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators.kendall import tau_b_from_stats
from churnspark.operators.metrics import roc_auc
from churnspark.operators.order import with_cumsum, with_position


@pytest.fixture(params=[8, 200])
def parts(request, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def big(spark, n=1_000_000):
    return spark.range(n).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).cast("int").alias("y"), F.xxhash64("id", F.lit(1)).alias("s"),
        F.concat(F.lit("payload-"), F.col("id")).alias("payload"))


def test_positions_are_permutations_with_a_payload(spark, parts):
    out = with_position(big(spark), ["y"], ["s"], size_col="n", max_keys=2)
    r = out.groupBy("y").agg(F.count("payload").alias("c"), F.countDistinct("pos").alias("d"), F.min("pos").alias("a"),
                             F.max("pos").alias("b"), F.max("n").alias("n")).collect()
    assert sum(x["c"] for x in r) == 1_000_000
    assert all(x["c"] == x["d"] == x["n"] == x["b"] + 1 and x["a"] == 0 for x in r)


def test_cumsum_totals(spark, parts):
    out = with_cumsum(big(spark).withColumn("w", F.lit(1)), ["y"], ["s"], "w")
    r = out.groupBy("y").agg(F.count(F.lit(1)).alias("c"), F.max("cum_before").alias("m"), F.countDistinct("cum_before").alias("d")).collect()
    assert sum(x["c"] for x in r) == 1_000_000 and all(x["m"] == x["c"] - 1 and x["d"] == x["c"] for x in r)


def test_monotone_data_has_a_kendall_p():
    n = 200
    st = {"n": n, "s": n * (n - 1) / 2, "xtie": (0, 0, 0), "ytie": (0, 0, 0)}
    tau, p = tau_b_from_stats(st)
    assert tau == pytest.approx(1.0) and 0 <= p < 1e-300
    st = {"n": 5, "s": 10, "xtie": (0, 0, 0), "ytie": (0, 0, 0)}
    assert tau_b_from_stats(st)[1] == pytest.approx(2 / math.factorial(5))


def test_whole_numbers_above_2_to_53_stay_apart(spark):
    from churnspark.operators.profile import distinct_counts
    df = spark.range(10).select((F.col("id") + F.lit(2 ** 53)).alias("k"))
    assert distinct_counts(df).first()["unique"] == 10


def test_imputer_fills_nan(spark):
    from churnspark.operators.impute import iterative_impute
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 4.5), (5.5, 5.0)], "a double, b double")
    out = iterative_impute(df)
    assert out.where(F.col("a").isNull() | F.isnan("a")).count() == 0


def test_yeo_johnson_lambda_is_not_capped(spark):
    from churnspark.operators.skew import fit_yeo_lambdas
    r = np.random.default_rng(0)
    x = (1 + 12 * np.abs(r.normal(3, 0.2, 3000))) ** (1 / 12) - 1  # needs a lambda near 12
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert fit_yeo_lambdas(df, ["x"])["x"] > 7


def test_clusters_need_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from churnspark.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d)))


def test_auc_of_many_distinct_scores(spark):
    df = big(spark, 300_000)
    pdf = df.select("s", "y").toPandas()
    rank = pdf["s"].rank().to_numpy()
    pos = pdf["y"].to_numpy() == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    got = roc_auc(df, label="y", score="s")
    got = got.first()[0] if hasattr(got, "first") else got
    assert got == pytest.approx(auc, abs=1e-9)
