import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnspark.operators import metrics as L
from churnspark.operators import models as ML
from churnspark.operators import sampling as M


def test_split_is_disjoint_and_stratified(spark, sf001):
    lab = spark.read.parquet(f"{sf001}/labels.parquet")
    t = M.split_labels(lab, "quality", "doc_id", 0.2, 42)
    assert t.count() == lab.count() and t.select("doc_id").distinct().count() == lab.count()
    counts = {(r["split"], r["quality"]): r["n"] for r in t.groupBy("split", "quality").agg(F.count("*").alias("n")).collect()}
    per = M.approximate_mode(M.class_counts(lab, "quality"), int(np.ceil(0.2 * lab.count())))
    for k, v in per.items():
        assert counts.get(("test", k), 0) == v


def test_kfold_contiguous_blocks(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "k long, y int")
    f = {r["k"]: r["fold"] for r in M.stratified_kfold(df, "y", "k", 5).collect()}
    pos = [f[k] for k in sorted(k for k in f if k % 3 == 0)]
    assert pos == sorted(pos)   # contiguous per class in key order


def test_auc_and_average_precision_brute_force(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) + 0.3 * y, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(L.roc_auc(df).first()["roc_auc"] - auc) < 1e-12
    ap = 0.0
    for t in np.unique(s)[::-1]:
        sel = s >= t
        ap += ((y[s == t] == 1).sum() / y.sum()) * (y[sel].sum() / sel.sum())
    assert abs(L.average_precision(df).first()["average_precision"] - ap) < 1e-12


def test_shap_additivity(spark, sf001):
    from churnspark.operators.explain import margin, tree_shap
    lab = spark.read.parquet(f"{sf001}/labels.parquet").join(spark.read.parquet(f"{sf001}/documents.parquet"), "doc_id")
    d = ML.FeatureAssembler(exclude=["doc_id", "quality", "toxic"]).transform(lab.select("doc_id", "quality", "n_chars", "toxic"))
    d = d.withColumn("extra", F.col("doc_id") % 7)
    d = ML.FeatureAssembler(exclude=["doc_id", "quality", "toxic"]).transform(d.drop("features"))
    model = ML.boosted_trees("quality", n_estimators=5, weight_col=None).fit(d)
    names = ["n_chars", "extra"]
    shap = tree_shap(model, d, "doc_id", names).groupBy("id").agg(F.sum("shap").alias("total"))
    m = margin(model, d).select(F.col("doc_id").cast("string").alias("id"), "margin")
    worst = shap.join(m, "id").agg(F.max(F.abs(F.col("total") - F.col("margin")))).first()[0]
    assert worst < 1e-9


def test_pipeline_save_load_round_trip(spark, sf001, tmp_path):
    from churnspark.plans import scenario as S
    from churnspark.sources import io as IO
    fitted = S.fit_churn_model(spark, sf001, n_estimators=3)
    path = str(tmp_path / "model")
    IO.save_pipeline(fitted.model, path)
    again = IO.load_pipeline(path)
    a = S.score(fitted, fitted.client, fitted.prices).orderBy("c_custkey").collect()
    fitted.model = again
    b = S.score(fitted, fitted.client, fitted.prices).orderBy("c_custkey").collect()
    assert [r["prob_churned"] for r in a] == pytest.approx([r["prob_churned"] for r in b])


def test_catalog_contract():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60
    from churnspark.plans.catalog import QUERIES
    assert not any(k.startswith("op") or k == "pipeline" for k in QUERIES)  # those come from the optional subpackage only
