"""Explanations of a fitted boosted-tree model.

* ``tree_nodes``: the ensemble's node table (the model's own parquet data),
  read back as a DataFrame — split feature, threshold, gain, cover.
* ``tree_shap``: path-dependent Tree SHAP values per row, on the margin
  scale (the sum of values plus the base value equals the margin).  Every
  leaf is a small game of its own whose values depend on a row only through
  the set of satisfied splits, so they are tabled by that set and batches of
  rows are scored by lookups in ``mapInPandas``; the trees are broadcast
  (their size is bounded by the model: trees x nodes, checked).  Output is
  long ``(id, feature, shap)``.
"""
from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.session import scratch_path

MAX_NODES = 2_000_000
#: Features of a path up to which all sets are tabled; beyond, the sets that occur in a batch are computed.
TABLED = 8


def tree_nodes(model) -> DataFrame:
    """Node table of a tree-ensemble model: ``treeID, id, prediction, gain, rawCount, leftChild, rightChild, split``."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "tree-model")
    model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def tree_weights(model) -> list[float]:
    return [float(w) for w in model.treeWeights]


def _pack(model):
    nodes = tree_nodes(model).select("treeID", "id", "prediction", "rawCount", "leftChild", "rightChild",
                                     F.col("split.featureIndex").alias("feature"),
                                     F.try_element_at(F.col("split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"))
    n = nodes.count()
    if n > MAX_NODES:
        raise ValueError(f"model has {n} nodes; more than the broadcast bound {MAX_NODES}")
    pdf = nodes.toPandas()  # bounded by MAX_NODES
    weights = tree_weights(model)
    trees = []
    for t, g in pdf.groupby("treeID"):
        g = g.sort_values("id")
        size = int(g["id"].max()) + 1
        arr = {k: np.zeros(size) for k in ("value", "cover", "threshold")}
        left, right, feat = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        for r in g.itertuples(index=False):
            i = int(r.id)
            arr["value"][i], arr["cover"][i] = r.prediction, max(float(r.rawCount), 1e-12)
            left[i], right[i] = int(r.leftChild), int(r.rightChild)
            if left[i] >= 0:
                feat[i], arr["threshold"][i] = int(r.feature), float(r.threshold)
        trees.append((weights[int(t)], left, right, feat, arr["threshold"], arr["value"], arr["cover"]))
    return trees


def _expected(tree) -> float:
    w, left, right, feat, thr, val, cov = tree
    def rec(j):
        if left[j] < 0:
            return val[j]
        return (cov[left[j]] * rec(left[j]) + cov[right[j]] * rec(right[j])) / cov[j]
    return rec(0)


class Leaf:
    """One leaf as a game of the features on its path: the leaf's value is paid where all of them are satisfied.

    A feature is satisfied where x lies in (low, high] of its splits on the
    path; absent, it is satisfied with the share of training cover that the
    path keeps at its splits.  A feature's Shapley value depends on the row only
    through which features are satisfied, so it is tabled by that set."""

    def __init__(self, path: list[tuple[int, float, bool, float]], payment: float):
        self.features = list(dict.fromkeys(f for f, *_ in path))
        m = len(self.features)
        self.low, self.high, self.share = np.full(m, -np.inf), np.full(m, np.inf), np.ones(m)
        for f, threshold, left, share in path:
            k = self.features.index(f)
            self.share[k] *= share
            if left:
                self.high[k] = min(self.high[k], threshold)
            else:
                self.low[k] = max(self.low[k], threshold)
        self.payment = payment
        self.table = self.values(np.arange(1 << m)[:, None] >> np.arange(m) & 1) if m <= TABLED else None

    def satisfied(self, x: np.ndarray) -> np.ndarray:
        """One column per feature.  A NaN fails every ``<=``: it goes right, as in the model."""
        out = np.ones((len(x), len(self.features)), bool)
        for k, f in enumerate(self.features):
            if self.high[k] < np.inf:
                out[:, k] &= x[:, f] <= self.high[k]
            if self.low[k] > -np.inf:
                out[:, k] &= ~(x[:, f] <= self.low[k])
        return out

    def values(self, on: np.ndarray) -> np.ndarray:
        """Shapley values of the features for rows of satisfied flags.

        Over the others, the coefficient of y^k in prod(share_j + on_j y) sums the payments of all coalitions of k."""
        m = len(self.features)
        weight = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
        out = np.empty((len(on), m))
        for i in range(m):
            coalition = np.zeros((len(on), m))
            coalition[:, 0] = 1.0
            for j in range(m):
                if j != i:
                    coalition[:, 1:] = coalition[:, 1:] * self.share[j] + coalition[:, :-1] * on[:, j, None]
                    coalition[:, 0] *= self.share[j]
            out[:, i] = self.payment * (on[:, i] - self.share[i]) * (coalition @ weight)
        return out

    def add(self, x: np.ndarray, phi: np.ndarray) -> None:
        m = len(self.features)
        if not m:
            return
        on = self.satisfied(x)
        if self.table is not None:
            phi[:, self.features] += self.table[on @ (1 << np.arange(m))]
        else:  # a deep path: only the sets that occur
            kinds, which = np.unique(np.packbits(on, axis=1), axis=0, return_inverse=True)
            phi[:, self.features] += self.values(np.unpackbits(kinds, axis=1, count=m))[which.ravel()]


def leaves(tree) -> list[Leaf]:
    weight, left, right, feat, thr, val, cov = tree
    out, open_nodes = [], [(0, [])]
    while open_nodes:
        j, path = open_nodes.pop()
        if left[j] < 0:
            out.append(Leaf(path, weight * val[j]))
            continue
        for child, goes_left in ((left[j], True), (right[j], False)):
            open_nodes.append((child, [*path, (int(feat[j]), float(thr[j]), goes_left, float(cov[child] / cov[j]))]))
    return out


def tree_shap(model, df: DataFrame, id_col: str, feature_names: list[str], features_col: str = "features") -> DataFrame:
    """Long ``(id, feature, shap)`` plus one ``__base__`` row per id (the expected margin).

    Each leaf's values are tabled once per task; a batch of rows is then scored leaf by leaf by table lookups."""
    spark = df.sparkSession
    trees = _pack(model)
    base = float(sum(t[0] * _expected(t) for t in trees))
    bc = spark.sparkContext.broadcast(trees)  # at most MAX_NODES nodes
    names = np.array([*feature_names, "__base__"], object)
    width = len(names)
    rows = df.select(F.col(id_col).cast("string").alias("id"), vector_to_array(F.col(features_col)).alias("x"))

    def run(batches):
        paid = [leaf for t in bc.value for leaf in leaves(t)]
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["x"].to_numpy()).astype(np.float64)
            phi = np.zeros((len(x), width))
            for leaf in paid:
                leaf.add(x, phi)
            phi[:, -1] = base
            yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), width), "feature": np.tile(names, len(x)), "shap": phi.ravel()})

    return rows.mapInPandas(run, "id string, feature string, shap double")


def shap_summary(shap: DataFrame) -> DataFrame:
    """Mean |SHAP| per feature (the data behind the summary plot)."""
    return (shap.where(F.col("feature") != "__base__").groupBy("feature")
                .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"), F.avg("shap").alias("mean_shap")))


def margin(model, df: DataFrame, features_col: str = "features") -> DataFrame:
    """The ensemble margin per row (sum of weighted tree outputs), for the additivity check."""
    out = model.transform(df)
    return out.withColumn("margin", vector_to_array(F.col("rawPrediction"))[1])
