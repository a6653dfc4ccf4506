"""Models (L1-L5, L10-L12): boosted trees and logistic regression with class
weights, probabilities, cross-validation, importance and model-based selection.

The boosted-tree model is Spark's ``GBTClassifier`` (depth-wise trees), so
scores differ from a leaf-wise booster; the protocol (weights, folds,
threshold 0.5, metrics) is the reference's.
"""
from __future__ import annotations

import time

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.exprs import is_boolean, is_numeric
from churnspark.operators.metrics import confusion_metrics
from churnspark.operators.sampling import class_counts


class FeatureAssembler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Assemble every numeric column except keys/labels into ``features``.

    The width of the preprocessed table is data dependent (pruning, one-hot),
    so the column list is read from the frame's schema at transform time.
    Spark's trees do not accept missing values (the reference's booster
    does), so missing entries become ``fillValue`` — 0, which is the training
    mean of every standard-scaled column."""

    exclude = Param(Params._dummy(), "exclude", "", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "", TypeConverters.toString)
    fillValue = Param(Params._dummy(), "fillValue", "value for missing entries", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, exclude=None, outputCol="features", fillValue=0.0):
        super().__init__()
        self._setDefault(exclude=[], outputCol="features", fillValue=0.0)
        self._set(**self._input_kwargs)

    def feature_columns(self, df: DataFrame) -> list[str]:
        ex = set(self.getOrDefault(self.exclude)) | {self.getOrDefault(self.outputCol)}
        return [f.name for f in df.schema.fields
                if f.name not in ex and (is_numeric(f.dataType) or is_boolean(f.dataType))]

    def _transform(self, df):
        cols = self.feature_columns(df)
        fill = F.lit(float(self.getOrDefault(self.fillValue)))
        cast = df.withColumns({c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")), fill)
                               for c in cols})
        return VectorAssembler(inputCols=cols, outputCol=self.getOrDefault(self.outputCol),
                               handleInvalid="keep").transform(cast)


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = 100_000) -> DataFrame:
    """Iterative learners run one job per iteration over every partition: give the training
    frame about ``rows_per_partition`` rows per partition (never more partitions than it has)."""
    want = max(1, -(-int(n_rows) // rows_per_partition))
    return df.coalesce(want) if want < df.rdd.getNumPartitions() else df


def class_weights(df: DataFrame, label: str, positive_weight: float = 1.0, balanced: bool = True) -> dict:
    """L3: ``n / (k * n_class)`` per class (balanced), times ``positive_weight`` for class 1."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    return {c: (n / (k * m) if balanced else 1.0) * (positive_weight if c == 1 else 1.0) for c, m in counts.items()}


def with_weights(df: DataFrame, label: str, weights: dict, out: str = "weight") -> DataFrame:
    e = None
    for c, w in weights.items():
        e = F.when(F.col(label) == F.lit(c), F.lit(float(w))) if e is None else e.when(F.col(label) == F.lit(c), F.lit(float(w)))
    return df.withColumn(out, e.otherwise(F.lit(1.0)))


def boosted_trees(label: str = "churn", n_estimators: int = 100, seed: int = 42, weight_col: str | None = "weight",
                  max_depth: int = 5, step_size: float = 0.1) -> GBTClassifier:
    """L1: boosted trees; pair with ``class_weights(..., positive_weight=9)`` for the reference setup."""
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=n_estimators, seed=seed,
                        maxDepth=max_depth, stepSize=step_size)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return gbt


def logistic(label: str = "churn", weight_sum: float = 1.0, max_iter: int = 1000,
             weight_col: str | None = "weight") -> LogisticRegression:
    """L2: L2-penalised logistic regression equal to C = 1 on the weighted sum of losses
    (Spark averages the loss, so ``regParam = 1 / sum(weights)``), no standardisation."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, regParam=1.0 / weight_sum,
                            elasticNetParam=0.0, standardization=False, tol=1e-6)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def predict(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """L4: ``score`` (probability of class 1) and ``prediction`` at the threshold."""
    out = model.transform(df)
    score = vector_to_array(F.col("probability"))[1]
    return out.withColumn("score", score).withColumn("prediction", (F.col("score") > threshold).cast("double"))


def cross_validate(estimator, df: DataFrame, label: str, fold_col: str = "fold", n_splits: int = 5,
                   parallelism: int | None = None) -> DataFrame:
    """Per fold fit time, score time, accuracy, precision, recall (folds from ``stratified_kfold``).

    Folds are independent: they are submitted from ``parallelism`` threads
    (Spark runs the jobs concurrently); the input is checkpointed once."""
    from concurrent.futures import ThreadPoolExecutor

    from churnspark.session import cut_lineage
    spark = df.sparkSession
    df = cut_lineage(df)

    def one(k):
        train, test = df.where(F.col(fold_col) != k), df.where(F.col(fold_col) == k)
        t0 = time.time()
        model = estimator.copy().fit(train)
        fit_time = time.time() - t0
        t0 = time.time()
        m = confusion_metrics(predict(model, test), label, "prediction").first()
        score_time = time.time() - t0
        return (k, fit_time, score_time, m["accuracy"], m["precision"], m["recall"])

    with ThreadPoolExecutor(max_workers=parallelism or n_splits) as pool:
        rows = list(pool.map(one, range(n_splits)))
    return spark.createDataFrame(rows, "fold int, fit_time double, score_time double, test_accuracy double, "
                                       "test_precision double, test_recall double")


def tree_importance(gbt_model, feature_names: list[str]) -> DataFrame:
    """Split count and total gain per feature, from the fitted trees' node table."""
    from churnspark.operators.explain import tree_nodes
    nodes = tree_nodes(gbt_model)
    names = nodes.sparkSession.createDataFrame(list(enumerate(feature_names)), "featureIndex int, feature string")
    imp = (nodes.where(F.col("leftChild") >= 0)
                .groupBy(F.col("split.featureIndex").alias("featureIndex"))
                .agg(F.count(F.lit(1)).alias("split_importance"), F.sum("gain").alias("gain_importance")))
    return (names.join(imp, "featureIndex", "left").na.fill(0, ["split_importance", "gain_importance"])
                 .select("feature", F.col("split_importance").cast("bigint"), F.col("gain_importance").cast("double")))


def top_k(df: DataFrame, by: str, k: int) -> DataFrame:
    """The k largest rows by a column (a top-k report: the limit is the feature)."""
    return df.orderBy(F.col(by).desc_nulls_last()).limit(k)


def select_by_importance(importance: DataFrame, by: str = "split_importance") -> list[str]:
    """Features whose importance is at least the median importance."""
    med = importance.agg(F.percentile(by, 0.5)).first()[0]
    return [r["feature"] for r in importance.where(F.col(by) >= med).select("feature").collect()]
