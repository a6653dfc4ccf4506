"""Classification metrics (L6-L9, L13) as aggregates over (label, prediction, score).

Rank-based metrics (exact ROC AUC with average ranks, precision-recall curve
and average precision) reduce the rows to one row per distinct score first
(hash aggregate), then take running sums with ``order.with_cumsum``.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.order import with_cumsum


def _safe(num, den):
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def confusion_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """L6 + F1: one row ``accuracy, precision, recall, f1, tp, fp, tn, fn`` (positive = 1; 0/0 -> 0)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))
    tp, fp, tn, fn = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))
    prec, rec = _safe(tp, tp + fp), _safe(tp, tp + fn)
    return c.select(_safe(tp + tn, tp + fp + tn + fn).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                    _safe(2 * tp, 2 * tp + fp + fn).alias("f1"), "tp", "fp", "tn", "fn")


def _score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score (read by the running counts and the totals: aggregated once)."""
    from churnspark.session import cut_lineage
    return cut_lineage(df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"))
              .where(F.col("s").isNotNull() & F.col("y").isNotNull())
              .groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("y") == 1).alias("p"))
              .withColumn("__k", F.lit(0)))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact AUC = (sum of positive ranks - n1(n1+1)/2) / (n1 n0), average ranks for tied scores."""
    t = with_cumsum(_score_table(df, label, score), ["__k"], ["s"], "c", "__c0")
    r = t.withColumn("__rank", F.col("__c0") + (F.col("c") + 1) / 2.0)
    a = r.agg(F.sum(F.col("p") * F.col("__rank")).alias("rs"), F.sum("p").cast("double").alias("n1"),
              F.sum(F.col("c") - F.col("p")).cast("double").alias("n0"))
    return a.select(F.when((F.col("n1") > 0) & (F.col("n0") > 0),
                           (F.col("rs") - F.col("n1") * (F.col("n1") + 1) / 2) / (F.col("n1") * F.col("n0"))).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``threshold, precision, recall`` at every distinct score (predict positive when score >= threshold)."""
    t = _score_table(df, label, score).withColumn("__neg", -F.col("s"))
    rows = with_cumsum(t, ["__k"], ["__neg"], "c", "__c0")
    pos = with_cumsum(t, ["__k"], ["__neg"], "p", "__p0").select("s", "__p0")
    c = rows.join(pos, "s")
    tp = F.col("__p0") + F.col("p")
    npos = t.agg(F.sum("p")).scalar()
    return c.select(F.col("s").alias("threshold"), (tp / (F.col("__c0") + F.col("c"))).alias("precision"),
                    F.when(npos > 0, tp / npos).alias("recall"), F.col("p").alias("__dp"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """AP = sum over thresholds of (recall step) x precision (step sum, not trapezoids)."""
    curve = pr_curve(df, label, score)
    return curve.agg((F.sum(F.col("__dp") * F.col("precision")) / F.sum("__dp")).alias("average_precision"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision/recall/f1/support, plus macro and weighted averages."""
    y, p = F.col(label).cast("string"), F.col(prediction).cast("string")
    pairs = df.select(y.alias("y"), p.alias("p")).groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    sup = pairs.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    pred = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    tp = pairs.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    t = sup.join(pred, "cls", "full").join(tp, "cls", "left").na.fill(0, ["support", "predicted", "tp"])
    prec = _safe(F.col("tp").cast("double"), F.col("predicted"))
    rec = _safe(F.col("tp").cast("double"), F.col("support"))
    t = t.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                 _safe(2 * prec * rec, prec + rec).alias("f1"), F.col("support").cast("bigint").alias("support"))
    total = F.sum("support")
    macro = t.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                  F.avg("f1").alias("f1"), total.alias("support"))
    weighted = t.agg(F.lit("weighted avg").alias("class"),
                     (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
                     (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
                     (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"), total.alias("support"))
    return reduce(lambda a, b: a.unionByName(b), [t, macro, weighted])


def metrics_table(df: DataFrame, model_name: str, label: str = "label", prediction: str = "prediction",
                  score: str = "score") -> DataFrame:
    """Long ``(metric, model, value)`` rows: accuracy, precision, recall, f1, roc_auc."""
    cm = confusion_metrics(df, label, prediction)
    auc = roc_auc(df, label, score).scalar()
    row = cm.select("accuracy", "precision", "recall", "f1", auc.alias("roc_auc"))
    names = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.lit(model_name).alias("model"),
                                                   F.col(n).cast("double").alias("value")) for n in names])).alias("s")).select("s.*")


def compare_models(tables: list[DataFrame]) -> DataFrame:
    """Metrics side by side, one column per model."""
    long = reduce(lambda a, b: a.unionByName(b), tables)
    models = [r["model"] for r in long.select("model").distinct().collect()]  # one row per model
    return long.groupBy("metric").pivot("model", sorted(models)).agg(F.first("value"))
