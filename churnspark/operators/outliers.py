"""Outlier thresholds, capping, counting, removal and imputation.

Threshold rule per numeric column: if ``-t < skew < t`` (adjusted skew,
``t`` = ``skew_threshold``) the bounds are ``mean -/+ 3 std``; otherwise
Tukey's ``Q1 - 1.5 IQR`` and ``Q3 + 1.5 IQR``.  Moments for all columns come
from one aggregate, the quartiles from radix selection (``selection``).
"""
from __future__ import annotations

import logging
import math

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.exprs import adj_skew, as_double, is_boolean, is_numeric
from churnspark.operators.selection import column_quantiles
from churnspark.operators.stage import JsonStateModel

log = logging.getLogger(__name__)


def outlier_thresholds(df: DataFrame, columns: list[str], skew_threshold: float = 1.0, exact: bool = True) -> DataFrame:
    """O1 for many columns: ``(feature, skew, mean, std, q_1, q_3, rule, min_thresh, max_thresh)``.

    One aggregate for the moments, a few passes of radix selection for the
    quartiles; ``exact=False`` takes these from a bounded-memory sketch."""
    dt = dict((f.name, f.dataType) for f in df.schema.fields)
    x = {c: as_double(F.col(f"`{c}`"), dt[c]) for c in columns}
    sketch = [] if exact else [F.percentile_approx(x[c], [0.25, 0.75], 10_000).alias(f"q{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *sketch, *[f(x[c]).alias(f"{t}{i}") for i, c in enumerate(columns) for f, t in (
        (F.count, "n"), (F.min, "a"), (F.max, "b"), (adj_skew, "s"), (F.avg, "m"), (F.stddev_samp, "d"))]).first()
    if exact:
        quartiles = column_quantiles(df, x, [0.25, 0.75], {c: (row[f"n{i}"], row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)})
    else:
        quartiles = {c: dict(zip((0.25, 0.75), row[f"q{i}"] or (None, None))) for i, c in enumerate(columns)}
    rows = [(c, row[f"s{i}"], row[f"m{i}"], row[f"d{i}"], quartiles[c][0.25], quartiles[c][0.75])
            for i, c in enumerate(columns) if row[f"n{i}"]]
    t = df.sparkSession.createDataFrame(rows, "feature string, skew double, mean double, std double, q_1 double, q_3 double")
    normal = (F.col("skew") > -skew_threshold) & (F.col("skew") < skew_threshold)
    iqr = F.col("q_3") - F.col("q_1")
    return t.select("feature", "skew", "mean", "std", "q_1", "q_3",
                    F.when(normal, F.lit("empirical")).otherwise(F.lit("tukey")).alias("rule"),
                    F.when(normal, F.col("mean") - 3 * F.col("std")).otherwise(F.col("q_1") - 1.5 * iqr).alias("min_thresh"),
                    F.when(normal, F.col("mean") + 3 * F.col("std")).otherwise(F.col("q_3") + 1.5 * iqr).alias("max_thresh"))


def thresholds_dict(df: DataFrame, columns: list[str], skew_threshold: float = 1.0) -> dict[str, tuple[float, float]]:
    """Thresholds on the driver: one row per column."""
    if not columns:
        return {}
    rows = outlier_thresholds(df, columns, skew_threshold).select("feature", "min_thresh", "max_thresh").collect()
    return {r["feature"]: (r["min_thresh"], r["max_thresh"]) for r in rows}


def cap_expr(c: str, lo, hi):
    """Compare-and-replace; missing values stay missing."""
    x = F.col(f"`{c}`")
    out = x
    if hi is not None:
        out = F.when(x > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(x < F.lit(lo), F.lit(lo)).otherwise(out)
    return out


def outlier_counts(df: DataFrame, thresholds: dict[str, tuple[float, float]]) -> DataFrame:
    """O3: values above the upper and below the lower threshold, per feature (one aggregate)."""
    names = list(thresholds)
    if not names:
        return df.sparkSession.createDataFrame([], "feature string, above bigint, below bigint, outliers bigint")
    aggs = []
    for i, c in enumerate(names):
        lo, hi = thresholds[c]
        aggs += [F.count_if(F.col(f"`{c}`") > F.lit(hi)).alias(f"a{i}"), F.count_if(F.col(f"`{c}`") < F.lit(lo)).alias(f"b{i}")]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("above"), F.col(f"b{i}").alias("below"),
                        (F.col(f"a{i}") + F.col(f"b{i}")).alias("outliers")) for i, c in enumerate(names)]
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


class ReplaceOutliers(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """O2: fit thresholds on every numeric column of the training frame, cap on transform.

    A column whose bounds are equal up to rounding (a flag with few ones) stays as it is (O4): capping would make it constant."""

    skewThreshold = Param(Params._dummy(), "skewThreshold", "", TypeConverters.toFloat)
    exclude = Param(Params._dummy(), "exclude", "columns never capped (O4)", TypeConverters.toListString)

    @keyword_only
    def __init__(self, skewThreshold=1.0, exclude=None):
        super().__init__()
        self._setDefault(skewThreshold=1.0, exclude=[])
        self._set(**self._input_kwargs)

    def _fit(self, df):
        ex = set(self.getOrDefault(self.exclude))
        cols = [f.name for f in df.schema.fields if (is_numeric(f.dataType)) and f.name not in ex]
        th = thresholds_dict(df, cols, self.getOrDefault(self.skewThreshold))
        return ReplaceOutliersModel(state={c: [lo, hi] for c, (lo, hi) in th.items() if lo is None or not math.isclose(lo, hi, rel_tol=1e-12)})


class ReplaceOutliersModel(JsonStateModel):
    def _transform(self, df):
        th = self.fitted
        return df.withColumns({c: cap_expr(c, lo, hi) for c, (lo, hi) in th.items() if c in df.columns})

    def counts(self, df: DataFrame) -> DataFrame:
        return outlier_counts(df, {c: tuple(v) for c, v in self.fitted.items() if c in df.columns})


def eligible_features(df: DataFrame, features: list[str]) -> list[str]:
    """O5 skips: unknown, non-numeric, single-valued and binary {0,1} columns (one aggregate)."""
    dt = dict((f.name, f.dataType) for f in df.schema.fields)
    cand = [c for c in features if c in dt and (is_numeric(dt[c]) or is_boolean(dt[c]))]
    for c in features:
        if c not in dt:
            log.info("no column %s: skipped", c)
        elif c not in cand:
            log.info("column %s holds no numbers: skipped", c)
    if not cand:
        return []
    aggs = []
    for i, c in enumerate(cand):
        x = as_double(F.col(f"`{c}`"), dt[c])
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.count_if(x.isNotNull() & (x != 0) & (x != 1)).alias(f"nb{i}")]
    row = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(cand):
        if is_boolean(dt[c]) or row[f"lo{i}"] is None or row[f"lo{i}"] == row[f"hi{i}"] or row[f"nb{i}"] == 0:
            continue
        out.append(c)
    return out


def clean_outliers(df: DataFrame, features_list: list[str] | None = None, outlier_treatment: str | None = None,
                   output_column: str | None = None, skew_threshold: float = 1.0, max_iter: int = 10,
                   random_state: int = 42, sequential: bool = True) -> DataFrame:
    """O5-O8.  Rows with any missing value are dropped first.

    * ``remove``: rows outside the bounds are removed; with ``sequential``
      (the reference's behaviour) the bounds of each feature are computed on
      the rows left by the previous features, one statistics job per feature.
    * ``replace``: values are capped (cast to double).
    * ``impute``: outliers become missing and are filled by the iterative
      regression imputer over the other features (``output_column`` excluded).
    * anything else: thresholds are only reported (logged).
    """
    df = df.na.drop(how="any")
    if features_list is None:
        features_list = list(df.columns)
    if outlier_treatment not in ("remove", "replace", "impute", None):
        log.info("unknown treatment %s: outliers stay", outlier_treatment)
        outlier_treatment = None
    feats = [c for c in eligible_features(df, features_list)
             if not (c == output_column and outlier_treatment == "impute")]
    if not feats:
        return df
    if outlier_treatment == "remove" and sequential:
        for c in feats:
            for lo, hi in thresholds_dict(df, [c], skew_threshold).values():
                if lo is not None and hi is not None:
                    df = df.where((F.col(f"`{c}`") >= lo) & (F.col(f"`{c}`") <= hi))
        return df
    th = thresholds_dict(df, feats, skew_threshold)
    if outlier_treatment == "remove":
        cond = None
        for c, (lo, hi) in th.items():
            k = (F.col(f"`{c}`") >= lo) & (F.col(f"`{c}`") <= hi)
            cond = k if cond is None else cond & k
        return df.where(cond)
    if outlier_treatment == "replace":
        return df.withColumns({c: cap_expr(c, lo, hi).cast("double") for c, (lo, hi) in th.items()})
    if outlier_treatment == "impute":
        from churnspark.operators.impute import iterative_impute
        masked = df.withColumns({c: F.when((F.col(f"`{c}`") > hi) | (F.col(f"`{c}`") < lo), F.lit(None))
                                 .otherwise(F.col(f"`{c}`").cast("double")) for c, (lo, hi) in th.items()})
        predictors = [c for c in masked.columns if c != output_column]
        return iterative_impute(masked, targets=list(th), predictors=predictors, max_iter=max_iter)
    return df
