"""Missing-value dropping, column selection by type and low-information column
pruning (P5-P8).  Decisions need one aggregate (counts per column); the
drop itself is a projection or a filter."""
from __future__ import annotations

import logging
from functools import reduce
from operator import or_

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.exprs import is_boolean, is_numeric, null_nan

log = logging.getLogger(__name__)

#: Relative standard error of the distinct sketch, and the standard errors at which its verdict counts as clear.
SKETCH_ERROR, CLEAR = 0.01, 6


def _missing(df: DataFrame, c: str):
    dt = dict((f.name, f.dataType) for f in df.schema.fields)[c]
    return null_nan(F.col(f"`{c}`"), dt).isNull()


def drop_missing(df: DataFrame, axis: int = 0) -> DataFrame:
    """P5: axis 0 drops rows with any missing value, axis 1 drops columns with any."""
    if axis == 0:
        return df.na.drop(how="any")
    row = df.agg(*[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]).first()
    gone = [c for i, c in enumerate(df.columns) if row[f"m{i}"] > 0]
    if gone:
        log.info("%d columns hold missing values and go", len(gone))
    return df.drop(*gone)


def missing_rows(df: DataFrame) -> DataFrame:
    """P5: one row ``(rows, dropped, kept)``: what ``drop_missing`` on axis 0 does to the frame, from one aggregate."""
    gone = F.count_if(_any_missing(df))
    n = F.count(F.lit(1))
    return df.agg(n.alias("rows"), gone.alias("dropped"), (n - gone).alias("kept"))


def drop_missing_observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """P5, axis 0, with the counts of the same job: ``observation.get`` gives ``rows`` and ``dropped`` after any action."""
    seen = Observation("rows with missing values")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(_any_missing(df)).alias("dropped"))
    return counted.na.drop(how="any"), seen


def _any_missing(df: DataFrame):
    return reduce(or_, [_missing(df, c) for c in df.columns], F.lit(False))


class DropMissing(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """P5 as a stage (axis 0: rows, axis 1: columns)."""

    axis = Param(Params._dummy(), "axis", "0 rows, 1 columns", TypeConverters.toInt)

    @keyword_only
    def __init__(self, axis=0):
        super().__init__()
        self._setDefault(axis=0)
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return drop_missing(df, self.getOrDefault(self.axis))


def drop_empty_columns_then_rows(df: DataFrame) -> DataFrame:
    """Drop all-missing columns, then rows with any missing value."""
    row = df.agg(*[F.count(F.when(~_missing(df, c), F.lit(1))).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if row[f"n{i}"] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep]).na.drop(how="any")


def low_information_columns(df: DataFrame, columns=None, proportion_nan_thresh: float = 0.95,
                            proportion_unique_thresh: float = 0.95) -> list[str]:
    """P8 decision: columns to drop, in the reference's rule order.

    1. missing share > ``proportion_nan_thresh``;
    2. else exactly one distinct non-missing value;
    3. else non-numeric with distinct / rows > ``proportion_unique_thresh``.

    One aggregate decides nearly all: least = greatest means one value, and a
    mergeable sketch of the distinct count settles rule 3 where its estimate
    lies ``CLEAR`` standard errors from the threshold.  Only columns nearer to it
    are counted exactly.  Types without an order (maps) are counted exactly too.
    """
    cols = list(df.columns) if columns is None else list(columns)
    for c in [c for c in cols if c not in df.columns]:
        log.info("no column %s: skipped", c)
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return []
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)
    ordered = {c: not isinstance(dtypes[c], (T.MapType, T.VariantType)) for c in cols}
    numeric = {c: is_numeric(dtypes[c]) or is_boolean(dtypes[c]) for c in cols}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = null_nan(F.col(f"`{c}`"), dtypes[c])
        aggs.append(F.count_if(x.isNull()).alias(f"m{i}"))
        if ordered[c]:
            aggs.append((F.min(x) == F.max(x)).alias(f"one{i}"))
            if not numeric[c]:
                aggs.append(F.approx_count_distinct(x.cast("string"), SKETCH_ERROR).alias(f"d{i}"))
    row = df.agg(*aggs).first()
    n = row["__rows"]
    if not n:
        return []
    verdict: dict[str, bool] = {}
    near = []
    for i, c in enumerate(cols):
        if row[f"m{i}"] / n > proportion_nan_thresh:
            verdict[c] = True
        elif not ordered[c]:
            near.append(c)
        elif row[f"one{i}"]:
            verdict[c] = True
        elif numeric[c] or row[f"d{i}"] * (1 + CLEAR * SKETCH_ERROR) <= proportion_unique_thresh * n:
            verdict[c] = False
        elif row[f"d{i}"] * (1 - CLEAR * SKETCH_ERROR) > proportion_unique_thresh * n:
            verdict[c] = True
        else:
            near.append(c)
    if near:
        from churnspark.operators.profile import distinct_counts  # local import: avoid a cycle
        for r in distinct_counts(df, near).collect():  # one row per column
            verdict[r["feature"]] = r["unique"] == 1 or r["unique"] / n > proportion_unique_thresh
    return [c for c in cols if verdict[c]]


class LowInformationPruner(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """P8 as an Estimator: decide on the training frame, drop the same columns anywhere."""

    nanThreshold = Param(Params._dummy(), "nanThreshold", "", TypeConverters.toFloat)
    uniqueThreshold = Param(Params._dummy(), "uniqueThreshold", "", TypeConverters.toFloat)
    exclude = Param(Params._dummy(), "exclude", "columns never dropped (keys, labels)", TypeConverters.toListString)

    @keyword_only
    def __init__(self, nanThreshold=0.95, uniqueThreshold=0.95, exclude=None):
        super().__init__()
        self._setDefault(nanThreshold=0.95, uniqueThreshold=0.95, exclude=[])
        self._set(**self._input_kwargs)

    def _fit(self, df):
        ex = set(self.getOrDefault(self.exclude))
        cols = [c for c in df.columns if c not in ex]
        drop = low_information_columns(df, cols, self.getOrDefault(self.nanThreshold),
                                       self.getOrDefault(self.uniqueThreshold))
        return DropColumnsModel(columns=drop)


class DropColumnsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns=None):
        super().__init__()
        self._setDefault(columns=[])
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.drop(*self.getOrDefault(self.columns))
