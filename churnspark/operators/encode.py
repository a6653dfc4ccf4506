"""Dummies, min-max and standard scaling, one-hot encoding and the fitted
scale-and-encode stage (G1-G5).  Fitted values (category lists, means,
scales) are per-column constants; the transform is one projection of
``when``/arithmetic expressions (no vector round trip)."""
from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.exprs import as_double, is_boolean, is_numeric
from churnspark.operators.stage import JsonStateModel

MAX_CATEGORIES = 10_000


def categories(df: DataFrame, columns: list[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct non-missing values per column (one long aggregate).

    The result goes to the driver, so its size is checked: a column with
    more than ``max_categories`` values raises instead of widening the table
    without bound."""
    if not columns:
        return {}
    parts = [F.struct(F.lit(c).alias("f"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]
    vals = (df.select(F.explode(F.array(*parts)).alias("s")).select("s.*").where(F.col("v").isNotNull())
              .groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")))
    per = vals.groupBy("f").agg(F.count(F.lit(1)).alias("k"))
    too_many = per.where(F.col("k") > max_categories).limit(1).collect()
    if too_many:
        raise ValueError(f"column {too_many[0]['f']} has more than {max_categories} categories")
    out = {c: [] for c in columns}
    for r in vals.select("f", "v").collect():  # bounded by the check above
        out[r["f"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def dummies(df: DataFrame, columns: list[str] | None = None, drop_first: bool = True,
            cats: dict[str, list[str]] | None = None) -> DataFrame:
    """G1: 0/1 indicator per category (sorted), the first dropped; originals removed."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cats = cats if cats is not None else categories(df, columns)
    new = {}
    for c in columns:
        for v in (cats[c][1:] if drop_first else cats[c]):
            new[f"{c}_{v}"] = F.coalesce((F.col(f"`{c}`").cast("string") == F.lit(v)).cast("int"), F.lit(0))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*keep, *[e.alias(n) for n, e in new.items()])


def minmax_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    dt = dict((f.name, f.dataType) for f in df.schema.fields)
    x = {c: as_double(F.col(f"`{c}`"), dt[c]) for c in columns}
    row = df.agg(*[F.min(x[c]).alias(f"a{i}") for i, c in enumerate(columns)],
                 *[F.max(x[c]).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    out = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"a{i}"], row[f"b{i}"]
        rng = (hi - lo) if (lo is not None and hi is not None and hi != lo) else 1.0
        out[c] = (x[c] - F.lit(lo)) / F.lit(rng) if lo is not None else x[c]
    return df.withColumns(out)


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(x - mean) / population std``; zero std -> scale 1."""
    dt = dict((f.name, f.dataType) for f in df.schema.fields)
    fit = _standard_fit(df, columns, dt)
    return df.withColumns({c: _standard_expr(c, dt[c], *fit[c]) for c in columns})


def _standard_fit(df, columns, dt):
    if not columns:
        return {}
    row = df.agg(*[F.avg(as_double(F.col(f"`{c}`"), dt[c])).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(as_double(F.col(f"`{c}`"), dt[c])).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] if row[f"s{i}"] else 1.0) for i, c in enumerate(columns)}


def _standard_expr(c, dtype, mean, scale):
    x = as_double(F.col(f"`{c}`"), dtype)
    return (x - F.lit(mean if mean is not None else 0.0)) / F.lit(scale if scale else 1.0)


def one_hot(df: DataFrame, columns: list[str], cats: dict[str, list[str]] | None = None) -> DataFrame:
    """``<col>_<category>`` doubles for every sorted category; unseen/missing -> zeros.
    Originals are dropped and the indicator columns appended at the end."""
    cats = cats if cats is not None else categories(df, columns)
    new = {f"{c}_{v}": F.coalesce((F.col(f"`{c}`").cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
           for c in columns for v in cats[c]}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*keep, *[e.alias(n) for n, e in new.items()])


def more_than_two_values(df: DataFrame, columns: list[str], dt: dict) -> list[str]:
    """Numeric columns with at least three distinct values: some value lies between the least and the greatest.

    Two aggregates of constants; no value is shuffled or counted."""
    x = {c: as_double(F.col(f"`{c}`"), dt[c]) for c in columns}
    if not columns:
        return []
    ends = df.agg(*[f(x[c]).alias(f"{t}{i}") for i, c in enumerate(columns) for f, t in ((F.min, "a"), (F.max, "b"))]).first()
    wide = [(i, c) for i, c in enumerate(columns) if ends[f"a{i}"] is not None and ends[f"a{i}"] < ends[f"b{i}"]]
    if not wide:
        return []
    inside = df.agg(*[F.max((x[c] > F.lit(ends[f"a{i}"])) & (x[c] < F.lit(ends[f"b{i}"]))).alias(f"i{i}") for i, c in wide]).first()
    return [c for i, c in wide if inside[f"i{i}"]]


class ScaleEncode(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Standard-scale numeric columns with more than two distinct values,
    one-hot encode string columns; fit on train, reuse anywhere."""

    maxCategories = Param(Params._dummy(), "maxCategories", "", TypeConverters.toInt)
    exclude = Param(Params._dummy(), "exclude", "columns passed through (keys, labels)", TypeConverters.toListString)

    @keyword_only
    def __init__(self, maxCategories=MAX_CATEGORIES, exclude=None):
        super().__init__()
        self._setDefault(maxCategories=MAX_CATEGORIES, exclude=[])
        self._set(**self._input_kwargs)

    def _fit(self, df):
        dt = dict((f.name, f.dataType) for f in df.schema.fields)
        ex = set(self.getOrDefault(self.exclude))
        numeric = [c for c in df.columns if (is_numeric(dt[c]) or is_boolean(dt[c])) and c not in ex]
        scaled = more_than_two_values(df, numeric, dt)
        cat_cols = [c for c in df.columns if isinstance(dt[c], T.StringType) and c not in ex]
        fit = _standard_fit(df, scaled, dt)
        cats = categories(df, cat_cols, self.getOrDefault(self.maxCategories))
        return ScaleEncodeModel(state={"scaled": scaled, "fit": {c: list(v) for c, v in fit.items()},
                                       "categorical": cat_cols, "cats": cats})


class ScaleEncodeModel(JsonStateModel):
    def _transform(self, df):
        st = self.fitted
        dt = dict((f.name, f.dataType) for f in df.schema.fields)
        scaled = df.withColumns({c: _standard_expr(c, dt[c], *st["fit"][c]) for c in st["scaled"] if c in df.columns})
        return one_hot(scaled, st["categorical"], st["cats"])
