"""Column profiling: missing/distinct counts, the univariate table, histogram and
category counts, contingency tables and their shares, group summaries.

Design: one wide aggregate gives every per-column moment in a single scan;
exact quartiles come from radix selection (``selection``), without a shuffle
of values; distinct counts and modes come from one long ``(feature, value)``
value-count table (a hash aggregate with map-side combine) instead of one
``count_distinct`` per column (which would expand the data once per column).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.exprs import (adj_kurt, adj_skew, as_double, is_boolean, is_numeric,
                                        null_nan, rnd)
from churnspark.operators.quantiles import exact_quantiles
from churnspark.operators.selection import column_quantiles
from churnspark.session import scratch_table

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Pandas dtype names reported for Spark types in the "type" field.
PANDAS_DTYPE = {"double": "float64", "float": "float32", "bigint": "int64", "int": "int32",
                "smallint": "int16", "tinyint": "int8", "boolean": "bool", "string": "object",
                "timestamp": "datetime64[ns]", "timestamp_ntz": "datetime64[ns]", "date": "object"}


def pandas_dtype(dtype: T.DataType) -> str:
    return PANDAS_DTYPE.get(dtype.simpleString(), dtype.simpleString())


def _fields(df: DataFrame, columns=None):
    names = set(columns) if columns is not None else None
    return [f for f in df.schema.fields if names is None or f.name in names]


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """``(feature, missing)`` for each column; NaN counts as missing."""
    fields = _fields(df, columns)
    row = df.agg(*[F.count_if(null_nan(F.col(f"`{f.name}`"), f.dataType).isNull()).alias(f.name) for f in fields])
    return _to_long(row, [f.name for f in fields], "missing", "bigint")


def _to_long(row: DataFrame, names: list[str], value: str, vtype: str) -> DataFrame:
    """Unpivot a one-row wide frame into ``(feature, value)``."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast(vtype).alias(value))
                                            for n in names])).alias("s")).select("s.*")


def long_values(df: DataFrame, fields) -> DataFrame:
    """``(feature, vnum, vstr, vint)``: every non-missing cell once; numeric cells in ``vnum``, whole
    numbers also in ``vint``, as doubles merge those above 2^53."""
    parts = []
    for f in fields:
        if is_numeric(f.dataType) or is_boolean(f.dataType):
            parts.append(F.struct(F.lit(f.name).alias("feature"), as_double(F.col(f"`{f.name}`"), f.dataType).alias("vnum"),
                                  F.lit(None).cast("string").alias("vstr"),
                                  (F.col(f"`{f.name}`") if isinstance(f.dataType, _INTEGRAL) else F.lit(None)).cast("bigint").alias("vint")))
        else:
            parts.append(F.struct(F.lit(f.name).alias("feature"), F.lit(None).cast("double").alias("vnum"),
                                  F.col(f"`{f.name}`").cast("string").alias("vstr"), F.lit(None).cast("bigint").alias("vint")))
    return (df.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
              .where(F.col("vnum").isNotNull() | F.col("vstr").isNotNull()))


def value_count_table(df: DataFrame, fields) -> DataFrame:
    return long_values(df, fields).groupBy("feature", "vnum", "vstr", "vint").agg(F.count(F.lit(1)).alias("__cnt"))


def distinct_counts(df: DataFrame, columns=None, approx: bool = False) -> DataFrame:
    """``(feature, unique)``, missing excluded."""
    fields = _fields(df, columns)
    if approx:
        row = df.agg(*[F.approx_count_distinct(null_nan(F.col(f"`{f.name}`"), f.dataType)).alias(f.name) for f in fields])
        return _to_long(row, [f.name for f in fields], "unique", "bigint")
    vc = value_count_table(df, fields)
    got = vc.groupBy("feature").agg(F.count(F.lit(1)).alias("unique"))
    names = df.sparkSession.createDataFrame([(f.name,) for f in fields], "feature string")
    return names.join(got, "feature", "left").select("feature", F.coalesce("unique", F.lit(0)).cast("bigint").alias("unique"))


def _modes(vc: DataFrame, fields) -> DataFrame:
    """Most frequent value per feature; ties go to the smallest value."""
    top = vc.groupBy("feature").agg(F.max("__cnt").alias("__top"))
    best = (vc.join(top, "feature").where(F.col("__cnt") == F.col("__top"))
              .groupBy("feature").agg(F.min("vnum").alias("__mnum"), F.min("vstr").alias("__mstr"),
                                     F.min("vint").alias("__mint")))
    integral = [f.name for f in fields if isinstance(f.dataType, _INTEGRAL) or is_boolean(f.dataType)]
    as_text = F.when(F.col("feature").isin(integral) if integral else F.lit(False),
                     F.coalesce("__mint", F.col("__mnum").cast("bigint")).cast("string")).otherwise(F.col("__mnum").cast("string"))
    return best.select("feature", F.coalesce(as_text, F.col("__mstr")).alias("mode"))


def univariate_profile(df: DataFrame, round_to: int = 3, columns=None, sort_by_skew: bool = False,
                       exact: bool = True) -> DataFrame:
    """One row per column.

    ``feature, type, count, missing, unique, mode, min_value, q_1, median,
    q_3, max_value, mean, std, skew, kurtosis``; numeric statistics are NULL
    for non-numeric columns (the reference prints "-").  ``min_value``,
    ``mean``, ``std``, ``skew`` and ``kurtosis`` are rounded to ``round_to``;
    quartiles and max are not, as in the reference.  ``exact=False`` takes
    quartiles from a bounded-memory sketch instead of the exact value counts.
    """
    fields = _fields(df, columns)
    numeric = [f for f in fields if is_numeric(f.dataType) or is_boolean(f.dataType)]
    aggs = []
    for i, f in enumerate(fields):
        c = null_nan(F.col(f"`{f.name}`"), f.dataType)
        aggs += [F.count(c).alias(f"n{i}"), F.count_if(c.isNull()).alias(f"m{i}")]
    for i, f in enumerate(fields):
        if f in numeric:
            x = as_double(F.col(f"`{f.name}`"), f.dataType)
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"av{i}"),
                     F.stddev_samp(x).alias(f"sd{i}"), adj_skew(x).alias(f"sk{i}"), adj_kurt(x).alias(f"ku{i}")]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()  # one row, a few numbers a column
    number = {f.name: as_double(F.col(f"`{f.name}`"), f.dataType) for f in numeric}
    if exact:
        known = {f.name: (wide[f"n{i}"], wide[f"mn{i}"], wide[f"mx{i}"]) for i, f in enumerate(fields) if f in numeric}
        quartiles = column_quantiles(df, number, [0.25, 0.5, 0.75], known)
    else:
        sketch = df.agg(F.count(F.lit(1)), *[F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000) for x in number.values()]).first()
        quartiles = {c: dict(zip((0.25, 0.5, 0.75), q or (None,) * 3)) for c, q in zip(number, sketch[1:])}
    rows = []
    for i, f in enumerate(fields):
        row = [f.name, pandas_dtype(f.dataType), wide[f"n{i}"], wide[f"m{i}"]]
        if f in numeric:
            row += [wide[f"mn{i}"], *(quartiles[f.name][q] for q in (0.25, 0.5, 0.75)), *(wide[f"{s}{i}"] for s in ("mx", "av", "sd", "sk", "ku"))]
        rows.append(tuple(row) if f in numeric else (*row, *[None] * 9))
    stats = df.sparkSession.createDataFrame(rows, "feature string, type string, count bigint, missing bigint, min_value double, q_1 double, "
                                            "median double, q_3 double, max_value double, mean double, std double, skew double, kurtosis double")
    stats = stats.withColumns({c: rnd(F.col(c), round_to) for c in ("min_value", "mean", "std", "skew", "kurtosis")})

    # Unique counts and modes need the values themselves: counted once, before the shuffle and after it.
    vc = scratch_table(value_count_table(df, fields), "profile-values")
    uniq = vc.groupBy("feature").agg(F.count(F.lit(1)).alias("unique"))
    modes = _modes(vc, fields)
    out = stats.join(uniq, "feature", "left").join(modes, "feature", "left")
    out = out.select("feature", "type", "count", "missing", F.coalesce("unique", F.lit(0)).cast("bigint").alias("unique"),
                     "mode", "min_value", "q_1", "median", "q_3", "max_value", "mean", "std", "skew", "kurtosis")
    if sort_by_skew:
        out = out.orderBy(F.col("skew").desc_nulls_last())
    return out


# ------------------------------------------------------------------ charts' data

def auto_bins(df: DataFrame, feature: str) -> int:
    """numpy's ``bins="auto"``: the larger of the Sturges and Freedman-Diaconis bin counts."""
    import math
    x = as_double(F.col(feature), dict((f.name, f.dataType) for f in df.schema.fields)[feature])
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    st = vals.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n, lo, hi = st["n"], st["lo"], st["hi"]
    if not n or hi == lo:
        return 1
    q = column_quantiles(vals, {"x": F.col("x")}, [0.25, 0.75], {"x": (n, lo, hi)})["x"]
    sturges = math.ceil(math.log2(n)) + 1
    iqr = q[0.75] - q[0.25]
    fd = math.ceil((hi - lo) / (2.0 * iqr * n ** (-1.0 / 3.0))) if iqr > 0 else 0
    return max(sturges, fd, 1)


def histogram(df: DataFrame, feature: str, bins: int | str = 10) -> DataFrame:
    """A11 numeric: equal-width bins over [min, max]; density = count / (n * width).

    ``bins="auto"`` picks the bin count as numpy does.  The last bin is
    closed on the right, as numpy's histogram."""
    if bins == "auto":
        bins = auto_bins(df, feature)
    x = as_double(F.col(feature), dict((f.name, f.dataType) for f in df.schema.fields)[feature])
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    lo, hi = vals.agg(F.min("x")).scalar(), vals.agg(F.max("x")).scalar()
    n = vals.agg(F.count(F.lit(1))).scalar()
    w = (F.col("hi") - F.col("lo")) / bins
    b = (vals.withColumns({"lo": lo, "hi": hi, "n": n})
         .withColumn("bin", F.when(F.col("hi") == F.col("lo"), F.lit(0))
                     .otherwise(F.least(F.floor((F.col("x") - F.col("lo")) / w), F.lit(bins - 1))).cast("int")))
    g = b.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.first("lo").alias("lo"),
                             F.first("hi").alias("hi"), F.first("n").alias("n"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0))
    return g.select(F.lit(feature).alias("feature"), "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                    "count", (F.col("count") / (F.col("n") * width)).alias("density"))


def category_counts(df: DataFrame, feature: str) -> DataFrame:
    """A11 categorical: count per category (missing excluded, as a count plot)."""
    return (df.where(F.col(feature).isNotNull()).groupBy(feature).agg(F.count(F.lit(1)).alias("count"))
              .select(F.lit(feature).alias("feature"), F.col(feature).cast("string").alias("category"), "count"))


def group_summary(df: DataFrame, numerical: str, categorical: str, plot_type: str = "bar") -> DataFrame:
    """Per category mean, std, count and quartiles of a numeric column."""
    if plot_type not in ("bar", "violin"):
        raise ValueError(f"plot_type is bar or violin, not {plot_type!r}")
    dt = dict((f.name, f.dataType) for f in df.schema.fields)[numerical]
    base = df.select(F.col(categorical).alias("category"), as_double(F.col(numerical), dt).alias("x")).where(
        F.col("category").isNotNull() & F.col("x").isNotNull())
    stats = base.groupBy("category").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                         F.count(F.lit(1)).alias("count"))
    qs = exact_quantiles(base, ["category"], "x", [0.25, 0.5, 0.75])
    qw = qs.groupBy("category").agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n)
                                      for q, n in ((0.25, "q_1"), (0.5, "median"), (0.75, "q_3"))])
    return stats.join(qw, "category", "left")


# ------------------------------------------------------------------ contingency

def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table ``(a, b, count)``; pairs with a missing side dropped."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(a, b).agg(F.count(F.lit(1)).alias("count")))


def contingency_shares(df: DataFrame, a: str, b: str, axis_sum=None) -> DataFrame:
    """A10: count and percent of the grand total (None), column total (0) or row total (1)."""
    if axis_sum not in (None, 0, 1):
        raise ValueError(f"axis_sum is None, 0 or 1, not {axis_sum!r}")
    t = contingency(df, a, b)
    if axis_sum is None:
        total = t.agg(F.sum("count")).scalar()  # grand total as a scalar subquery
    else:
        total = F.sum("count").over(Window.partitionBy(b if axis_sum == 0 else a))
    return t.withColumn("percent", F.col("count") / total * 100)
