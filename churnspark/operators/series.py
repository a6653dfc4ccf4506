"""Per-entity time-series features (mean, std, last, last-minus-first, trend slope).

One row per entity from a long ``(id, date, values...)`` table.  The five
feature blocks are aggregates of the same table on the same key, so they are
computed in one aggregation instead of five aggregations and four joins.

Semantics (per value column ``c``):

* ``mean_c``       – mean of the non-missing values.
* ``std_c``        – sample standard deviation (n-1); NULL for fewer than 2 values.
* ``last_c``       – value of the row with the greatest date; ties go to the
  first row in input order, represented by the smallest tiebreak key.
* ``difference_c`` – ``last_c`` minus the value of the row with the smallest
  date (ties again to the smallest tiebreak).
* ``c_slope``      – least-squares slope of the value against its position
  0..n-1 in (date, tiebreak) order; NULL if any value of the entity is
  missing or the entity has one row.

Scale: rows are range-partitioned on ``(id, date, tiebreak)`` so a hot entity
is split over several tasks (see ``order.py``); each piece is aggregated where
it lives, and pieces are combined with the parallel (Chan) formulas for
means, squared deviations and co-moments.  ``skew_safe=False`` uses one hash
shuffle on the id and a per-id window instead (cheaper when no entity can be
large).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.exprs import null_nan
from churnspark.operators.order import PID, RID, piece_offsets, ranged


def _neg(c: str) -> Column:
    return -F.col(c)


def _order_keys(date: str, tiebreak: list[str]):
    """(last-key, first-key) structs; NULL when the date is missing so such rows never win."""
    last_key = F.when(F.col(date).isNotNull(), F.struct(F.col(date).alias("d"), *[_neg(t).alias(f"t{i}") for i, t in enumerate(tiebreak)]))
    first_key = F.when(F.col(date).isNotNull(), F.struct(F.col(date).alias("d"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tiebreak)]))
    return last_key, first_key


def series_features(df: DataFrame, value_columns: list[str], id_column: str = "id",
                    date_column: str = "price_date", tiebreak: list[str] | None = None,
                    families: dict[str, list[str]] | None = None,
                    differences: dict[str, tuple[str, str]] | None = None,
                    skew_safe: bool = True, n_parts: int | None = None) -> DataFrame:
    """Entity-level features from a long series table.

    ``families``: ``{out_name: [value columns]}`` -> row-wise mean of the
    corresponding ``mean_*`` features (missing skipped).
    ``differences``: ``{out_name: (a, b)}`` -> ``mean_a - mean_b``.
    """
    tiebreak = list(tiebreak or [])
    families = families or {}
    differences = differences or {}
    vals = {c: f"__v{i}" for i, c in enumerate(value_columns)}
    dtypes = dict(df.dtypes)
    base = df.where(F.col(id_column).isNotNull()).select(
        id_column, date_column, *tiebreak,
        *[null_nan(F.col(c).cast("double")).alias(v) if dtypes[c] in ("double", "float")
          else F.col(c).cast("double").alias(v) for c, v in vals.items()])
    last_key, first_key = _order_keys(date_column, tiebreak)
    base = base.withColumns({"__lk": last_key, "__fk": first_key})

    if skew_safe:
        feats = _two_level(base, id_column, date_column, tiebreak, vals, n_parts)
    else:
        feats = _one_level(base, id_column, date_column, tiebreak, vals)

    out_cols = [F.col(id_column)]
    out_cols += [F.col(f"mean_{c}") for c in value_columns]
    out_cols += [_row_mean([F.col(f"mean_{c}") for c in cols]).alias(name) for name, cols in families.items()]
    out_cols += [(F.col(f"mean_{a}") - F.col(f"mean_{b}")).alias(name) for name, (a, b) in differences.items()]
    out_cols += [F.col(f"last_{c}") for c in value_columns]
    out_cols += [F.col(f"difference_{c}") for c in value_columns]
    out_cols += [F.col(f"{c}_slope") for c in value_columns]
    out_cols += [F.col(f"std_{c}") for c in value_columns]
    return feats.select(*out_cols)


def _row_mean(cols: list[Column]) -> Column:
    s = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    k = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.when(k > 0, s / k)


def _one_level(base, id_column, date_column, tiebreak, vals):
    w = Window.partitionBy(id_column).orderBy(F.col(date_column).asc_nulls_last(), *tiebreak)
    b = base.withColumn("__pos", (F.row_number().over(w) - 1).cast("double"))
    allv = F.struct(*[F.col(v).alias(c) for c, v in vals.items()])
    aggs = [F.count(F.lit(1)).alias("__n"), F.max_by(allv, "__lk").alias("__last"), F.min_by(allv, "__fk").alias("__first")]
    for c, v in vals.items():
        aggs += [F.avg(v).alias(f"mean_{c}"), F.stddev_samp(v).alias(f"std_{c}"),
                 F.regr_slope(v, "__pos").alias(f"__slope_{c}"), F.count(v).alias(f"__cnt_{c}")]
    g = b.groupBy(id_column).agg(*aggs)
    g = g.withColumns({**{f"last_{c}": F.col(f"__last.{c}") for c in vals},
                       **{f"__first_{c}": F.col(f"__first.{c}") for c in vals}})
    cols = {}
    for c in vals:
        cols[f"difference_{c}"] = F.col(f"last_{c}") - F.col(f"__first_{c}")
        cols[f"{c}_slope"] = F.when((F.col(f"__cnt_{c}") == F.col("__n")) & (F.col("__n") >= 2), F.col(f"__slope_{c}"))
    return g.withColumns(cols)


def _two_level(base, id_column, date_column, tiebreak, vals, n_parts):
    order = [F.col(date_column).asc_nulls_last(), *[F.col(t) for t in tiebreak]]
    # Row ids without their partition's base (the upper bits) stay exact as doubles.
    inside = F.col(RID).bitwiseAND(F.lit((1 << 33) - 1)).cast("double")
    r = ranged(base, [id_column], order, n_parts).withColumn(RID, inside)
    # piece level: one (partition, id) run of consecutive row ids
    allv = F.struct(*[F.col(v).alias(c) for c, v in vals.items()])
    aggs = [F.count(F.lit(1)).alias("__n"), F.min(RID).alias("__first_rid"), F.avg(RID).alias("__mrid"),
            F.max("__lk").alias("__lk"), F.max_by(allv, "__lk").alias("__last"),
            F.min("__fk").alias("__fk"), F.min_by(allv, "__fk").alias("__fst")]
    for c, v in vals.items():
        aggs += [F.count(v).alias(f"__cnt_{c}"), F.avg(v).alias(f"__m_{c}"),
                 (F.var_pop(v) * F.count(v)).alias(f"__m2_{c}"),
                 (F.covar_pop(RID, v) * F.count(v)).alias(f"__sxy_{c}")]
    pieces = r.groupBy(PID, id_column).agg(*aggs)
    pieces = piece_offsets(pieces, [id_column])
    # grand means per id through a window on the (small) piece table, for stable combination
    wid = Window.partitionBy(id_column)
    add = {"__pos_m": F.col("__mrid") - F.col("__first_rid") + F.col("__off")}
    for c in vals:
        add[f"__gm_{c}"] = F.sum(F.col(f"__cnt_{c}") * F.col(f"__m_{c}")).over(wid) / F.sum(f"__cnt_{c}").over(wid)
    pieces = pieces.withColumns(add)
    pieces = pieces.withColumn("__gpos", F.sum(F.col("__n") * F.col("__pos_m")).over(wid) / F.sum("__n").over(wid))
    aggs2 = [F.sum("__n").alias("__n"), F.max_by("__last", "__lk").alias("__last"),
             F.min_by("__fst", "__fk").alias("__fst")]
    for c in vals:
        dm = F.col(f"__m_{c}") - F.col(f"__gm_{c}")
        aggs2 += [F.sum(f"__cnt_{c}").alias(f"__cnt_{c}"),
                  F.first(f"__gm_{c}", ignorenulls=True).alias(f"mean_{c}"),
                  F.sum(F.col(f"__m2_{c}") + F.col(f"__cnt_{c}") * dm * dm).alias(f"__M2_{c}"),
                  F.sum(F.col(f"__sxy_{c}") + F.col("__n") * (F.col("__pos_m") - F.col("__gpos")) * dm).alias(f"__Sxy_{c}")]
    g = pieces.groupBy(id_column).agg(*aggs2)
    g = g.withColumns({**{f"last_{c}": F.col(f"__last.{c}") for c in vals},
                       **{f"__first_{c}": F.col(f"__fst.{c}") for c in vals}})
    cols = {}
    n = F.col("__n").cast("double")
    for c in vals:
        cnt = F.col(f"__cnt_{c}")
        cols[f"std_{c}"] = F.when(cnt >= 2, F.sqrt(F.greatest(F.col(f"__M2_{c}"), F.lit(0.0)) / (cnt - 1)))
        cols[f"difference_{c}"] = F.col(f"last_{c}") - F.col(f"__first_{c}")
        cols[f"{c}_slope"] = F.when((cnt == F.col("__n")) & (F.col("__n") >= 2),
                                    F.col(f"__Sxy_{c}") / (n * (n * n - 1) / 12.0))
    return g.withColumns(cols)
