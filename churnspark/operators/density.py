"""Density-based outliers (DBSCAN noise): eps search and removal.

A point is *core* at radius eps when at least ``min_samples`` points (itself
included) lie within eps, and *noise* when it is not core and no core point
lies within eps.  Only the noise flag is used, so no clusters are built.

Everything follows from one exact nearest-neighbour join (``neighbours``):

* the distance at which p becomes core is that to its ``min_samples``-th
  point, itself included;
* below that distance fewer than ``min_samples`` points lie around p, all of
  them among its neighbours, so a core point that reaches p earlier is one too.

So no radius is guessed, no pair is compared because a cell is full, and the
cost does not depend on how dense the densest region is.  On the search grid
``eps_i = step + i * step``, with ``g(d)`` the first index that covers d and
``cg(q)`` that of q's core distance, ``reach(p) = min(cg(p), min_q max(g(d(p,
q)), cg(q)))`` over p's neighbours q, and p is noise at index i iff i < reach(p).
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.operators.encode import dummies
from churnspark.operators.neighbours import Distance, nearest_neighbours
from churnspark.operators.prune import drop_empty_columns_then_rows
from churnspark.session import drop_scratch, scratch_table


def prepare_points(df: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """P6 -> dummies (drop first) -> min-max scaling; returns ``(key, f0..fk)`` and the feature names."""
    clean = drop_empty_columns_then_rows(df)
    feats = [c for c in clean.columns if c != key]
    enc = dummies(clean, [f.name for f in clean.schema.fields if f.name in feats and f.dataType.simpleString() == "string"],
                  drop_first=True)
    feats = [c for c in enc.columns if c != key]
    row = enc.agg(*[F.min(F.col(f"`{c}`").cast("double")).alias(f"a{i}") for i, c in enumerate(feats)],
                  *[F.max(F.col(f"`{c}`").cast("double")).alias(f"b{i}") for i, c in enumerate(feats)]).first()
    cols = []
    for i, c in enumerate(feats):
        lo, hi = row[f"a{i}"], row[f"b{i}"]
        rng = (hi - lo) if hi is not None and lo is not None and hi != lo else 1.0
        cols.append(((F.col(f"`{c}`").cast("double") - F.lit(lo if lo is not None else 0.0)) / F.lit(rng)).alias(f"f{i}"))
    return enc.select(F.col(key).alias("__id"), *cols), [f"f{i}" for i in range(len(feats))]


def compress(points: DataFrame, names: list[str]) -> DataFrame:
    """Identical points become one weighted point ``(__id = smallest key, __w = copies)``.

    A group of copies (even a third of all rows) then costs one point in the
    distance join; counts below are weighted by ``__w``."""
    return points.groupBy(*names).agg(F.min("__id").alias("__id"), F.count(F.lit(1)).alias("__w"))


def _grid_index(d: Column, step: float) -> Column:
    """First i >= 0 with d <= step + i * step (same float arithmetic as the grid)."""
    i0 = F.greatest(F.ceil(d / F.lit(step)) - 1, F.lit(0)).cast("long")
    eps_i = F.lit(step) + i0 * F.lit(step)
    eps_prev = F.lit(step) + (i0 - 1) * F.lit(step)
    return (F.when(d > eps_i, i0 + 1).when((i0 > 0) & (d <= eps_prev), i0 - 1).otherwise(i0))


def core_distances(points: DataFrame, near: DataFrame, min_samples: int) -> DataFrame:
    """``(__id, core)``: distance to the ``min_samples``-th point, itself and copies included; NULL with fewer points."""
    if min_samples <= 1:
        return points.select("__id", F.lit(0.0).alias("core"))
    own = points.select(F.col("__id").alias("p"), F.lit(0).alias("rank"), F.lit(0.0).alias("d"), F.col("__w").alias("wq"))
    so_far = F.sum("wq").over(Window.partitionBy("p").orderBy("rank"))  # at most min_samples rows a point
    return (own.unionByName(near.select("p", "rank", "d", "wq")).withColumn("cum", so_far)
               .groupBy(F.col("p").alias("__id")).agg(F.min(F.when(F.col("cum") >= min_samples, F.col("d"))).alias("core")))


def _neighbourhoods(df: DataFrame, key: str, metric: str | Distance, min_samples: int, p: float):
    """Rows as points, distinct weighted points, their neighbours, feature names."""
    rows, names = prepare_points(df, key)
    if not names:
        return rows, None, None, names
    points = scratch_table(compress(rows, names), "density-points")
    return rows, points, nearest_neighbours(points, names, max(min_samples - 1, 1), metric, p), names


def search_eps(df: DataFrame, key: str, distance_metric: str | Distance = "manhattan", min_samples: int = 5,
               eps_step: float = 0.01, desired_percentage_outliers: float = 0.02, max_eps: float = 5.0, p: float = 2.0):
    """``(table, best_eps)``; table ``eps, percentage_outliers(%), diff`` up to the first eps without noise.

    ``distance_metric``: any name or callable of ``neighbours.metric_of`` (``p``: the order of ``minkowski``)."""
    rows, points, near, names = _neighbourhoods(df, key, distance_metric, min_samples, p)
    if points is None:
        raise ValueError("no feature is left once columns and rows with missing values are dropped")
    core = core_distances(points, near, min_samples).withColumn("cg", _grid_index(F.col("core"), eps_step))
    core = scratch_table(core, "density-core")
    by_neighbour = (near.withColumn("g", _grid_index(F.col("d"), eps_step))
                        .join(core.select(F.col("__id").alias("q"), "cg"), "q")
                        .groupBy(F.col("p").alias("__id")).agg(F.min(F.greatest("g", "cg")).alias("by")))
    by_neighbour = by_neighbour.where(F.col("by").isNotNull())
    reach = core.join(by_neighbour, "__id", "left").select("__id", F.least("cg", "by").alias("reach"))
    eps_values = list(_arange(eps_step, max_eps))
    beyond = F.when(F.col("reach") < len(eps_values), F.col("reach"))  # one count per grid index, and one for all beyond
    hist = {r["reach"]: r["n"] for r in points.select("__id", "__w").join(reach, "__id").groupBy(beyond.alias("reach"))
            .agg(F.sum("__w").alias("n")).collect()}
    drop_scratch(core, points)
    n = sum(hist.values())
    if not n:
        raise ValueError("no row is left once columns and rows with missing values are dropped")
    table = []
    noise = n
    for i, eps in enumerate(eps_values):
        noise -= hist.get(i, 0)
        pct = round(100 * noise / n, 2)
        table.append((float(eps), float(pct), float(abs(pct - 100 * desired_percentage_outliers))))
        if noise == 0:
            break
    best = min(range(len(table)), key=lambda j: table[j][2])
    out = df.sparkSession.createDataFrame(table, "eps double, `percentage_outliers(%)` double, diff double")
    return out, round(table[best][0], 4)


def _arange(step: float, stop: float):
    n = int(math.ceil((stop + step - step) / step))
    for i in range(n):
        yield step + i * step


def noise_points(df: DataFrame, key: str, eps: float, distance_metric: str | Distance = "manhattan", min_samples: int = 5,
                 p: float = 2.0) -> DataFrame:
    """Keys of the rows DBSCAN labels noise at ``eps`` (rows with missing values are not clustered)."""
    rows, points, near, names = _neighbourhoods(df, key, distance_metric, min_samples, p)
    if points is None:
        return rows.select(F.col("__id").alias(key))
    core = core_distances(points, near, min_samples).where(F.col("core") <= eps).select("__id")
    reached = near.where(F.col("d") <= eps).join(core.withColumnRenamed("__id", "q"), "q").select(F.col("p").alias("__id"))
    noise_vectors = points.join(core.unionByName(reached), "__id", "left_anti").select(*names)
    return rows.join(noise_vectors, names, "left_semi").select(F.col("__id").alias(key))


def clean_outliers_dbscan(df: DataFrame, key: str, eps: float, distance_metric: str | Distance = "manhattan",
                          min_samples: int = 5, p: float = 2.0) -> DataFrame:
    """Drop the noise rows; rows with missing values are kept (they were never clustered)."""
    return df.join(noise_points(df, key, eps, distance_metric, min_samples, p), key, "left_anti")
