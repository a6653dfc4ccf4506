"""Kendall tau-b with tie correction, exact, without an n^2 pair join (V3).

S is the sum over pairs of sign(dx) * sign(dy).  Approximate quantiles cut
either side into blocks of about ``BLOCK`` points: a cut's own value is a block
by itself, the values between two cuts are another, so equal values never
part.  Every pair is counted once:

* in the same x block, by the task that holds this block;
* in different x blocks and the same y block, by the task that holds this y
  block, where x blocks stand for x;
* in different blocks of both sides, from the weights of the cells (x block,
  y block), which are points again, far fewer, and go through the same steps.

A block of one value has no pair that counts and is not sent anywhere.  A task
compares its points by running sums over the bits of the rank of y, in numpy;
every point is shuffled twice, whatever the number of values, and there is one
path for all sizes.  Tie terms come from value counts.  The p-value follows
the usual rule: exact permutation distribution for small untied samples,
otherwise the tie-corrected normal approximation.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.session import cut_lineage

BLOCK = 250_000  # points of a block, about 10 MB in its task


def _points(df: DataFrame, target: Column, features: dict[str, Column]) -> DataFrame:
    """``feature, x, y, w``: distinct complete pairs with their number of rows."""
    parts = [F.struct(F.lit(name).alias("feature"), c.cast("double").alias("x")) for name, c in features.items()]
    long = (df.select(target.cast("double").alias("y"), F.explode(F.array(*parts)).alias("s"))
              .select("s.feature", "s.x", "y")
              .where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")))
    return cut_lineage(long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("w")))


def _tie_sums(points: DataFrame, side: str) -> DataFrame:
    """Per feature: sums over tie groups of c(c-1)/2, c(c-1)(c-2) and c(c-1)(2c+5)."""
    c = F.col("c")
    return (points.groupBy("feature", side).agg(F.sum("w").cast("double").alias("c"))
                  .groupBy("feature").agg(F.sum("c").alias("n"), F.sum(c * (c - 1) / 2).alias(f"{side}1"),
                                          F.sum(c * (c - 1) * (c - 2)).alias(f"{side}0"),
                                          F.sum(c * (c - 1) * (2 * c + 5)).alias(f"{side}2")))


def pair_signs(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Sum over pairs of points of sign(dx) * sign(dy) * w * w.

    Two ranks of y that differ agree above one bit and differ in it.  With the
    points by (bits above, x), one with the bit set lies above those without it."""
    order = np.argsort(x, kind="stable")
    place = np.unique(x[order], return_inverse=True)[1]
    rank = np.unique(y[order], return_inverse=True)[1]
    w = w[order].astype(np.int64 if w.sum() < 3e9 else np.float64)  # products of integers stay exact
    starts = lambda new: np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    total = 0
    for bit in reversed(range(int(rank.max(initial=0)).bit_length())):
        above, one = rank >> (bit + 1), (rank >> bit) & 1 == 1
        group = np.concatenate([[True], above[1:] != above[:-1]])
        tie = group | np.concatenate([[True], place[1:] != place[:-1]])
        group, tie = starts(group), starts(tie)
        ones, zeros = (np.concatenate([[0], np.cumsum(np.where(c, w, 0))]) for c in (one, ~one))
        total += (w * np.where(one, zeros[tie] - zeros[group], ones[group] - ones[tie])).sum()
        order = np.argsort(rank >> bit, kind="stable")
        place, rank, w = place[order], rank[order], w[order]
    return float(total)


def _block_of(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """2k between the cuts k - 1 and k, 2k + 1 at the cut k."""
    return np.searchsorted(cuts, values, "left") + np.searchsorted(cuts, values, "right")


def _block_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``feature, s`` of every group of points."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"feature": frame["feature"].iloc[:1], "s": [pair_signs(*(frame[c].to_numpy() for c in "xyw"))]})
    return rows.groupBy(*keys).applyInPandas(run, "feature string, s double")


def _dominance(points: DataFrame) -> DataFrame:
    """``feature, s``: the sums over all pairs, from blocks of either side and from their cells."""
    most = points.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    parts = max(1, -(-most // BLOCK))
    if parts == 1:
        return _block_sums(points, ["feature"])
    at, fine = [k / parts for k in range(1, parts)], max(1000, 4 * parts)
    found = points.groupBy("feature").agg(*[F.percentile_approx(c, at, fine).alias(c) for c in "xy"]).collect()  # parts - 1 values a side
    cuts = {r["feature"]: [np.unique(np.array(r[c], float)) for c in "xy"] for r in found}

    def marked(batches):
        for b in batches:
            names, (x, y) = b.column("feature").dictionary_encode(), (b.column(c).to_numpy(zero_copy_only=False) for c in "xy")
            xb, yb = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            for k, name in enumerate(names.dictionary.to_pylist()):
                mine = names.indices.to_numpy() == k
                xb[mine], yb[mine] = _block_of(x[mine], cuts[name][0]), _block_of(y[mine], cuts[name][1])
            yield b, x, y, xb, yb

    def in_blocks(batches):
        for b, x, y, xb, yb in marked(batches):
            for side, block, at_x in (("x", xb, x), ("y", yb, xb.astype(float))):
                keep = pa.array(block % 2 == 0)
                yield pa.record_batch([b.column("feature"), pa.array([side] * len(x)), pa.array(block), pa.array(at_x), pa.array(y), b.column("w")],
                                      ["feature", "side", "block", "x", "y", "w"]).filter(keep)

    def in_cells(batches):
        for b, _, _, xb, yb in marked(batches):
            yield pa.record_batch([b.column("feature"), pa.array(xb.astype(float)), pa.array(yb.astype(float)), b.column("w")], ["feature", "x", "y", "w"])
    rows = points.select("feature", "x", "y", "w")
    within = _block_sums(rows.mapInArrow(in_blocks, "feature string, side string, block long, x double, y double, w long"), ["feature", "side", "block"])
    cells = rows.mapInArrow(in_cells, "feature string, x double, y double, w long").groupBy("feature", "x", "y").agg(F.sum("w").alias("w"))
    return within.unionByName(_dominance(cut_lineage(cells))).groupBy("feature").agg(F.sum("s").alias("s"))


def _statistics(points: DataFrame) -> dict[str, dict]:
    """feature -> n, S and tie sums (one row per feature reaches the driver)."""
    rows = _tie_sums(points, "x").join(_tie_sums(points, "y").drop("n"), "feature").join(_dominance(points), "feature").collect()
    return {r["feature"]: {"n": int(r["n"]), "s": r["s"], "xtie": (r["x1"], r["x0"], r["x2"]),
                           "ytie": (r["y1"], r["y0"], r["y2"])} for r in rows}


def kendall_s_and_ties(df: DataFrame, x: str, y: str) -> dict:
    """n, S and the tie sums needed for tau-b and its variance."""
    none = {"n": 0, "s": 0.0, "xtie": (0.0, 0.0, 0.0), "ytie": (0.0, 0.0, 0.0)}
    return _statistics(_points(df, F.col(f"`{y}`"), {"x": F.col(f"`{x}`")})).get("x", none)


def _mahonian_cdf(n: int, k: int) -> float:
    """P(inversions <= k) for a uniform random permutation of n items."""
    counts = np.zeros(k + 1, dtype=np.float64)
    counts[0] = 1.0
    for i in range(1, n + 1):
        nxt = np.zeros(k + 1)
        c = np.cumsum(counts)
        for j in range(k + 1):
            lo = j - (i - 1)
            nxt[j] = c[j] - (c[lo - 1] if lo >= 1 else 0.0)
        counts = nxt
    return float(counts.sum() / math.factorial(n))


def tau_b_from_stats(st: dict) -> tuple[float | None, float | None]:
    n = st["n"]
    if n < 2:
        return None, None
    tot = n * (n - 1) / 2
    xt1, xt0, xt2 = st["xtie"]
    yt1, yt0, yt2 = st["ytie"]
    den = math.sqrt((tot - xt1) * (tot - yt1)) if (tot - xt1) > 0 and (tot - yt1) > 0 else 0.0
    if den == 0:
        return None, None
    s = st["s"]
    tau = s / den
    if xt1 == 0 and yt1 == 0 and (n <= 33 or min((tot - s) / 2, (tot + s) / 2) <= 1):
        dis = int(round((tot - s) / 2))
        c = min(dis, int(tot) - dis)
        if c <= 1:  # 1 of n! orders, or n of them; in logarithms, as n! overflows
            p = min(1.0, math.exp(math.log(2.0) - math.lgamma(n + 1 - c)))
        else:
            p = min(1.0, 2.0 * _mahonian_cdf(n, c))
    else:
        m = n * (n - 1.0)
        var = ((m * (2 * n + 5) - xt2 - yt2) / 18 + (2 * xt1 * yt1) / m + xt0 * yt0 / (9 * m * (n - 2)))
        p = math.erfc(abs(s) / math.sqrt(var) / math.sqrt(2)) if var > 0 else None
    return tau, p


def kendall_tau(df: DataFrame, x: str, y: str) -> DataFrame:
    """V3: one-row ``n, kendalltau, kendalltau_pvalue``."""
    st = kendall_s_and_ties(df, x, y)
    return df.sparkSession.createDataFrame([(st["n"], *tau_b_from_stats(st))], "n long, kendalltau double, kendalltau_pvalue double")


def kendall_many(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """V3 for many features against one target: ``feature, n, kendalltau, kendalltau_pvalue``.

    All features run in the same jobs, keyed by feature."""
    found = _statistics(_points(df, F.col(f"`{target}`"), {f: F.col(f"`{f}`") for f in features}))
    rows = [(f, found[f]["n"], *tau_b_from_stats(found[f])) for f in features if f in found]
    return df.sparkSession.createDataFrame(rows, "feature string, n long, kendalltau double, kendalltau_pvalue double")
