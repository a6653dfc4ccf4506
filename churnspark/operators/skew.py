"""Skew correction.

Candidate transforms are scored by the bias-adjusted skew of the
transformed column.  All candidates of all columns are evaluated in one scan:
a task keeps four sums per candidate, whatever the number of rows.
Yeo-Johnson's lambda is the maximum-likelihood value: a grid that shares this
scan, then an interpolation of the likelihood between the best point's
neighbours.
"""
from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.exprs import adj_skew, as_double, is_numeric
from churnspark.operators.stage import JsonStateModel

log = logging.getLogger(__name__)

EPS = 1e-7


def _x(df: DataFrame, c: str) -> Column:
    dt = dict((f.name, f.dataType) for f in df.schema.fields)[c]
    return as_double(F.col(f"`{c}`"), dt)


def nan_to_null(e: Column) -> Column:
    return F.when(~F.isnan(e), e)


def power_expr(x: Column, p: float) -> Column:
    """K2: x ** p; a negative base with a fractional power is missing (numpy gives NaN)."""
    return nan_to_null(F.pow(x, F.lit(float(p))))


def log_expr(x: Column, shift: float = 0.0) -> Column:
    """K3: log(x + shift + 1e-7); non-positive arguments are missing."""
    a = x + F.lit(shift + EPS)
    return F.when(a > 0, F.log(a))


def reflect_log_expr(x: Column, max_value: float) -> Column:
    """K3 for negative skew: log(max + 1 - x + 1e-7)."""
    return log_expr(F.lit(max_value + 1.0) - x)


def yeo_expr(x: Column, lam: float) -> Column:
    """K4 Yeo-Johnson transform for a fixed lambda."""
    pos = (F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam))
    neg = (-F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / F.lit(2 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


# ------------------------------------------------------------------ moments of all candidates in one scan

MAX_CANDIDATES = 1_000_000


def _transformed(x: np.ndarray, kind: str, a: float, b: float) -> np.ndarray:
    """Values of one candidate; NaN where it is undefined."""
    if kind == "pow":
        return np.power(x, a)
    if kind == "log":
        return np.log(np.where(x + b + EPS > 0, x + b + EPS, np.nan))
    if kind == "rlog":
        return np.log(np.where(b + 1.0 - x + EPS > 0, b + 1.0 - x + EPS, np.nan))
    if kind == "slog":  # the logarithm of Yeo-Johnson's Jacobian, over (lambda - 1)
        return np.sign(x) * np.log1p(np.abs(x))
    up, down = np.maximum(x, 0.0), np.maximum(-x, 0.0)
    pos = np.log1p(up) if abs(a) < 1e-12 else (np.power(up + 1, a) - 1) / a
    neg = -np.log1p(down) if abs(a - 2) < 1e-12 else -(np.power(1 + down, 2 - a) - 1) / (2 - a)
    return np.where(x >= 0, pos, neg)


@dataclass
class Moments:
    """Count, mean and central power sums of a candidate's values."""
    n: int
    mean: float
    m2: float
    m3: float

    @property
    def variance(self) -> float:
        return self.m2 / self.n if self.n else math.nan

    @property
    def skew(self) -> float | None:
        """Bias-adjusted; None below three values or beyond the range of doubles."""
        if self.n < 3 or not math.isfinite(self.m3):
            return None
        k = float(self.n)
        m2, m3 = self.m2 / k, self.m3 / k
        return 0.0 if m2 <= 0 else math.sqrt(k * (k - 1)) / (k - 2) * m3 / m2 / math.sqrt(m2)


def centres(df: DataFrame, features: list[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(_x(df, f)).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return {f: row[f"m{i}"] for i, f in enumerate(features)}


def candidate_moments(df: DataFrame, rows: list[tuple], around: dict[str, float] | None = None) -> dict[tuple[str, str], Moments]:
    """Moments of every candidate ``(feature, name, kind, a, b)`` from one scan.

    Every task keeps four numbers per candidate: powers of the distance from
    the candidate's value at the feature's mean, which lies within the bulk of
    its values, so that the central moments do not cancel.  These add up over tasks."""
    if not rows:
        return {}
    if len(rows) > MAX_CANDIDATES:
        raise ValueError(f"{len(rows)} candidate transforms; at most {MAX_CANDIDATES} are tried at a time")
    feats = sorted({r[0] for r in rows})
    around = around or centres(df, feats)
    with np.errstate(all="ignore"):
        origin = [float(_transformed(np.array([around[f] if around[f] is not None else 0.0]), kind, a, b)[0]) for f, _, kind, a, b in rows]
    origin = [v if math.isfinite(v) else 0.0 for v in origin]

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((len(rows), 4))
        with np.errstate(all="ignore"):
            for batch in batches:
                values = [batch.column(i).drop_null().to_numpy(zero_copy_only=False) for i in range(len(feats))]
                for j, (f, _, kind, a, b) in enumerate(rows):
                    d = _transformed(values[feats.index(f)], kind, a, b) - origin[j]
                    d = d[~np.isnan(d)]
                    square = d * d
                    total[j] += len(d), d.sum(), square.sum(), (square * d).sum()
        yield pa.record_batch([pa.array(np.arange(len(rows), dtype=np.int32)), *(pa.array(total[:, k].copy()) for k in range(4))],
                              ["candidate", "n", "s1", "s2", "s3"])
    parts = df.select(*[_x(df, f).alias(f"x{i}") for i, f in enumerate(feats)]).mapInArrow(
        run, "candidate int, n double, s1 double, s2 double, s3 double")
    out = {}
    for r in parts.groupBy("candidate").agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2", "s3")]).collect():
        n, s1, s2, s3 = (r[c] for c in ("n", "s1", "s2", "s3"))
        off = s1 / n if n else 0.0
        f, name = rows[r["candidate"]][:2]
        out[f, name] = Moments(int(n), origin[r["candidate"]] + off, max(s2 - s1 * off, 0.0), s3 - 3 * off * s2 + 2 * off * off * s1)
    return out


def candidate_skews(df: DataFrame, rows: list[tuple], around: dict[str, float] | None = None) -> dict[tuple[str, str], float | None]:
    """Adjusted skew of every candidate."""
    found = candidate_moments(df, rows, around)
    return {(r[0], r[1]): found[r[0], r[1]].skew if (r[0], r[1]) in found else None for r in rows}


# ------------------------------------------------------------------ Yeo-Johnson fit

class LambdaSearch:
    """Maximum-likelihood lambda of one column: ``ask`` for lambdas to evaluate in the next scan, ``tell`` their variances.

    A grid first, moved on while the best lies at its edge.  Then the likelihood
    is interpolated through Chebyshev nodes between the best point's neighbours,
    and its maximum taken where the derivative vanishes; where the
    interpolation has not converged, again between the best node's neighbours."""

    GRID, NODES = 33, 17

    def __init__(self):
        self.low, self.high = -2.0, 2.0
        self.best, self.done, self.inside = 1.0, False, False

    def ask(self) -> list[float]:
        if self.done:
            return []
        if not self.inside:
            return [float(v) for v in np.linspace(self.low, self.high, self.GRID)]
        nodes = np.cos(np.pi * (np.arange(self.NODES) + 0.5) / self.NODES)[::-1]
        return [float(v) for v in (self.low + self.high) / 2 + (self.high - self.low) / 2 * nodes]

    def tell(self, n: int, log_sum: float, variances: list[float]) -> None:
        asked = self.ask()
        fit = np.array([-n / 2 * math.log(v) + (lam - 1) * log_sum if v and 1e-100 < v < 1e100 else -math.inf  # cubes stay within doubles
                        for lam, v in zip(asked, variances)])
        k = int(np.argmax(fit))
        if fit[k] == -math.inf:
            self.done = True
            return
        self.best = asked[k]
        width, step = self.high - self.low, (self.high - self.low) / (len(asked) - 1)
        if not self.inside and k in (0, self.GRID - 1):
            self.low, self.high = (self.low - 2 * width, self.low + step) if k == 0 else (self.high - step, self.high + 2 * width)
            return
        if self.inside and np.isfinite(fit).all():
            curve = np.polynomial.Chebyshev.fit(asked, (fit - fit[k]) / max(n, 1), self.NODES - 1, domain=[self.low, self.high])
            settled = np.abs(curve.coef[-2:]).max() <= 1e-11 * max(np.abs(curve.coef).max(), 1e-300)
            tops = [float(r.real) for r in curve.deriv().roots() if abs(r.imag) < 1e-9 and self.low <= r.real <= self.high]
            if settled or width <= 1e-6:
                self.best = max([*tops, self.best], key=curve)
                self.done = True
                return
        elif self.inside and width <= 1e-6:
            self.done = True
            return
        self.inside = True
        self.low, self.high = asked[max(k - 1, 0)], asked[min(k + 1, len(asked) - 1)]


def _search_rows(searches: dict[str, LambdaSearch]) -> list[tuple]:
    return [(c, f"y{j}", "yeo", lam, 0.0) for c, s in searches.items() for j, lam in enumerate(s.ask())]


def _tell(searches: dict[str, LambdaSearch], jacobian: dict[str, Moments], found: dict[tuple[str, str], Moments]) -> None:
    for c, s in searches.items():
        if not s.done:
            asked = range(len(s.ask()))
            s.tell(jacobian[c].n, jacobian[c].n * jacobian[c].mean, [found[c, f"y{j}"].variance for j in asked])


def fit_yeo_lambdas(df: DataFrame, columns: list[str], around: dict[str, float] | None = None) -> dict[str, float]:
    """K4: lambda maximising -n/2 log(var_pop(yj(x))) + (lambda - 1) * sum(sign(x) log1p|x|), for all columns together.

    Two scans where the optimum lies between -2 and 2; one more each time it lies beyond."""
    return _finish_lambdas(df, {c: LambdaSearch() for c in columns}, {}, around or (centres(df, columns) if columns else {}))


def _finish_lambdas(df, searches: dict[str, LambdaSearch], jacobian: dict[str, Moments], around: dict[str, float]) -> dict[str, float]:
    while any(not s.done for s in searches.values()):
        extra = [(c, "slog", "slog", 0.0, 0.0) for c in searches if c not in jacobian]
        found = candidate_moments(df, _search_rows(searches) + extra, around)
        jacobian.update({c: found[c, "slog"] for c, *_ in extra})
        _tell(searches, jacobian, found)
    return {c: s.best for c, s in searches.items()}


class YeoJohnson(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """K4 as a stage: per-column lambda, then standardised to mean 0 and population std 1."""

    inputCols = Param(Params._dummy(), "inputCols", "", TypeConverters.toListString)
    standardize = Param(Params._dummy(), "standardize", "", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, standardize=True):
        super().__init__()
        self._setDefault(inputCols=[], standardize=True)
        self._set(**self._input_kwargs)
        self._known_lambdas = None
        self._known_scale = None

    def with_lambdas(self, lambdas: dict, scale: dict | None = None) -> "YeoJohnson":
        """Lambdas (and means and deviations) that are known already: the fit needs no scan for them."""
        self._known_lambdas, self._known_scale = dict(lambdas), dict(scale or {})
        return self

    def _fit(self, df):
        cols = self.getOrDefault(self.inputCols)
        known = self._known_lambdas or {}
        lams = {c: known[c] for c in cols if c in known}
        lams.update(fit_yeo_lambdas(df, [c for c in cols if c not in lams]))
        scale = {}
        if cols and self.getOrDefault(self.standardize):
            scale = {c: v for c, v in (self._known_scale or {}).items() if c in cols}
            rest = [c for c in cols if c not in scale]
            if rest:
                row = df.agg(*[F.avg(yeo_expr(_x(df, c), lams[c])).alias(f"m{i}") for i, c in enumerate(rest)],
                             *[F.stddev_pop(yeo_expr(_x(df, c), lams[c])).alias(f"s{i}") for i, c in enumerate(rest)]).first()
                scale.update({c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(rest)})
        return YeoJohnsonModel(state={"lambdas": lams, "scale": scale})


class YeoJohnsonModel(JsonStateModel):
    def exprs(self, df):
        st = self.fitted
        out = {}
        for c, lam in st["lambdas"].items():
            e = yeo_expr(_x(df, c), lam)
            if c in st["scale"]:
                m, s = st["scale"][c]
                e = (e - F.lit(m)) / F.lit(s if s else 1.0)
            out[c] = e
        return out

    def _transform(self, df):
        return df.withColumns(self.exprs(df))


# ------------------------------------------------------------------ candidate evaluation (K5-K7)

def power_grid(max_power: float = 50, num: int = 100) -> list[float]:
    return [float(p) for p in np.linspace(1.01, max_power, num)]


def evaluate_candidates(df: DataFrame, features: list[str], skews: dict[str, float], skew_threshold: float = 0.5,
                        max_power: float = 50, round_to: int = 4, lambdas: dict | None = None, scale: dict | None = None,
                        stats: "ColumnStats | None" = None) -> dict[str, dict[str, float]]:
    """K5-K6 for many features: ``{feature: {candidate name: skew}}`` (insertion order as the reference).

    All candidates and the first Yeo-Johnson grid share one scan, the lambdas
    take one more, the transform at these lambdas a third.  ``lambdas`` and
    ``scale`` receive the fitted lambdas and the means and deviations there,
    ``stats`` spares the scan for least, greatest and mean values."""
    feats = [f for f in features if skews.get(f) is not None and abs(skews[f]) > skew_threshold]
    if not feats:
        return {}
    stats = stats or column_stats(df, feats)
    grid = power_grid(max_power)
    rows = []
    for f in feats:
        lo, hi = stats.least[f], stats.greatest[f]
        if skews[f] > 0:
            rows += [(f, f"p{j}", "pow", 1.0 / p, 0.0) for j, p in enumerate(grid)]
            rows.append((f, "log", "log", 0.0, abs(lo) + 1 if lo is not None and lo < 0 else 0.0))
        else:
            rows += [(f, "2", "pow", 2.0, 0.0), (f, "3", "pow", 3.0, 0.0), (f, "log", "rlog", 0.0, float(hi))]
        rows.append((f, "slog", "slog", 0.0, 0.0))
    searches = {f: LambdaSearch() for f in feats}
    found = candidate_moments(df, rows + _search_rows(searches), stats.mean)
    jacobian = {f: found[f, "slog"] for f in feats}
    _tell(searches, jacobian, found)
    yeo = _finish_lambdas(df, searches, jacobian, stats.mean)
    at = candidate_moments(df, [(f, "yeo", "yeo", yeo[f], 0.0) for f in feats], stats.mean)  # standardising does not change skew
    if lambdas is not None:
        lambdas.update(yeo)
    if scale is not None:
        scale.update({f: (at[f, "yeo"].mean, math.sqrt(at[f, "yeo"].variance) or 1.0) for f in feats})
    sk = {k: m.skew for k, m in {**found, **at}.items()}
    results = {}
    for f in feats:
        res = {}
        if skews[f] > 0:
            valid = {p: sk[f, f"p{j}"] for j, p in enumerate(grid) if sk.get((f, f"p{j}")) is not None}
            if valid:
                p_best = min(valid, key=lambda p: abs(valid[p]))
                res[f"{round(1 / p_best, round_to)}"] = round(valid[p_best], round_to)
        else:
            res.update({"2": sk.get((f, "2")), "3": sk.get((f, "3"))})
        res.update({"log": sk.get((f, "log")), "yeo": sk.get((f, "yeo"))})
        results[f] = {k: v for k, v in res.items() if v is not None}
    return results


def select_best_transformation(results: dict[str, float], final_threshold: float = 0.1) -> tuple[str, bool]:
    """K7: first candidate with the smallest |skew|; success when it is within the threshold."""
    best = min(results, key=lambda k: abs(results[k]))
    return best, abs(results[best]) <= final_threshold


@dataclass
class ColumnStats:
    skew: dict[str, float]
    least: dict[str, float]
    greatest: dict[str, float]
    mean: dict[str, float]


def column_stats(df: DataFrame, features: list[str]) -> ColumnStats:
    """Adjusted skew, least, greatest and mean value of each feature: one aggregate."""
    aggs = [f(_x(df, c)).alias(f"{t}{i}") for i, c in enumerate(features)
            for f, t in ((adj_skew, "s"), (F.min, "a"), (F.max, "b"), (F.avg, "m"))]
    row = df.agg(*aggs).first()
    return ColumnStats(*({c: row[f"{t}{i}"] for i, c in enumerate(features)} for t in "sabm"))


def subsample(df: DataFrame, feature: str, limit: int = 5000, seed: int = 42) -> DataFrame:
    """K1 (optional): rows without a missing feature; at most ``limit`` rows chosen by a seeded hash.

    The cut-off hash is the ``limit``-th smallest, found by a distributed
    top-k (``orderBy().limit()`` keeps only ``limit`` rows per task)."""
    base = df.where(_x(df, feature).isNotNull())
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed))
    tagged = base.withColumn("__h", h)
    cut = tagged.select("__h").orderBy("__h").limit(limit).agg(F.max("__h")).scalar()
    return tagged.where(F.col("__h") <= cut).drop("__h")


def correct_skew(df: DataFrame, feature: str, max_power: float = 50, initial_skew_threshold: float = 0.5,
                 final_skew_threshold: float = 0.1, subsample_limit: int | None = None):
    """``(frame, results, transformation)``.

    Rows with the feature missing are dropped (as the reference).  When the
    skew is small the frame comes back unchanged with ``None, None``.
    Otherwise ``<feature>_transformed`` (best candidate within the final
    threshold) or ``<feature>_binary`` (fallback) is added.
    """
    base = df.where(_x(df, feature).isNotNull())
    stats = column_stats(base, [feature])
    skew, lo, hi = stats.skew[feature], stats.least, stats.greatest
    if skew is None or abs(skew) < initial_skew_threshold:
        return base, None, None
    cand_df = subsample(base, feature, subsample_limit) if subsample_limit else base
    own = column_stats(cand_df, [feature]) if subsample_limit else stats
    lambdas, scale = {}, {}
    results = evaluate_candidates(cand_df, [feature], own.skew, initial_skew_threshold, max_power, lambdas=lambdas, scale=scale,
                                  stats=own).get(feature)
    if not results:
        return base, None, None
    best, ok = select_best_transformation(results, final_skew_threshold)
    x = _x(base, feature)
    if not ok:
        return fallback_to_binary(base, feature, skew > 0, lo[feature], hi[feature]), results, "Converted to binary"
    known = {} if subsample_limit else {"lam": lambdas[feature], "scale": scale[feature]}  # fitted on a part: again on all rows
    return base.withColumn(f"{feature}_transformed",
                           transform_expr(base, feature, best, skew > 0, lo[feature], hi[feature], x, **known)), results, best


def transform_expr(df: DataFrame, feature: str, name: str, skew_positive: bool, lo, hi, x=None, lam: float | None = None,
                   scale: tuple[float, float] | None = None) -> Column:
    """K8: the column expression of a chosen candidate; without ``lam``, Yeo-Johnson's is fitted on ``df``."""
    x = x if x is not None else _x(df, feature)
    if name == "log":
        if skew_positive:
            return log_expr(x, abs(lo) + 1 if lo is not None and lo < 0 else 0.0)
        return reflect_log_expr(x, hi)
    if name == "yeo":
        stage = YeoJohnson(inputCols=[feature])
        if lam is not None:
            stage = stage.with_lambdas({feature: lam}, {feature: scale} if scale else None)
        return stage.fit(df).exprs(df)[feature]
    return power_expr(x, float(name))


def fallback_to_binary(df: DataFrame, feature: str, skew_positive: bool, lo, hi) -> DataFrame:
    """K9: ``<feature>_binary``: positive skew ``x != min``, negative skew ``x == max`` (missing -> 1 / 0)."""
    x = F.col(f"`{feature}`")
    if skew_positive:
        e = F.coalesce((x != F.lit(lo)).cast("int"), F.lit(1))
    else:
        e = F.coalesce((x == F.lit(hi)).cast("int"), F.lit(0))
    return df.withColumn(f"{feature}_binary", e)


def binary_expr(x: Column, lo, hi, skew_positive: bool) -> Column:
    """K12 rule: skew > 0 -> ``x != min``, else ``x != max``; missing compares unequal (1)."""
    ref = lo if skew_positive else hi
    return F.coalesce((x != F.lit(ref)).cast("int"), F.lit(1))


def convert_to_binary(df: DataFrame, features: list[str], mins: dict, maxs: dict, direction: dict | None = None) -> DataFrame:
    """K12 for several features; direction from the batch's own skew unless given."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"features not in the frame: {missing}")
    if direction is None:
        sk = column_stats(df, features).skew
        direction = {f: (sk[f] or 0) > 0 for f in features}
    return df.withColumns({f: binary_expr(F.col(f"`{f}`"), mins[f], maxs[f], direction[f]) for f in features})


def compose_transforms(df: DataFrame, yeo_model: YeoJohnsonModel | None = None, binary: dict | None = None,
                       power: dict[str, float] | None = None) -> DataFrame:
    """Yeo / binary / power column sets in one projection, the rest passed through."""
    cols = {}
    if yeo_model is not None:
        cols.update(yeo_model.exprs(df))
    for f, (lo, hi, positive) in (binary or {}).items():
        cols[f] = binary_expr(F.col(f"`{f}`"), lo, hi, positive)
    for f, p in (power or {}).items():
        cols[f] = power_expr(_x(df, f), p)
    return df.withColumns(cols)


class ReduceSkew(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Pick a transform per skewed numeric column on the training frame.

    ``direction``: ``"fit"`` freezes the binary direction at fit time;
    ``"batch"`` recomputes it from the skew of the frame being transformed.
    """

    skewThreshold = Param(Params._dummy(), "skewThreshold", "", TypeConverters.toFloat)
    direction = Param(Params._dummy(), "direction", "fit or batch", TypeConverters.toString)
    exclude = Param(Params._dummy(), "exclude", "columns left alone (keys, labels)", TypeConverters.toListString)

    @keyword_only
    def __init__(self, skewThreshold=0.5, direction="fit", exclude=None):
        super().__init__()
        self._setDefault(skewThreshold=0.5, direction="fit", exclude=[])
        self._set(**self._input_kwargs)

    def _fit(self, df):
        thr = self.getOrDefault(self.skewThreshold)
        ex = set(self.getOrDefault(self.exclude))
        feats = [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]
        if not feats:
            return ReduceSkewModel(state={"choices": {}, "yeo": None})
        stats = column_stats(df, feats)
        sk, lo, hi = stats.skew, stats.least, stats.greatest
        skewed = [f for f in feats if sk[f] is not None and abs(sk[f]) > thr]
        lambdas, scale = {}, {}
        results = evaluate_candidates(df, skewed, sk, thr, lambdas=lambdas, scale=scale, stats=stats)
        choices = {}
        for f in skewed:
            if not results.get(f):
                continue
            best, ok = select_best_transformation(results[f])
            kind = best if ok else "Converted to binary"
            if kind not in ("Converted to binary", "yeo") and lo[f] is not None and lo[f] < 0:
                kind = "yeo"
            choices[f] = {"kind": kind, "min": lo[f], "max": hi[f], "positive": (sk[f] or 0) > 0}
        yeo_cols = [f for f, c in choices.items() if c["kind"] == "yeo"]
        yeo = YeoJohnson(inputCols=yeo_cols).with_lambdas(lambdas, scale).fit(df).fitted if yeo_cols else None
        return ReduceSkewModel(state={"choices": choices, "yeo": yeo, "direction": self.getOrDefault(self.direction)})


class ReduceSkewModel(JsonStateModel):
    def _transform(self, df):
        st = self.fitted
        ch = st["choices"]
        bins = [f for f, c in ch.items() if c["kind"] == "Converted to binary" and f in df.columns]
        positive = {f: ch[f]["positive"] for f in bins}
        if bins and st.get("direction") == "batch":
            sk = column_stats(df, bins).skew
            positive = {f: (sk[f] or 0) > 0 for f in bins}
        cols = {}
        for f, c in ch.items():
            if f not in df.columns:
                continue
            x = _x(df, f)
            if c["kind"] == "Converted to binary":
                cols[f] = binary_expr(F.col(f"`{f}`"), c["min"], c["max"], positive[f])
            elif c["kind"] == "log":
                cols[f] = (log_expr(x, abs(c["min"]) + 1 if c["min"] is not None and c["min"] < 0 else 0.0)
                           if c["positive"] else reflect_log_expr(x, c["max"]))
            elif c["kind"] != "yeo":
                cols[f] = power_expr(x, float(c["kind"]))
        if st.get("yeo"):
            cols.update(YeoJohnsonModel(state=st["yeo"]).exprs(df))
        return df.withColumns(cols)
