"""Iterative regression imputer (O9): round-robin Bayesian ridge from sufficient statistics.

Per round and per target column (fewest missing first) a ridge is fitted on
the rows where the target is observed and its line fills the missing entries.
Start: column means.  Stop: the largest row sum of absolute changes is below
``tol * max |observed value|``.

The fits need no data but Gram matrices.  Rows that miss the same targets are
one *pattern*; in a pattern every filled value is the same affine map of the
row as it stood at the start, whatever the round.  So one scan gathers a Gram
matrix per pattern, all rounds run on these matrices, one scan measures the
change of every round, and the values of the last round are one pass of
matrix products.  Where there are too many patterns for the driver
(``MAX_NUMBERS``), each target's Gram matrix takes a scan instead, with the
same result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.session import drop_scratch, scratch_table

#: Numbers that the Gram matrices and the maps of all patterns and rounds may hold together on the driver.
MAX_NUMBERS = 8_000_000
_HYPER = 1e-6  # alpha_1 = alpha_2 = lambda_1 = lambda_2


def _matrix(batch: pa.RecordBatch, first: int, width: int) -> np.ndarray:
    """Rows of [1, columns first..first + width]."""
    out = np.ones((batch.num_rows, width + 1))
    for j in range(width):
        out[:, j + 1] = batch.column(first + j).to_numpy(zero_copy_only=False)
    return out


def _grams(rows: DataFrame, width: int) -> dict[bytes, np.ndarray]:
    """Pattern -> Gram matrix of [1, columns], from one scan of ``(pattern, columns...)``; partial sums per task."""
    def run(batches: Iterator[pa.RecordBatch]):
        total: dict[bytes, np.ndarray] = {}
        for b in batches:
            z = _matrix(b, 1, width)
            kinds, which = np.unique(np.array(b.column(0).to_pylist(), object), return_inverse=True)
            for k, kind in enumerate(kinds):
                part = z[which == k]
                total[kind] = total.get(kind, 0.0) + part.T @ part
        for kind, g in total.items():
            yield pa.record_batch([pa.array([kind] * g.size, pa.binary()), pa.array(np.arange(g.size, dtype=np.int32)), pa.array(g.ravel())],
                                  ["pattern", "cell", "value"])
    sums = rows.mapInArrow(run, "pattern binary, cell int, value double").groupBy("pattern", "cell").agg(F.sum("value").alias("value"))
    out: dict[bytes, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(bytes(r["pattern"]), np.zeros((width + 1) ** 2))[r["cell"]] = r["value"]
    return {k: g.reshape(width + 1, width + 1) for k, g in out.items()}


def _fit(gram: np.ndarray, t: int) -> np.ndarray:
    """Row of an affine map [intercept, coefficients] that predicts column ``t`` (its own coefficient 0)."""
    others = [j for j in range(1, len(gram)) if j != t]
    coef, intercept = bayesian_ridge(gram[0, 0], gram[0, others], gram[0, t], gram[np.ix_(others, others)], gram[others, t], gram[t, t])
    line = np.zeros(len(gram))
    line[0], line[others] = intercept, coef
    return line


def bayesian_ridge(n, sx, sy, gram, xy, yy, max_iter: int = 300, tol: float = 1e-3):
    """Bayesian ridge (evidence maximisation) from sufficient statistics; returns (coef, intercept)."""
    p = len(sx)
    if n == 0:
        return np.zeros(p), 0.0
    xm, ym = sx / n, sy / n
    g = gram - n * np.outer(xm, xm)                 # centred X'X
    c = xy - n * xm * ym                            # centred X'y
    yy_c = yy - n * ym * ym                         # centred y'y
    eps = np.finfo(np.float64).eps
    alpha = 1.0 / (yy_c / n + eps)
    lam = 1.0
    ev, v = np.linalg.eigh(g)
    ev = np.clip(ev, 0.0, None)
    vt_c = v.T @ c

    def coef_rmse(alpha, lam):
        coef = v @ (vt_c / (ev + lam / alpha))
        rmse = yy_c - 2 * coef @ c + coef @ g @ coef
        return coef, max(rmse, 0.0)

    coef_old = None
    for it in range(max_iter):
        coef, rmse = coef_rmse(alpha, lam)
        gamma = np.sum((alpha * ev) / (lam + alpha * ev))
        lam = (gamma + 2 * _HYPER) / (np.sum(coef ** 2) + 2 * _HYPER)
        alpha = (n - gamma + 2 * _HYPER) / (rmse + 2 * _HYPER)
        if coef_old is not None and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef.copy()
    coef, _ = coef_rmse(alpha, lam)
    return coef, float(ym - xm @ coef)


def _rounds(grams: dict[bytes, np.ndarray], targets: list[int], max_iter: int) -> list[dict[bytes, np.ndarray]]:
    """Per round: pattern -> affine map from a row at the start to the row after the round."""
    size = len(next(iter(grams.values())))
    now = {k: np.eye(size) for k in grams}
    out = []
    for _ in range(max_iter):
        for i, t in enumerate(targets):
            held = [k for k in grams if not k[i]]
            line = _fit(sum(now[k] @ grams[k] @ now[k].T for k in held), t) if held else np.zeros(size)
            for k in grams:
                if k[i]:
                    now[k] = now[k].copy()
                    now[k][t] = line @ now[k]
        out.append(dict(now))
    return out


def _largest_changes(rows: DataFrame, width: int, targets: list[int], rounds: list[dict[bytes, np.ndarray]]) -> list[float]:
    """Per round the largest row sum of absolute changes of the targets; one scan for all rounds."""
    start = {k: np.eye(width + 1) for k in rounds[0]}
    steps = [{k: (m[k] - before[k])[targets] for k in m if any(k)} for before, m in zip([start, *rounds], rounds)]

    def run(batches: Iterator[pa.RecordBatch]):
        most = np.zeros(len(steps))
        for b in batches:
            z = _matrix(b, 1, width)
            kinds, which = np.unique(np.array(b.column(0).to_pylist(), object), return_inverse=True)
            for k, kind in enumerate(kinds):
                if any(kind):
                    part = z[which == k].T
                    most = np.maximum(most, [np.abs(s[kind] @ part).sum(axis=0).max() for s in steps])
        yield pa.record_batch([pa.array(np.arange(len(steps), dtype=np.int32)), pa.array(most)], ["round", "most"])
    found = rows.mapInArrow(run, "round int, most double").groupBy("round").agg(F.max("most").alias("most")).collect()
    return [m for _, m in sorted((r["round"], r["most"]) for r in found)]


def iterative_impute(df: DataFrame, targets: list[str] | None = None, predictors: list[str] | None = None,
                     max_iter: int = 10, tol: float = 1e-3) -> DataFrame:
    """Fill missing values of ``targets`` from ``predictors`` (numeric; dummies added for strings).

    NaN counts as missing.  Observed values stay as they are; a column without
    any observed value is filled with 0.  Other columns pass through."""
    from churnspark.functions.exprs import is_boolean, is_numeric
    from churnspark.operators.encode import categories
    dt = dict((f.name, f.dataType) for f in df.schema.fields)
    predictors = list(predictors or df.columns)
    strings = [c for c in predictors if dt[c].simpleString() == "string"]
    cats = categories(df, strings) if strings else {}
    number = {c: F.col(f"`{c}`").cast("double") for c in predictors if is_numeric(dt[c]) or is_boolean(dt[c])}
    value = {c: F.when(~F.isnan(v), v) for c, v in number.items()}
    for c in strings:
        for v in cats[c][1:]:  # dummies, first category dropped
            value[f"{c}={v}"] = F.coalesce((F.col(f"`{c}`") == F.lit(v)).cast("double"), F.lit(0.0))
    cols = list(value)
    if not cols:
        return df
    row = df.agg(*[f(value[c]).alias(f"{t}{i}") for i, c in enumerate(cols) for f, t in (
        (lambda x: F.count_if(x.isNull()), "n"), (F.avg, "m"), (lambda x: F.max(F.abs(x)), "a"))]).first()
    miss = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    mean = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(cols)}
    enough = tol * max(row[f"a{i}"] or 0.0 for i in range(len(cols)))
    targets = [c for c in (targets or cols) if c in number and miss[c] > 0]
    if not targets:
        return df
    targets.sort(key=lambda c: miss[c])
    places = [cols.index(c) + 1 for c in targets]
    # Columns less their means: what is missing starts as 0, and the Gram matrices do not cancel.
    pattern = F.concat(*[F.when(value[c].isNull(), F.lit(b"\1")).otherwise(F.lit(b"\0")) for c in targets])
    centred = [F.coalesce(value[c] - F.lit(mean[c]), F.lit(0.0)) for c in cols]
    rows = df.select(pattern.alias("pattern"), *[x.alias(f"x{i}") for i, x in enumerate(centred)])
    width = len(cols)
    kinds = rows.select("pattern").distinct().limit(MAX_NUMBERS // ((width + 1) ** 2 * (max_iter + 1)) + 1).count()
    if kinds * (width + 1) ** 2 * (max_iter + 1) > MAX_NUMBERS:
        return _impute_by_scans(df, targets, places, pattern, centred, mean, max_iter, enough)
    rounds = _rounds(_grams(rows, width), places, max_iter)
    changes = _largest_changes(rows, width, places, rounds)
    final = rounds[next((i for i, m in enumerate(changes) if m < enough), max_iter - 1)]
    lines = {k: m[places] for k, m in final.items()}
    means = np.array([mean[c] for c in targets])
    names, n = df.columns, len(df.columns)
    at = [names.index(c) for c in targets]

    def fill(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            z = _matrix(b, n + 1, width)
            kinds, which = np.unique(np.array(b.column(n).to_pylist(), object), return_inverse=True)
            own = [b.column(j) for j in range(n)]
            for i, place in enumerate(at):
                new = b.column(n + 1 + width + i).to_numpy(zero_copy_only=False).astype(np.float64)
                for k, kind in enumerate(kinds):
                    if kind[i]:
                        new[which == k] = z[which == k] @ lines[kind][i] + means[i]
                own[place] = pa.array(new)
            yield pa.record_batch(own, names)
    wide = df.select(*[F.col(f"`{c}`") for c in names], pattern.alias("pattern"), *centred, *[value[c] for c in targets])
    schema = T.StructType([T.StructField(f.name, T.DoubleType() if f.name in targets else f.dataType) for f in df.schema.fields])
    return wide.toDF(*[f"c{i}" for i in range(len(wide.columns))]).mapInArrow(fill, schema)


def _impute_by_scans(df: DataFrame, targets: list[str], places: list[int], pattern: Column, centred: list[Column], mean: dict[str, float],
                     max_iter: int, enough: float) -> DataFrame:
    """The same rounds with one scan per target: for more patterns than the driver may hold.  Each round is a written table."""
    xs = [f"x{i}" for i in range(len(centred))]
    missing = [F.substring("pattern", i + 1, 1) == F.lit(b"\1") for i in range(len(targets))]
    work = scratch_table(df.select(*[F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(df.columns)], pattern.alias("pattern"),
                                   *[x.alias(n) for x, n in zip(centred, xs)]), "impute-round")
    kept = work.columns
    for _ in range(max_iter):
        now = work.select(*kept, *[F.col(f"x{t - 1}").alias(f"was{t}") for t in places])
        for t, gone in zip(places, missing):
            gram = _grams(now.where(~gone).select(F.lit(b"").alias("pattern"), *xs), len(xs)).get(b"")
            line = _fit(gram, t) if gram is not None else np.zeros(len(xs) + 1)
            guess = sum((F.lit(float(b)) * F.col(x) for b, x in zip(line[1:], xs)), F.lit(float(line[0])))
            now = now.withColumn(f"x{t - 1}", F.when(gone, guess).otherwise(F.col(f"x{t - 1}")))
        change = sum((F.abs(F.col(f"x{t - 1}") - F.col(f"was{t}")) for t in places), F.lit(0.0))
        before, work = work, scratch_table(now.withColumn("change", change).select(*kept, "change"), "impute-round")
        drop_scratch(before)
        if (work.agg(F.max("change")).first()[0] or 0.0) < enough:
            break
    out = {c: F.col(f"own{i}") for i, c in enumerate(df.columns)}
    for c, t, gone in zip(targets, places, missing):
        out[c] = F.when(gone, F.col(f"x{t - 1}") + F.lit(mean[c])).otherwise(out[c].cast("double"))
    return work.select(*[e.alias(c) for c, e in out.items()])
