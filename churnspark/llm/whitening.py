"""Embedding whitening from exact variances alone.

Covariances come by polarisation: Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2,
so the only aggregates are sums of squares, one for each dimension and one for
the sum of each pair of dimensions.  Vectors are whole numbers here (64 steps
to a unit), centred on the whole number nearest to the mean before they are
squared; what the nearest whole number leaves of the mean is taken off the
total exactly, so every variance is a fraction without a rounding error, and
the matrix for ``eigh`` is rounded once, at its end.

Two passes over the distinct vectors (sums, squares), one for the check of the
result, and one over the rows.  Partial results leave a partition as one row
per dimension pair; the driver holds the dimension's square of numbers, never
vectors.
"""
from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save

#: Fixed by the contract: steps to a unit, the shift, components returned.
STEPS, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Whole numbers stay below this in magnitude; larger entries count as this.
LARGEST = float(1 << 60)
#: Rows that a task turns to numbers at a time, and numbers it squares at a time.
ROWS, CELLS = 4096, 1 << 21


@dataclass
class Whitener:
    """What a fit keeps: the number of distinct vectors, their sums, unit components by falling eigenvalue."""
    n: int
    sums: list[int]
    components: np.ndarray  # one row per component
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); nan for directions in which the fit list does not vary."""
        least = len(self.sums) * np.finfo(float).eps * max(self.eigenvalues[0], 0.0) if len(self.eigenvalues) else 0.0
        return np.array([1 / np.sqrt(e) if e > least else np.nan for e in self.eigenvalues])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: whole numbers of 64 bits where they fit, else Python's."""
        sums = np.array(self.sums, object)
        if x.size and max(int(np.abs(x).max()), 1) * self.n + max(map(abs, self.sums)) < 1 << 62:
            return x * np.int64(self.n) - sums.astype(np.int64)
        return x.astype(object) * self.n - sums

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ (self.components * self.scales[:, None]).T


def usable(rows: DataFrame, vector_col: str) -> DataFrame:
    """Rows with a vector of one entry at least, all of them finite."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(v.isNotNull() & (F.size(v) > 0) & finite)


def whole(vector_col: str):
    """floor(64 c) + 1,000,000 of every entry c."""
    return F.transform(F.col(vector_col).cast("array<double>"), lambda c: F.floor(
        F.greatest(F.least(c * F.lit(float(STEPS)), F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(SHIFT))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def pairs(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension pairs a <= b; a = b stands for the dimension itself."""
    return np.triu_indices(width)


def exact_squares(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums over rows of (y[a] + y[b])^2 (of y[a]^2 where a = b), as Python numbers if 64 bits could overflow."""
    most = 2 * int(max(np.abs(y).max(), 1)) if y.size else 1
    if most * most * max(len(y), 1) >= 1 << 62:
        y = y.astype(object)
    total, step = np.zeros(len(a), object), max(1, CELLS // max(len(y), 1))
    for at in range(0, len(a), step):
        left, right = a[at:at + step], b[at:at + step]
        both = np.where(left == right, 0, 1) * y[:, right] + y[:, left]
        total[at:at + step] = (both * both).sum(axis=0).tolist()
    return total


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitener | None:
    """Fit on a table of distinct vectors (column ``x``: array<bigint> of ``width`` entries)."""
    totals = distinct.select(F.count("*"), *[F.sum(F.col("x")[k].cast("decimal(38,0)")) for k in range(width)]).first()
    n, sums = totals[0], [int(t) if t is not None else 0 for t in totals[1:]]
    if not n:
        return None
    middle = [(2 * s + n) // (2 * n) for s in sums]  # nearest whole numbers to the means
    a, b = pairs(width)

    def squares(batches):
        total = np.zeros(len(a), object)
        shift = np.array(middle, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total = total + exact_squares(matrix(batch.column(0).slice(at, ROWS), width) - shift, a, b)
        yield pa.record_batch([pa.array(range(len(a)), pa.int32()), pa.array([str(t) for t in total])], ["pair", "part"])
    parts = distinct.select("x").mapInArrow(squares, "pair int, part string")
    found = parts.groupBy("pair").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    square = [0] * len(a)
    for r in found:
        square[r["pair"]] = int(r["total"])
    # Sum of (n z - sum z)^2 = n^2 sum y^2 - n (sum y)^2 with y = z - middle, for z a dimension or a pair's sum.
    rest = [s - n * m for s, m in zip(sums, middle)]
    variance = {}
    for p, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        left = rest[i] if i == j else rest[i] + rest[j]
        variance[i, j] = Fraction(n * square[p] - left * left, n * n)
    v = np.empty((width, width))
    for i, j in variance:
        v[i, j] = v[j, i] = float(variance[i, i] if i == j else (variance[i, j] - variance[i, i] - variance[j, j]) / 2)
    values, vectors = np.linalg.eigh(v)
    top = np.argsort(-values, kind="stable")[:components]
    model = Whitener(n, sums, vectors.T[top], values[top], float(sum(variance[i, i] for i in range(width))))
    model.identity_error = identity_error(distinct, model)
    return model


def identity_error(distinct: DataFrame, model: Whitener) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity), over directions that vary."""
    live = np.flatnonzero(~np.isnan(model.scales))
    if not len(live):
        return None
    width, k = len(model.sums), len(live)

    def moments(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                z = model.whiten(model.centred(matrix(batch.column(0).slice(at, ROWS), width)))[:, live]
                first += z.sum(axis=0)
                second += z.T @ z
        yield pa.record_batch([pa.array(range(k + k * k), pa.int32()), pa.array(np.concatenate([first, second.ravel()]))], ["at", "part"])
    sums = distinct.select("x").mapInArrow(moments, "at int, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    flat = np.zeros(k + k * k)
    for r in sums:
        flat[r["at"]] = r["part"]
    mean = flat[:k] / model.n
    return float(np.abs(flat[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten_embeddings(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    Null vectors, vectors with a null or non-finite entry and empty vectors
    are dropped; where lengths differ, only vectors of the commonest length
    (ties: the longest) remain, counted over distinct vectors.  Rows that
    repeat an id stay, each with its own result.  ``deviation`` is null where
    it exceeds a long; ``whitened`` is null along directions in which the fit
    list does not vary, and ``explained`` is null where nothing varies.  Any
    other columns are ignored."""
    spark = rows.sparkSession
    own = usable(rows, vector_col).select(F.col(id_col).cast("long").alias("id"), whole(vector_col).alias("x"))
    distinct = save(own.select("x").distinct(), "whitening-vectors")
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = distinct.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        discard(distinct)
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    width = lengths["width"]
    model = fit(distinct.where(F.size("x") == width), width, components)
    discard(distinct)
    explained = model.eigenvalues / model.trace if model.trace else np.full(len(model.eigenvalues), np.nan)
    k = len(model.eigenvalues)

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                m = part.num_rows
                centred = model.centred(matrix(part.column(1), width))
                bounded = m and int(np.abs(centred).max()) ** 2 * width < 1 << 62
                far = (centred * centred if bounded else centred.astype(object) ** 2).sum(axis=1).tolist()
                z = model.whiten(centred).ravel()
                shares = np.tile(explained, m)
                yield pa.record_batch([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array([d if d < 1 << 63 else None for d in far], pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z, mask=np.isnan(z)), pa.array(shares, mask=np.isnan(shares)),
                    pa.array([model.identity_error] * (m * k), pa.float64())],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return own.where(F.size("x") == width).mapInArrow(project, schema).withColumnRenamed("id", id_col)
