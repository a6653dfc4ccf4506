"""Exact nearest neighbours under any density and any true metric.

The points are dealt into leaves of a partition tree: recursive splits at the
median of the widest coordinate, taken from a sample that only decides how even
the leaves are, never what is found.  Three facts keep the search exact and
far from all pairs:

* inside its own leaf every point finds k neighbours, which bound the
  distance r beyond which nothing matters to it;
* the box of every other leaf gives a lower bound on all distances into it, so
  a point visits a leaf only where that bound is at most r;
* boxes are visited in order of their bounds, a few first, which shrinks r
  before the rest is considered.

A dense region only has more leaves; a far outlier only visits more of them.
Inside a task the same search runs over small blocks of a leaf.

Coordinates of the tree are the features for the Minkowski family and unit
vectors for the cosine and correlation distances; for every other metric
they are distances to a few pivots, as |d(p, v) - d(q, v)| <= d(p, q) by the
triangle inequality.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.session import drop_scratch, scratch_table

#: Points of a leaf, points of a block inside a task, sampled points a leaf.
LEAF, BLOCK, SAMPLE = 20_000, 256, 32
#: Pivots of a metric that has no coordinates of its own.
PIVOTS = 6
#: Leaves that a point visits in its second round, and the growth from round to round.
FIRST_VISITS, MORE_VISITS = 8, 8
#: Leaves of a tree (its splits and boxes travel with every task).
MAX_LEAVES = 1 << 20

Distance = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _summed(of, x, y):
    """Sum over features of ``of(x, y)`` for all pairs of rows, feature by feature."""
    total = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        total += of(x[:, None, j], y[None, :, j])
    return total


def manhattan(x, y):
    return _summed(lambda a, b: np.abs(a - b), x, y)


def euclidean(x, y):
    return np.sqrt(_summed(lambda a, b: (a - b) * (a - b), x, y))


def chebyshev(x, y):
    most = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        np.maximum(most, np.abs(x[:, None, j] - y[None, :, j]), out=most)
    return most


def minkowski(p: float) -> Distance:
    return lambda x, y: _summed(lambda a, b: np.abs(a - b) ** p, x, y) ** (1.0 / p)


def canberra(x, y):
    def part(a, b):
        size = np.abs(a) + np.abs(b)
        return np.divide(np.abs(a - b), size, out=np.zeros(size.shape), where=size > 0)
    return _summed(part, x, y)


def hamming(x, y):
    return _summed(lambda a, b: (a != b).astype(float), x, y) / x.shape[1]


def haversine(x, y):
    """Great-circle angle between (latitude, longitude) rows in radians."""
    a = np.sin((x[:, None, 0] - y[None, :, 0]) / 2) ** 2
    b = np.cos(x[:, None, 0]) * np.cos(y[None, :, 0]) * np.sin((x[:, None, 1] - y[None, :, 1]) / 2) ** 2
    return 2 * np.arcsin(np.minimum(1.0, np.sqrt(a + b)))


def _unit(x):
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def _centred(x):
    return _unit(x - x.mean(axis=1, keepdims=True))


def _half_square(gap):
    return gap * gap / 2


@dataclass(frozen=True)
class Metric:
    """A distance with the coordinates and the norm whose box gaps bound it from below.

    ``coordinates`` None: pivot distances.  ``bound`` maps a gap between a
    point and a box, in the norm of order ``order``, to a distance."""
    distance: Distance
    coordinates: Callable[[np.ndarray], np.ndarray] | None = None
    order: float = np.inf
    bound: Callable[[np.ndarray], np.ndarray] | None = None


def _cosine(turn):
    def distance(x, y):
        u, v = turn(x), turn(y)
        return _half_square(euclidean(u, v))  # 1 - cos, without cancellation for close vectors
    return Metric(distance, turn, 2, _half_square)


def metric_of(metric: str | Distance, p: float = 2.0) -> Metric:
    """A metric by name, or any callable (rows, rows) -> matrix that obeys the triangle inequality."""
    if callable(metric):
        return Metric(metric)
    same = lambda x: x
    if metric == "minkowski":
        if p < 1:
            raise ValueError("minkowski needs p >= 1: below, the triangle inequality fails")
        return Metric(minkowski(p), same, p)
    known = {"manhattan": Metric(manhattan, same, 1), "cityblock": Metric(manhattan, same, 1), "l1": Metric(manhattan, same, 1),
             "euclidean": Metric(euclidean, same, 2), "l2": Metric(euclidean, same, 2), "chebyshev": Metric(chebyshev, same, np.inf),
             "sqeuclidean": Metric(lambda x, y: euclidean(x, y) ** 2, same, 2, np.square),
             "cosine": _cosine(_unit), "correlation": _cosine(_centred),
             "canberra": Metric(canberra), "hamming": Metric(hamming), "haversine": Metric(haversine)}
    if metric not in known:
        raise ValueError(f"no metric named {metric!r}: {', '.join(sorted([*known, 'minkowski']))}, or a callable")
    return known[metric]


@dataclass
class Space:
    """What tasks need to place points: the metric and, where it has no coordinates, the pivots."""
    metric: Metric
    pivots: np.ndarray | None = None

    def place(self, x: np.ndarray) -> np.ndarray:
        if self.pivots is None:
            return self.metric.coordinates(x)
        return self.metric.distance(x, self.pivots)

    def bounds(self, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances from placed points to all that lies in the boxes, a little below to be safe from rounding."""
        order = np.inf if self.pivots is not None else self.metric.order
        total = np.zeros((len(at), len(low)))
        for j in range(at.shape[1]):
            gap = np.maximum(np.maximum(low[None, :, j] - at[:, None, j], at[:, None, j] - high[None, :, j]), 0.0)
            if order == np.inf:
                np.maximum(total, gap, out=total)
            else:
                total += gap if order == 1 else gap ** order
        gap = total if order in (1, np.inf) else total ** (1.0 / order)
        gap = np.maximum(gap * (1 - 1e-9) - 1e-12, 0.0)
        return self.metric.bound(gap) if self.metric.bound else gap


def far_apart(distance: Distance, sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each next one is the sampled point farthest from those before."""
    chosen = [0]
    near = distance(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distance(sample, sample[chosen[-1]:chosen[-1] + 1])[:, 0])
    return sample[chosen]


class Tree:
    """Median splits of a sample of placed points; ``leaf_of`` deals any points to its leaves."""

    def __init__(self, placed: np.ndarray, leaves: int):
        self.dim, self.cut, self.child = [], [], []
        self.n_leaves = 0
        self.root = self._grow(placed, leaves)

    def _grow(self, at: np.ndarray, leaves: int) -> int:
        """Number of the node; leaves are ~ their number."""
        spread = at.max(axis=0) - at.min(axis=0) if len(at) else np.zeros(1)
        if leaves <= 1 or len(at) < 2 or not spread.max() > 0:
            self.n_leaves += 1
            return ~(self.n_leaves - 1)
        dim = int(spread.argmax())
        values = np.sort(at[:, dim])
        cut = values[len(values) // 2]
        if cut == values[0]:  # ties at the lower end: the first value above them
            cut = values[np.searchsorted(values, cut, "right")]
        node = len(self.dim)
        self.dim.append(dim)
        self.cut.append(cut)
        self.child.append(None)
        below = at[:, dim] < cut
        self.child[node] = (self._grow(at[below], leaves // 2), self._grow(at[~below], leaves - leaves // 2))
        return node

    def leaf_of(self, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.int64)
        stack = [(self.root, np.arange(len(at)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = ~node
                continue
            below = at[rows, self.dim[node]] < self.cut[node]
            left, right = self.child[node]
            stack += [(left, rows[below]), (right, rows[~below])]
        return out


def search(space: Space, k: int, queries: np.ndarray, radius: np.ndarray, points: np.ndarray,
           own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of every point within its query's k nearest and its radius, ties at the last distance included.

    ``own``: for each query the point that is itself, which is left out."""
    where, asked = space.place(points), space.place(queries)

    def blocks(at):
        order, out = [np.arange(len(at))], []
        while order:
            rows = order.pop()
            spread = at[rows].max(axis=0) - at[rows].min(axis=0)
            if len(rows) <= BLOCK or not spread.max() > 0 and len(rows) <= 16 * BLOCK:
                out.append(rows)
                continue
            by = rows[np.argsort(at[rows, spread.argmax()], kind="stable")]
            order += [by[:len(by) // 2], by[len(by) // 2:]]
        return out
    if not len(points) or not len(queries):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    homes = blocks(where)
    low = np.array([where[b].min(axis=0) for b in homes])
    high = np.array([where[b].max(axis=0) for b in homes])
    found = []
    for rows in blocks(asked):
        x, reach = queries[rows], radius[rows].copy()
        best = np.full((len(rows), k), np.inf)
        bound = space.bounds(asked[rows], low, high)
        kept = []
        for b in np.argsort(bound.min(axis=0), kind="stable"):
            wanted = np.flatnonzero(bound[:, b] <= reach)
            if not len(wanted):
                continue
            members = homes[b]
            d = space.metric.distance(x[wanted], points[members])
            if own is not None:
                d[own[rows[wanted]][:, None] == members[None, :]] = np.inf
            both = np.concatenate([best[wanted], d], axis=1)
            both.partition(k - 1, axis=1)
            best[wanted] = both[:, :k]
            reach[wanted] = np.minimum(reach[wanted], both[:, k - 1])
            i, j = np.nonzero(d <= reach[wanted][:, None])
            finite = np.isfinite(d[i, j])
            i, j = i[finite], j[finite]
            kept.append((wanted[i], members[j], d[i, j]))
        if kept:
            i, j, d = (np.concatenate(c) for c in zip(*kept))
            near = d <= reach[i]
            found.append((rows[i[near]], j[near], d[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found))


def nearest(k: int, i: np.ndarray, q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Places of each query's first k, by distance, then point."""
    order = np.lexsort((q, d, i))
    i = i[order]
    start = np.maximum.accumulate(np.where(np.r_[True, i[1:] != i[:-1]], np.arange(len(i)), 0)) if len(i) else i
    return order[np.arange(len(i)) - start < k]


def nearest_neighbours(points: DataFrame, names: list[str], k: int = 5, metric: str | Distance = "euclidean",
                       p: float = 2.0, leaf: int | None = None) -> DataFrame:
    """The k nearest other points of every point: ``(p, rank, q, d, wq)``, ties by key.

    ``points``: ``__id`` (unique), the features ``names`` and, if it has one, the
    weight ``__w``, returned for the neighbour as ``wq`` (else 1).  Points with a
    missing feature have no place and are left out.  Points with fewer than k
    others have as many neighbours as there are.  ``points`` is read three
    times: hand over a written table if it is costly."""
    spark = points.sparkSession
    weight = F.col("__w") if "__w" in points.columns else F.lit(1)
    x = F.array(*[F.col(f"`{n}`").cast("double") for n in names])
    base = points.select(F.col("__id").alias("id"), x.alias("x"), weight.cast("long").alias("w")).where(
        F.col("id").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c)))
    kind = base.schema["id"].dataType.simpleString()
    n = base.count()
    if n == 0 or k < 1:
        return spark.createDataFrame([], f"p {kind}, rank int, q {kind}, d double, wq long")
    target = leaf or int(min(LEAF, max(2_000, n / (2 * spark.sparkContext.defaultParallelism))))
    leaves = max(1, min(MAX_LEAVES, -(-n // target)))
    wanted = SAMPLE * max(leaves, 64)
    sampled = base.select("x") if n <= wanted else base.select("x").sample(wanted / n, seed=1)
    sample = np.array([r["x"] for r in sampled.collect()] or [base.first()["x"]], float)  # SAMPLE rows a leaf
    kernel = metric_of(metric, p)
    space = Space(kernel, None if kernel.coordinates else far_apart(kernel.distance, sample[:5_000], PIVOTS))
    tree = Tree(space.place(sample), leaves)
    size = len(space.place(sample[:1])[0])
    dealt, boxes = _deal(base, kind, space, tree, target, size)
    number = np.array([r["leaf"] for r in boxes])
    low = np.array([[r[f"a{j}"] for j in range(size)] for r in boxes])
    high = np.array([[r[f"b{j}"] for j in range(size)] for r in boxes])
    pairs = f"p {kind}, q {kind}, d double, wq long"

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", ignore_index=True)
        pts = _rows(group["x"])
        i, q, d = search(space, k, pts, np.full(len(pts), np.inf), pts, np.arange(len(pts)))
        top = nearest(k, i, q, d)
        ids = group["id"].to_numpy()
        return pd.DataFrame({"p": ids[i[top]], "q": ids[q[top]], "d": d[top], "wq": group["w"].to_numpy()[q[top]]})

    def across(questions: pd.DataFrame, home: pd.DataFrame) -> pd.DataFrame:
        home = home.sort_values("id", ignore_index=True)
        i, q, d = search(space, k, _rows(questions["x"]), questions["r"].to_numpy(), _rows(home["x"]))
        top = nearest(k, i, q, d)
        ids = home["id"].to_numpy()
        return pd.DataFrame({"p": questions["id"].to_numpy()[i[top]], "q": ids[q[top]], "d": d[top], "wq": home["w"].to_numpy()[q[top]]})

    found = scratch_table(dealt.groupBy("leaf").applyInPandas(inside, pairs), "neighbour-pairs")
    visited, step = 0, FIRST_VISITS
    while visited < len(boxes) - 1:
        reach = found.groupBy(F.col("p").alias("id")).agg(F.count("*").alias("c"), F.max("d").alias("r"))
        # ``found`` holds the k nearest so far, so the farthest of k is a point's bound.
        asking = dealt.join(reach, "id", "left").select("id", "x", "at", "leaf", F.when(F.col("c") >= k, F.col("r")).alias("r"))
        visits = scratch_table(asking.mapInPandas(_visits(space, number, low, high, visited, visited + step),
                                                  f"id {kind}, x array<double>, r double, leaf long"), "neighbour-visits")
        # A leaf that many points visit is searched by several tasks, each with a share of them.  One row per leaf
        # (MAX_LEAVES at most): small enough to broadcast.
        shares = visits.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(target)).cast("long").alias("shares"))
        asked = visits.join(F.broadcast(shares), "leaf").select("id", "x", "r", "leaf", F.pmod(F.xxhash64("id"), "shares").alias("share"))
        split = F.broadcast(shares.select(F.col("leaf").alias("home"), F.sequence(F.lit(0).cast("long"), F.col("shares") - 1).alias("each")))
        homes = dealt.join(split, F.col("leaf") == F.col("home")).select("id", "x", "w", "leaf", F.explode("each").alias("share"))
        more = asked.groupBy("leaf", "share").cogroup(homes.groupBy("leaf", "share")).applyInPandas(across, pairs)
        first = Window.partitionBy("p").orderBy("d", "q")  # at most k rows from each leaf visited
        before = found
        found = scratch_table(found.unionByName(more).withColumn("at", F.row_number().over(first)).where(
            F.col("at") <= k).drop("at"), "neighbour-pairs")
        drop_scratch(before, visits)
        visited, step = visited + step, step * MORE_VISITS
    drop_scratch(dealt)
    return found.select("p", F.row_number().over(Window.partitionBy("p").orderBy("d", "q")).alias("rank"), "q", "d", "wq")


def _rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def _deal(base: DataFrame, kind: str, space: Space, tree: Tree, target: int, size: int):
    """Points with their coordinates in the tree and their leaf, and one row per leaf with its box and count.

    Leaves that no split can part (equal coordinates) are dealt out by hash."""
    def place(batches: Iterator[pd.DataFrame]):
        for b in batches:
            if len(b):
                at = space.place(_rows(b["x"]))
                yield b.assign(leaf=tree.leaf_of(at), at=list(at))

    def measured(dealt: DataFrame) -> list:
        box = [f(F.col("at")[j]).alias(f"{c}{j}") for j in range(size) for f, c in ((F.min, "a"), (F.max, "b"))]
        return dealt.groupBy("leaf").agg(F.count("*").alias("n"), *box).orderBy("leaf").collect()
    dealt = scratch_table(base.mapInPandas(place, f"id {kind}, x array<double>, w long, leaf long, at array<double>"), "neighbour-leaves")
    boxes = measured(dealt)
    large = [(r["leaf"], -(-r["n"] // target)) for r in boxes if r["n"] > 4 * target]
    if large:
        parts = F.broadcast(base.sparkSession.createDataFrame(large, "leaf long, parts long"))  # fewer rows than leaves
        part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0))
        before = dealt
        dealt = scratch_table(dealt.join(parts, "leaf", "left").withColumn(
            "leaf", F.col("leaf") + F.lit(tree.n_leaves) * part).drop("parts"), "neighbour-leaves")
        drop_scratch(before)
        boxes = measured(dealt)
    return dealt, boxes


def _visits(space: Space, number: np.ndarray, low: np.ndarray, high: np.ndarray, begin: int, end: int):
    """Each point with the leaves ranked begin..end by their bound, its own left out, as far as the bound is within its radius."""
    rows_at_once = max(1, (1 << 21) // len(number))

    def run(batches: Iterator[pd.DataFrame]):
        for b in batches:
            for s in range(0, len(b), rows_at_once):
                part = b.iloc[s:s + rows_at_once]
                bound = space.bounds(_rows(part["at"]), low, high)
                bound[part["leaf"].to_numpy()[:, None] == number[None, :]] = np.inf
                radius = part["r"].fillna(np.inf).to_numpy()
                order = np.argsort(bound, axis=1, kind="stable")[:, begin:end]
                best = np.take_along_axis(bound, order, 1)
                rows, cols = np.nonzero((best <= radius[:, None]) & np.isfinite(best))
                if len(rows):
                    yield pd.DataFrame({"id": part["id"].to_numpy()[rows], "x": part["x"].to_numpy()[rows],
                                        "r": radius[rows], "leaf": number[order[rows, cols]]})
    return run
