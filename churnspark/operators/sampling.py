"""Stratified split, aligned split, random under-sampling, stratified k-fold (M1-M3, M5).

Row choice is deterministic: inside each class, rows are ordered by
``xxhash64(key, seed)`` (k-fold: by the key) and taken by position.  A
position is never computed: the order's value at each wanted rank comes from
radix selection (``selection``), and comparing a row's own order with it is a
column expression, so no row is moved or written.  Only where equal orders
straddle a cut (repeated keys), where a key is no whole number, or where there
are more classes than ``WIDE`` columns can carry, positions are counted
(``order.with_position``), with the same rows as result.  Per-class counts are
decided on the driver from the class sizes (one number per class).
"""
from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.operators.neighbours import nearest_neighbours
from churnspark.operators.order import with_position
from churnspark.operators.selection import counts_and_bounds, select_ranks
from churnspark.session import scratch_table

MAX_CLASSES = 10_000
#: Classes up to which each has a column of its own in the selection passes.
WIDE = 64


def class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[label]: r["n"] for r in rows}


def _hash(key: list[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in key], F.lit(seed))


def _hash_position(df: DataFrame, label: str, key: list[str], seed: int, n_classes: int) -> DataFrame:
    return with_position(df.withColumn("__h", _hash(key, seed)), [label], ["__h", *key], pos_col="__pos", max_keys=n_classes)


def class_cuts(df: DataFrame, label: str, order: Column, counts: dict, ranks: dict) -> dict[tuple, int] | None:
    """(class, rank) -> the order of the class's row at that 0-based rank, for a long ``order``.

    A rank equal to the class's size has no row and no entry.  None if rows of
    equal order lie on both sides of a rank, or with more than ``WIDE`` classes."""
    if len(counts) > WIDE:
        return None
    classes = list(counts)
    columns = {str(i): F.when(F.col(f"`{label}`").eqNullSafe(F.lit(k)), order) for i, k in enumerate(classes)}
    wanted = {str(i): sorted({r for r in ranks.get(k, []) if 0 < r < counts[k]}) for i, k in enumerate(classes)}
    columns = {c: e for c, e in columns.items() if wanted[c]}
    known = counts_and_bounds(df, columns)
    if any(known[c][0] != counts[classes[int(c)]] for c in columns):
        return None  # null orders
    found = select_ranks(df, columns, {c: wanted[c] for c in columns}, known)
    if any(place.below != r for (_, r), place in found.items()):
        return None
    return {(classes[int(c)], r): place.value for (c, r), place in found.items()}


def _before(label: str, order: Column, counts: dict, cuts: dict, ranks: dict) -> Column:
    """True for the first ``ranks[class]`` rows of each class."""
    out = F.lit(False)
    for k, r in ranks.items():
        if r > 0:
            mine = F.col(f"`{label}`").eqNullSafe(F.lit(k))
            out = out | (mine if r >= counts[k] else mine & (order < F.lit(cuts[k, r])))
    return out


def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Per-class draws: floor of the proportional share, the rest to the largest
    remainders (ties to the smaller class value)."""
    total = sum(counts.values())
    keys = sorted(counts, key=lambda k: (k is None, k))
    cont = {k: counts[k] * n_draws / total for k in keys}
    out = {k: math.floor(cont[k]) for k in keys}
    need = n_draws - sum(out.values())
    for k in sorted(keys, key=lambda k: -(cont[k] - out[k]))[:need]:
        out[k] += 1
    return out


def split_labels(df: DataFrame, label: str, key: list[str] | str, test_size: float = 0.2, seed: int = 42,
                 out_col: str = "split") -> DataFrame:
    """M1: tag each row ``train`` / ``test`` with class shares kept (exact counts)."""
    key = [key] if isinstance(key, str) else list(key)
    counts = class_counts(df, label)
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    per = approximate_mode(counts, n_test)
    cuts = class_cuts(df, label, _hash(key, seed), counts, {k: [t] for k, t in per.items()})
    if cuts is not None:
        test = _before(label, _hash(key, seed), counts, cuts, per)
        return df.withColumn(out_col, F.when(test, F.lit("test")).otherwise(F.lit("train")))
    pos = _hash_position(df, label, key, seed, len(counts))
    cond = None
    for k, t in per.items():
        c = (F.col(label).eqNullSafe(F.lit(k))) & (F.col("__pos") < t)
        cond = c if cond is None else cond | c
    return pos.withColumn(out_col, F.when(cond, F.lit("test")).otherwise(F.lit("train"))).drop("__h", "__pos")


def stratified_split(df: DataFrame, label: str, key, test_size: float = 0.2, seed: int = 42):
    """M1: ``(train, test)``."""
    tagged = split_labels(df, label, key, test_size, seed)
    return (tagged.where(F.col("split") == "train").drop("split"), tagged.where(F.col("split") == "test").drop("split"))


def aligned_split(other: DataFrame, split_ids: DataFrame, key) -> DataFrame:
    """Rows of a second table that follow their entity into a split."""
    key = [key] if isinstance(key, str) else list(key)
    return other.join(split_ids.select(*key).distinct(), key, "left_semi")


def under_sample(df: DataFrame, label: str, key, seed: int = 42) -> DataFrame:
    """M3: every class reduced to the size of the smallest class."""
    key = [key] if isinstance(key, str) else list(key)
    counts = class_counts(df, label)
    m = min(counts.values())
    cuts = class_cuts(df, label, _hash(key, seed), counts, {k: [m] for k in counts})
    if cuts is not None:
        return df.where(_before(label, _hash(key, seed), counts, cuts, {k: m for k in counts}))
    return _hash_position(df, label, key, seed, len(counts)).where(F.col("__pos") < m).drop("__h", "__pos")


def kfold_allocation(counts: dict, n_splits: int = 5) -> dict:
    """Rows of each class per fold: round robin over the labels sorted by class."""
    keys = sorted(counts, key=lambda k: (k is None, k))
    alloc, start = {}, 0
    for k in keys:
        a, b = start, start + counts[k]
        alloc[k] = [((b - 1 - i) // n_splits) - ((a - 1 - i) // n_splits) for i in range(n_splits)]
        start = b
    return alloc


def stratified_kfold(df: DataFrame, label: str, key, n_splits: int = 5, out_col: str = "fold") -> DataFrame:
    """M5 (unshuffled): in key order, each class is cut into contiguous blocks, block i -> fold i."""
    key = [key] if isinstance(key, str) else list(key)
    counts = class_counts(df, label)
    alloc = kfold_allocation(counts, n_splits)
    whole = len(key) == 1 and isinstance(df.schema[key[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if whole:
        order = F.col(f"`{key[0]}`").cast("long")
        ends = {k: list(accumulate(sizes))[:-1] for k, sizes in alloc.items()}
        cuts = class_cuts(df, label, order, counts, ends)
        if cuts is not None:
            fold = F.lit(n_splits - 1)
            for i in reversed(range(n_splits - 1)):
                fold = F.when(_before(label, order, counts, cuts, {k: e[i] for k, e in ends.items()}), F.lit(i)).otherwise(fold)
            return df.withColumn(out_col, fold.cast("int"))
    pos = with_position(df, [label], key, pos_col="__pos", max_keys=len(counts))
    fold = None
    for k, sizes in alloc.items():
        cuts, acc = [], 0
        for s in sizes:
            acc += s
            cuts.append(acc)
        e = None
        for i in reversed(range(n_splits)):
            e = F.when(F.col("__pos") < cuts[i], F.lit(i)) if e is None else F.when(F.col("__pos") < cuts[i], F.lit(i)).otherwise(e)
        fold = F.when(F.col(label).eqNullSafe(F.lit(k)), e) if fold is None else fold.when(F.col(label).eqNullSafe(F.lit(k)), e)
    return pos.withColumn(out_col, fold.cast("int")).drop("__pos")


def _rank_table(comp: DataFrame, names: list[str], k: int) -> DataFrame:
    """``(p, rank, n_f...)``: features of the rank-th nearest other row (1..k) of any copy of p.

    Copies of p come first (distance 0); then the distinct neighbours, each
    covering as many ranks as it has copies."""
    nn = nearest_neighbours(comp, names, k)
    w = Window.partitionBy("p").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    nn = nn.withColumn("__cum", F.sum("wq").over(w))
    feats = comp.select(F.col("__id").alias("q"), *[F.col(n).alias(f"n_{n}") for n in names])
    nbr = nn.join(feats, "q").select("p", "__cum", (F.col("__cum") - F.col("wq")).alias("__lo"), *[f"n_{n}" for n in names])
    ranks = comp.select(F.col("__id").alias("p"), "__w", *names,
                        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    shift = F.col("rank") - (F.col("__w") - 1)
    own = ranks.where(shift <= 0).select("p", "rank", *[F.col(n).alias(f"n_{n}") for n in names])
    other = (ranks.where(shift > 0).withColumn("__s", shift).join(nbr, "p")
                  .where((F.col("__lo") < F.col("__s")) & (F.col("__s") <= F.col("__cum")))
                  .select("p", "rank", *[f"n_{n}" for n in names]))
    return own.unionByName(other)


def smote(df: DataFrame, label: str, key: str, features: list[str], k: int = 5, seed: int = 42) -> DataFrame:
    """M4: synthetic minority rows ``x + u * (neighbour - x)`` until both classes have equal size.

    Base row, neighbour rank and ``u`` come from seeded hashes of the new
    row's index (a different random stream than other libraries: check
    counts and convexity, not values).  Identical minority rows are collapsed
    before the neighbour search (a group of copies costs one point).
    Synthetic rows get ``key`` NULL."""
    from churnspark.operators.density import compress
    counts = class_counts(df, label)
    minority = min(counts, key=lambda c: counts[c])
    n_new = max(counts.values()) - counts[minority]
    minor = df.where(F.col(label) == F.lit(minority))
    names = [f"f{i}" for i in range(len(features))]
    pts = minor.select(F.col(key).alias("__id"), *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    comp = scratch_table(compress(pts, names), "smote-points")
    table = scratch_table(_rank_table(comp, names, k), "smote-neighbours")
    avail = table.groupBy("p").agg(F.max("rank").alias("__kp"))
    m = counts[minority]
    rows = pts.join(comp.select(*names, F.col("__id").alias("p")), names)   # each row -> its distinct point
    indexed = with_position(rows.withColumn("__g", F.lit(0)), ["__g"], ["__id"], pos_col="__pos", max_keys=1).drop("__g")
    spark = df.sparkSession
    j = F.col("id")
    new = (spark.range(n_new)
           .withColumn("__pos", F.pmod(F.xxhash64(j, F.lit(seed)), F.lit(m)))
           .withColumn("__r", F.pmod(F.xxhash64(j, F.lit(seed + 1)), F.lit(k)))
           .withColumn("u", F.pmod(F.xxhash64(j, F.lit(seed + 2)), F.lit(1 << 53)) / float(1 << 53)))
    base = (new.join(indexed, "__pos").join(avail, "p")
               .withColumn("rank", F.pmod(F.col("__r"), F.col("__kp")) + 1))
    syn = base.join(table, ["p", "rank"])
    out_cols = {f: F.col(n) + F.col("u") * (F.col(f"n_{n}") - F.col(n)) for f, n in zip(features, names)}
    synthetic = syn.select(F.lit(None).cast(dict(df.dtypes)[key]).alias(key), F.lit(minority).alias(label),
                           *[e.alias(f) for f, e in out_cols.items()])
    original = df.select(key, label, *[F.col(f).cast("double") for f in features])
    return original.unionByName(synthetic)
