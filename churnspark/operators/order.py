"""Positions inside ordered groups without putting a group into one task.

A ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task; one hot key holding a third of the table would then be a third of the
job on one core.  Instead the rows are range-partitioned on
``(key, order...)`` — a hot key is cut into consecutive *pieces* spread over
several partitions — and sorted inside each partition.  Inside a sorted
partition ``monotonically_increasing_id`` numbers rows consecutively, so each
piece ``(partition, key)`` is a run of consecutive ids.  A piece's offset is
the number of rows of the same key in earlier partitions; those come from a
window over the *piece table*, which has at most ``#keys + #partitions`` rows
and at most ``#partitions`` rows per key.

``position = id - first_id(piece) + offset(piece)`` is the 0-based position of
a row inside its key, in the requested order.

The tagged rows are written once before both uses: a second evaluation of
the range exchange may sample other bounds (column pruning alone keeps Spark
from reusing it), and the two numberings would not fit together.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.session import cut_lineage

PID, RID = "__pid", "__rid"


def default_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, keys: list[str], order: list, n_parts: int | None = None) -> DataFrame:
    """Range-partition on keys+order, sort inside partitions, tag partition and row id.

    Without ``n_parts`` the range exchange uses the session's shuffle
    partitions and AQE may coalesce neighbouring ranges (still contiguous
    ranges, so the piece scheme holds) — small inputs do not fan out."""
    sort_cols = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    parted = df.repartitionByRange(n_parts, *sort_cols) if n_parts else df.repartitionByRange(*sort_cols)
    return (parted
              .sortWithinPartitions(*sort_cols)
              .withColumns({PID: F.spark_partition_id(), RID: F.monotonically_increasing_id()}))


def piece_offsets(pieces: DataFrame, keys: list[str], n_col: str = "__n") -> DataFrame:
    """Add ``__off``: rows of the same key in earlier partitions."""
    w = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("__off", F.coalesce(F.sum(n_col).over(w), F.lit(0)))


def with_position(df: DataFrame, keys: list[str], order: list, pos_col: str = "pos",
                  size_col: str | None = None, max_keys: int | None = None,
                  n_parts: int | None = None) -> DataFrame:
    """Add the 0-based position of each row inside its key (and optionally the key size).

    ``max_keys``: a proven upper bound on the number of distinct keys (e.g. the
    classes of a label).  Then the piece table has at most
    ``max_keys + partitions`` rows and is broadcast; otherwise it is joined
    back on ``(partition, key)``, which spreads a hot key over its partitions.
    """
    r = cut_lineage(ranged(df, keys, order, n_parts))
    pieces = r.groupBy(PID, *keys).agg(F.count(F.lit(1)).alias("__n"), F.min(RID).alias("__first"))
    pieces = piece_offsets(pieces, keys)
    if size_col:
        pieces = pieces.withColumn(size_col, F.sum("__n").over(Window.partitionBy(*keys)))
    pieces = pieces.drop("__n")
    if max_keys is not None and max_keys + (n_parts or default_parts(df)) <= 1_000_000:
        pieces = F.broadcast(pieces)
    out = r.join(pieces, on=[PID, *keys], how="inner")
    out = out.withColumn(pos_col, F.col(RID) - F.col("__first") + F.col("__off"))
    return out.drop(PID, RID, "__first", "__off")


def with_cumsum(df: DataFrame, keys: list[str], order: list, weight: str | list[str], out_col: str | list[str] = "cum_before",
                n_parts: int | None = None) -> DataFrame:
    """Add the sum of ``weight`` over rows *before* each row inside its key, in ``order``.

    Several weights (with as many output names) share one range exchange.
    Same piece scheme as ``with_position``; the running sum inside a piece
    is a window over ``(partition, key)``, which splits a hot key into as
    many tasks as partitions it spans.
    """
    weights, outs = ([weight], [out_col]) if isinstance(weight, str) else (list(weight), list(out_col))
    r = cut_lineage(ranged(df, keys, order, n_parts))
    sums = r.groupBy(PID, *keys).agg(*[F.sum(c).alias(f"__n{i}") for i, c in enumerate(weights)])
    earlier = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    pieces = sums.select(PID, *keys, *[F.coalesce(F.sum(f"__n{i}").over(earlier), F.lit(0)).alias(f"__off{i}") for i in range(len(weights))])
    w = Window.partitionBy(PID, *keys).orderBy(RID).rowsBetween(Window.unboundedPreceding, -1)
    local = r.withColumns({f"__loc{i}": F.coalesce(F.sum(c).over(w), F.lit(0)) for i, c in enumerate(weights)})
    out = local.join(pieces, on=[PID, *keys], how="inner")
    out = out.withColumns({o: F.col(f"__loc{i}") + F.col(f"__off{i}") for i, o in enumerate(outs)})
    return out.drop(PID, RID, *[f"__{k}{i}" for k in ("loc", "off") for i in range(len(weights))])
