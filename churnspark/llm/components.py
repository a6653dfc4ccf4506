"""Connected components of an edge table by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over distinct edges (u, v) with u > v.

    large: every node's greater neighbours point to the least of its
    neighbourhood; small: every node and its smaller neighbours do.  Minima
    are combined before the shuffle, so a hub's links are never collected."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b): component is the least node that it reaches.

    Rounds end when a round changes nothing; their number grows with the
    logarithm of the longest path.  Each round is a written table."""
    now = save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), name)
    was = state(now)
    while True:
        new = save(star(star(now, large=True), large=False), name)
        discard(now)
        now, then = new, was
        was = state(now)
        if was == then:
            break
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
