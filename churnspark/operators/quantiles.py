"""Exact quantiles (linear interpolation, as pandas/numpy) for many keys at once.

Input is a long table ``(key, value)``.  Values are first compressed to value
counts (a hash aggregate with map-side combine), then the running count
before each distinct value is computed skew-safely (``order.with_cumsum``).
The two order statistics around ``h = (n-1)q`` are picked with a join on
``key`` and a range condition against the small target table (keys x
quantiles).  No group is ever collected into one task and nothing goes
through the driver.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.order import with_cumsum


def value_counts(long_df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return (long_df.where(F.col(value).isNotNull())
                   .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__cnt")))


def exact_quantiles(long_df: DataFrame, keys: list[str], value: str, qs: list[float],
                    counts: DataFrame | None = None, max_keys: int | None = None) -> DataFrame:
    """Return ``(keys..., q, quantile)`` for each key and each q in ``qs``.

    ``max_keys``: a proven bound on the number of keys (e.g. the columns of a
    table).  The target table then has at most ``max_keys * len(qs)`` rows
    and is broadcast, so the range join never groups one key's values into
    one task; without a bound the join strategy is left to AQE."""
    if counts is None:   # the running counts and the sizes both read it: aggregate the input once
        from churnspark.session import cut_lineage
        counts = cut_lineage(value_counts(long_df, keys, value))
    vc = counts
    cum = with_cumsum(vc, keys, [value], "__cnt", "__c0")
    n = vc.groupBy(*keys).agg(F.sum("__cnt").alias("__nn"))
    targets = (n.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
                 .withColumn("__h", (F.col("__nn") - 1) * F.col("q"))
                 .withColumn("__lo", F.floor("__h")).withColumn("__hi", F.ceil("__h")))
    targets = targets.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)], "q", "__h", "__lo", "__hi")
    lo_hit = (F.col("__c0") <= F.col("__lo")) & (F.col("__lo") < F.col("__c0") + F.col("__cnt"))
    hi_hit = (F.col("__c0") <= F.col("__hi")) & (F.col("__hi") < F.col("__c0") + F.col("__cnt"))
    cond = [F.col(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(keys)]
    cond = reduce(lambda a, b: a & b, cond) & (lo_hit | hi_hit)
    if max_keys is not None and max_keys * len(qs) <= 1_000_000:
        targets = F.broadcast(targets)
    hits = cum.join(targets, on=cond, how="inner").select(
        *keys, "q", "__h", "__lo",
        F.when(lo_hit, F.col(value)).alias("__xlo"), F.when(hi_hit, F.col(value)).alias("__xhi"))
    g = hits.groupBy(*keys, "q").agg(F.first("__h").alias("__h"), F.first("__lo").alias("__lo"),
                                     F.max("__xlo").alias("__xlo"), F.max("__xhi").alias("__xhi"))
    return g.select(*keys, "q", (F.col("__xlo") + (F.col("__h") - F.col("__lo")) * (F.col("__xhi") - F.col("__xlo"))).alias("quantile"))
