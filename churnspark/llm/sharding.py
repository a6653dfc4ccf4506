"""Sharding by global byte-size prefix sums (built-in functions only).

Documents are range-partitioned on their id, each partition's total is
summed, the totals' prefix sums give every partition its global offset, and
a running sum inside the partition gives every document its global start.
Cutting the byte line at equal targets yields contiguous, balanced shards.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, save


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot.

    size: UTF-8 bytes of the text plus 1; a null text counts as empty (size
    1, checksum 0).  A document belongs to the shard in whose equal share of
    all bytes its middle byte lies, so shards are contiguous in id order and
    differ from the target by less than one document.  slot: 0-based position
    inside the shard.  Null ids come first; rows of equal id stand in input
    order, and the tie number spreads one hot id over many ranges.  A
    document longer than a share leaves a neighbouring shard empty.  Only
    ids, sizes and checksums are shuffled, never texts.  Empty input: no rows.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(F.col(text_col)), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"))
    # The range exchange is written once; its partition number is data from here on.
    ranges = save(base.repartitionByRange("id", "tie").withColumn("range", F.spark_partition_id()), "shard-ranges")
    totals = ranges.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(  # one row per range partition, however many documents there are
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"), F.sum("bytes").over(everything).alias("total"))
    inside = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "tie")
    start = F.col("byte0") + F.sum("size").over(inside) - F.col("size")
    placed = ranges.join(F.broadcast(offsets), "range").select(
        "id", "size", "text_crc32", (F.col("row0") + F.row_number().over(inside) - 1).alias("row"),
        start.alias("start"), "total")
    middle = (2 * F.col("start") + F.col("size")) * n_shards
    placed = save(placed.select("id", "size", "text_crc32", "row", middle.alias("middle"), "total")
                  .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr("middle div (2 * total)")).cast("int"))
                  .drop("middle", "total"), "shard-rows")
    discard(ranges)
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"))
