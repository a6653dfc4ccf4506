"""``foreachBatch`` scorer for a fitted churn pipeline."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def micro_batch_scorer(model, prices: DataFrame, labels: DataFrame, out_path: str):
    """Return ``fn(batch, epoch_id)`` for ``writeStream.foreachBatch``.

    Each micro-batch of client rows is merged with its clients' prices (C3),
    scored by the stored pipeline (C5) and appended to ``out_path`` with the
    epoch id, so a replayed epoch overwrites nothing and can be deduplicated
    on ``(epoch_id, c_custkey)``."""
    from churnspark.operators.models import predict
    from churnspark.operators.sampling import aligned_split
    from churnspark.plans import domain as dm
    from churnspark.plans.scenario import merged_with_labels

    def fn(batch: DataFrame, epoch_id: int) -> None:
        ids = batch.select(dm.ID).distinct()
        merged = merged_with_labels(batch, aligned_split(prices, ids, dm.ID), labels)
        scored = predict(model, merged).select(dm.ID, F.col("score").alias("prob_churned"), "prediction")
        scored.withColumn("epoch_id", F.lit(epoch_id)).write.mode("append").parquet(out_path)

    return fn
