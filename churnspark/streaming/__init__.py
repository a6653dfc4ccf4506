"""Streaming entry point: C6 (batch inference) applied to micro-batches.

The reference has no streaming operator; this only lets a stored pipeline
score client rows arriving on a stream (``foreachBatch``), joined to a price
table, appending predictions to a parquet sink.
"""
from churnspark.streaming.score import micro_batch_scorer  # noqa: F401
