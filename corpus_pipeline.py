"""Corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame, which ``run`` writes as Parquet to the shared
checkpoint folder and rereads as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm import decontaminate, near_dedup, piece_encoding, quality_model, substring_dedup
from churnspark.llm.common import discard, discard_since, free_name, open_tables, save, training_row


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.3).

    It learns from the labelled documents of its input outside the held-out fold."""
    return quality_model.keep_good(docs, quality_model.learn(docs, read(spark, sf_dir, "labels"), training_row(0)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of the smallest id.  Shingles of five words, similarity 0.8.

    Texts without a word belong to no group and stay."""
    name = free_name(docs, "gone")
    gone = near_dedup.near_duplicates(docs, k=5, threshold=0.8).where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.hint("merge").join(gone, F.col("doc_id") == F.col(name), "left_anti").select(docs.columns)  # one plan at every size


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages of 50 words or more that also stand in a document of smaller id are cut out."""
    return substring_dedup.remove_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy, exact or edited, of a benchmark item."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, digested with their decoded text: doc_id, n_tokens, ids_sha256, decoded_sha256, spans_ok."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return piece_encoding.digest_documents(docs, model)


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages),
    ("piece_encoding", encode),
]

#: Trained weights, components, windows and tokenizers have no SQL twin; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order; each one's tables, its input too, are deleted once its result is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = open_tables()
        result = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard_since(mark, result)
        discard(docs)
        docs = result
    return docs
