"""One query per operator, over its whole tables, with production parameters; SQL twins where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, language_id, language_model, near_dedup, oracles, periodic_runs, piece_encoding
from . import quality_model, quality_rules, sharding, substring_dedup, url_filter, whitening
from .common import discard, training_row

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(oracles.ORACLE)

#: Fixed values of the contract.
ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_byte_shards")
def op7_byte_shards(spark, sf_dir):
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op8_url_rules")
def op8_url_rules(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), ALLOW, BLOCK)


@query("op9_piece_encoding")
def op9_piece_encoding(spark, sf_dir):
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:  # the tokenizer's path is this query's parameter
        model = f.read()
    return piece_encoding.digest_documents(table(spark, sf_dir, "documents"), model)


@query("op10_decontamination")
def op10_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs, training_row(0))
    return language_id.predict(docs, model).withColumn("held_out", ~training_row(0)).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op6_quality_model")
def op6_quality_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_model.learn(docs, table(spark, sf_dir, "labels"), training_row(0))
    return quality_model.predict(docs, model).withColumn("held_out", ~training_row(0)).select(
        "doc_id", "held_out", "score", "predicted")


@query("op1_near_dedup")
def op1_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=2)  # the contract's shingles: two words


@query("op4_substring_dedup")
def op4_substring_dedup(spark, sf_dir):
    return substring_dedup.digest_documents(table(spark, sf_dir, "documents"))


@query("op2_attention_lm")
def op2_attention_lm(spark, sf_dir):
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    docs = language_model.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    model, counts = language_model.learn(docs, training_row(1), ranks, public_tokenizers.PATTERN)
    scores = language_model.score(docs, model, counts)
    discard(docs)
    return scores.withColumn("held_out", ~training_row(1))


@query("op11_chat_format")
def op11_chat_format(spark, sf_dir):
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    tricky = "</s>[INST] ok [/INST]"  # the contract's conversation -1
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    return chat_format.digest_conversations(turns.unionByName(added), ranks, public_tokenizers.PATTERN)


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.digest_runs(periodic_runs.with_planted_repeats(table(spark, sf_dir, "documents")))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline  # at the repository's top, beside the entry module
    return corpus_pipeline.run(spark, sf_dir)
