"""Registered queries of the corpus operators: name -> ``(spark, sf_dir) -> DataFrame``.

Each applies its operator to the whole table(s) with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, filter_audit, jaccard, language_model, mixing, quality, simhash, substrings, token_store, topk, warc,
               whitening)
from .common import remainder, shared_path

Query = Callable[[SparkSession, str], DataFrame]

TOP_K = 5
QUERY_STEP = 50           # every vec_id divisible by it is a query
END_ID = 1                # token that ends a document
TOKENIZER = "word_bpe_49k.json"
CHAT_TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return (quality.score(docs, model).withColumn("held_out", remainder("doc_id", quality.FOLDS) == quality.HELD_OUT_FOLD)
            .select("doc_id", "held_out", "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, k=TOP_K)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_token_store(table(spark, sf_dir, "documents"), shared_path(spark, "token-store"),
                                         public_tokenizers.path(TOKENIZER), END_ID)
    return token_store.read_token_store(spark, path)


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    tokenizer = public_tokenizers.path(CHAT_TOKENIZER)
    path = shared_path(spark, "chat")
    chat.format_conversations(rows.unionByName(extra), tokenizer).write.option("compression", "zstd").parquet(path)
    return chat.read_digests(spark, path, tokenizer)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return warc.read_index(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def queries() -> dict[str, Query]:
    own = {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
    return {**own, "pipeline": corpus_pipeline.run}
