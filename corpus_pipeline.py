"""Training-data pipeline over ``documents``: five stages, each written as
Parquet in the shared folder and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersentry.llm import decontaminate, jaccard, mixing, quality, token_store
from ordersentry.llm.common import free_prefix, saved, shared_path

TOKENIZER, END_ID = "word_bpe_49k.json", 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_prefix(docs.columns) + "quality"
    return quality.score(docs, model, out=score).filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays."""
    return jaccard.one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, go or repeat so that sources come near their targets."""
    return mixing.take_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's documents, read back from its files."""
    path = token_store.write_token_store(docs, shared_path(spark, "token-store"), public_tokenizers.path(TOKENIZER), END_ID)
    return token_store.read_token_store(spark, path)


STAGES = [
    ("quality", quality_stage),
    ("jaccard", jaccard_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: A trained classifier and a library's tokenizer take part, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
