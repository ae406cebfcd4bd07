"""The training-data pipeline over ``documents``: STAGES in order, each written as Parquet and read again for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinis.llm.common import ship_package
from affinis.llm.decontaminate import drop_contaminated, with_parts
from affinis.llm.language import keep_identified, train
from affinis.llm.mixing import mix
from affinis.llm.near_dedup import drop_near_duplicates
from affinis.llm.token_files import tokens_by_document
from affinis.operators.staging import materialize

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the known ones, by text, declared language and source."""
    ship_package(spark)
    return keep_identified(docs, train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    ship_package(spark)
    return drop_contaminated(docs, with_parts(spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts that the mix takes, one row for each document and pass over its source."""
    ship_package(spark)
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every text's ids in the token files."""
    ship_package(spark)
    return tokens_by_document(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: the stages' statistical and probabilistic parts can't be stated in SQL; tests hold each against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
