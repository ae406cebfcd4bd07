"""The registered queries of this subpackage: ``(spark, folder of the tables) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm.common import ship_package
from affinis.llm.decontaminate import contaminated, with_parts
from affinis.llm.language import identify, page_records, train
from affinis.llm.merkle import manifest
from affinis.llm.mixing import plan_mix
from affinis.llm.near_dedup import near_duplicates
from affinis.llm.oracles import ORACLES
from affinis.llm.ordinal import score
from affinis.llm.ordinal import train as train_grades
from affinis.llm.pii import personal_data
from affinis.llm.resharding import OLD_SHARDS, reshard_files
from affinis.llm.search import search
from affinis.llm.token_files import tokens_by_document
from affinis.llm.tokens import token_counts
from affinis.llm.warc import archived
from affinis.llm.whitening import whiten

TOKENIZER = "byte_bpe_50k.json"

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the item."""
    return contaminated(_table(spark, sf_dir, "documents"), with_parts(_table(spark, sf_dir, "benchmark")))


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return plan_mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of each grade or more, and selection of every document; grade: quality, and one more if not toxic."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return score(docs, train_grades(docs, labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))))


def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New shard and slot of every document, from shards by a hash of the id to shards of equal bytes, read back from the written shards."""
    docs = _table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))
    return reshard_files(docs, old).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                     F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and class size of every document."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the token files."""
    return tokens_by_document(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (declared: ``lang``, host: ``source``) and of every page (markup, address)."""
    docs = _table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declared"),
                        F.col("source").alias("host"))
    pages = page_records(_table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    return identify(texts.unionByName(pages), train(docs))


def op9_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20, its whole text being the query."""
    docs = _table(spark, sf_dir, "documents")
    return search(docs, docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document, plain and disguised."""
    return personal_data(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and check of every document."""
    return manifest(_table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page, read back from the packages."""
    return archived(_table(spark, sf_dir, "pages"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every sound vector."""
    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_mixing_sources": op3_mixing_sources,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_resharding": op5_resharding,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_token_files": op7_token_files,
    "op8_language_id": op8_language_id,
    "op9_exact_search": op9_exact_search,
    "op10_pii": op10_pii,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc": op12_warc,
    "op13_embedding_whitening": op13_embedding_whitening,
}
