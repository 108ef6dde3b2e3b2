"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, decontaminate, quality, secret_scan, simhash
from tidewatch.llm.common import without_rows
from tidewatch.plans.local import ensure_shared_folder
from tidewatch.session import work_path

# SQL has neither robust covariances, fingerprints nor token merges; the tests hold the stages against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return without_rows(docs, quality.judged(docs).where("NOT kept").select("id", "key"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_per_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_rows(docs, decontaminate.leaks(docs, benchmark).select("id", "key").distinct())


def strike_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind; `n_chars` follows the text."""
    clean = secret_scan.struck_out(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of the ids and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "text", "lang", "source"), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", strike_secrets),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
