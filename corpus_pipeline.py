"""Pipeline over ``documents``: quality rules, near-duplicates, benchmark decontamination, pseudonyms, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxelry.llm import byte_bpe, decontamination, near_dedup, pii, quality_rules
from voxelry.llm.queries import PSEUDONYM_KEY, VOCABULARY
from voxelry.session import stage_path

#: Least similarity, in percent, of near-duplicates in the pipeline; the query op8_near_dedup has 85 by its own contract.
SIMILAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.deduplicate(docs, percent=SIMILAR)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; n_chars follows the text."""
    changed = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return changed.withColumn("n_chars", F.when(F.col("n_private") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("n_private")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the digests of the ids and of the decoded text."""
    return byte_bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("near-duplicates", deduplication), ("decontamination", contamination), ("pseudonyms", pseudonyms),
          ("tokens", tokens)]

#: SQL cannot express the tokenizer; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = stage_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
