"""Corpus cleaning: the stages of the training-data pipeline, applied in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpistar.llm import decontaminate, minhash_dedup, pieces, quality, secret_scan
from kpistar.llm.shared import Scratch, documents


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return minhash_dedup.without_near_duplicates(docs, minhash_dedup.Params(k=5, percent=80))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secret_scan.without_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of ids and the ids (begin and end included) of every text."""
    return pieces.encoded(docs.select("doc_id", "text")).selectExpr("doc_id", "size(ids) as n_tokens", "ids")


STAGES = [("quality", good_quality), ("near_duplicates", one_of_each), ("decontamination", decontaminated),
          ("secrets", secrets_masked), ("encoding", encoded)]

#: The first stage is a fitted classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage over what its predecessor kept; every result is written and read back."""
    scratch, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = scratch.put(out, f"{i}-{name}") if i < len(STAGES) - 1 else out
    return docs
