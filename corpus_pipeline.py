"""A training corpus from documents: stages applied one after the other, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard_join, packing, quality, queries, secret_scan
from millrace.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labels outside the held-out fold, accepts."""
    labels = queries.table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    return quality.accepted(docs, quality.fit(docs, labels, "quality"), queries.QUALITY_THRESHOLD)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    return jaccard_join.one_of_each(docs)


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark passages."""
    return decontaminate.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def free_of_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` brought up to date where there were any."""
    return secret_scan.redacted(docs, length="n_chars")


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences for training."""
    return packing.report(packing.pack(docs, queries.encoder()))


STAGES = [("quality", good_quality), ("similar", one_of_similar), ("benchmark", free_of_benchmark),
          ("secrets", free_of_secrets), ("packing", in_sequences)]
ORACLE_SQL = None  # the classifier, the joins' components and the tokens are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
