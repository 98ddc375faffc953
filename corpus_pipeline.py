"""A training corpus from documents, in five stages. Each stage's result is written and read again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import decontaminate, line_dedup, mixing, ngram_join, quality_rules
from lodestone.llm.common import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has alike."""
    return line_dedup.dedup_lines(docs, line_dedup.ALL)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group that five-word shingles link at 0.8 or more."""
    return ngram_join.drop_linked(docs, shingle=5, num=4, den=5)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: the columns of documents, a row per copy, with mix_shard, mix_order and mix_copy."""
    return mixing.mixed_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near copies", near_copies), ("decontamination", clean_of_benchmark), ("mixing", mixture)]

#: No SQL: robust fits and MinHash components are not expressible; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "pipeline")
    return docs
