"""A training corpus from `documents`: quality, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all of docs and returns the
columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelwise.llm.mixing import mixed_documents
from panelwise.llm.ngram_join import first_of_each
from panelwise.llm.packing import pack
from panelwise.llm.quality import good_documents
from panelwise.llm.scratch import finished
from panelwise.llm.substring_dedup import cut_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the weakly supervised classifier rejects go. Null and empty texts are judged by their statistics, all 0; equal texts alike."""
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked at 0.8 of five-word shingles one stays: the smallest id, null ids last, of equal rows one. Wordless texts all stay."""
    return first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a smaller id has are cut; other texts, and those of null ids, stay as they are."""
    return cut_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix draws them; null sources are one source, wordless texts come in whole passes only."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2,048; null texts are empty, ties and repeated rows are pieces of their own."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixing", mixing), ("packing", packing),
]
#: Trained and hashed stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = finished(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
