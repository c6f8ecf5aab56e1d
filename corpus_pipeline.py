"""Corpus preparation: quality filter, near-duplicate removal, decontamination, encoding.

Each stage works on the documents that the last one kept; all but the last return the
columns of `documents` as they came. A document without any text is judged like others:
its quality score decides first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronostar.llm import bpe, decontamination, jaccard_join, quality
from chronostar.session import stage

VOCABULARY = "word_bpe_49k.json"

#: The rows can't be had from SQL (dictionaries, merges); tests hold them against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score under 0.5 go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return jaccard_join.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the text decoded from them."""
    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), digests=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
