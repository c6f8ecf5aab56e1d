"""Registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronostar.llm import (
    ann,
    bpe,
    decontamination,
    filter_audit,
    hilbert,
    html_text,
    jaccard_join,
    language_model,
    minmax_dedup,
    quality,
    spelling,
    token_counts,
    warc,
)
from chronostar.llm.oracles import ORACLE_SQL

SHARDS = 40
#: Tokens above which a document counts as too long.
TOKEN_LIMIT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontamination.find_contamination(docs, benchmark)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long"),
        F.col("n_hit").cast("long"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), TOKEN_LIMIT)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(_table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op11_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.components(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_decontamination,
    op2_neighbours,
    op3_token_counts,
    op4_quality,
    op5_jaccard_join,
    op6_warc,
    op7_hilbert,
    op8_bpe,
    op9_language_model,
    op10_main_text,
    op11_minmax_dedup,
    op12_filter_audit,
    op13_spelling,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
