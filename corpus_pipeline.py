"""A corpus from raw documents to token files: every stage is an operator of ``feedloom.llm`` on all that the last one kept.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.llm import decontam, jaccard, mixing, quality, token_files
from feedloom.llm.text import word_count
from feedloom.session import configure, written

VOCABULARY = "word_bpe_49k.json"

#: The outlier estimates, the coins' repeats and the token ids are no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier estimates keep."""
    configure(spark)
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every group of near duplicates."""
    configure(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    configure(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share of the mix asks for; repeats are rows of their own."""
    configure(spark)
    return mixing.mix(docs, word_count(F.col("text")))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and a row for every document in them as they read back."""
    configure(spark)
    return token_files.read_documents(token_files.write_token_files(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("token files", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
