"""A training-corpus pipeline: language, near-duplicates, contamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and
returns a DataFrame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import bpe, decontaminate, language_id, pii, simhash_dedup
from folioscope.llm.common import give_back, written

VOCABULARY = "byte_bpe_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts."""
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    give_back()  # the driver lives on through all stages
    return language_id.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked by its kind."""
    return pii.mask(docs, pii.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids (little-endian unsigned 32-bit), their number, and whether they decode to the text."""
    path = public_tokenizers.path(VOCABULARY)
    back = bpe.encode(docs, path, keep=("doc_id", "text"), decoded=True)
    return back.selectExpr("doc_id", "ids", "n_tokens", "decoded <=> cast(coalesce(text, '') as binary) as exact")


STAGES = [
    ("language_id", language),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("pii_masking", personal_data),
    ("byte_bpe", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
