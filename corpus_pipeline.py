"""From raw documents to token ids: the stages in order, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorelake.llm import bpe, cotrain, decontaminate, secrets, simhash
from scorelake.llm.common import landed, table, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return cotrain.keep_good(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id."""
    return simhash.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one word in twenty or more inside benchmark windows go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; found secrets are replaced in the text."""
    return secrets.redact(docs, secrets.fit(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of the ids and of the decoded text."""
    return bpe.bpe(docs, tokenizer_path("word_bpe_49k.json"), with_ids=True, with_decoded=False)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark_free),
    ("secrets", without_secrets),
    ("bpe", token_ids),
]

#: Models, Unicode rules and hashing keep these rows out of reach of SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = landed(docs)
    return docs
