"""The corpus pipeline: stages over documents, each written and read again before the next.

Documents that the quality classifier rejects go; of near duplicates one stays; documents that share a passage with the benchmark
go; secrets in the texts become a mark; what is left is encoded as tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fitlens.llm import bpe, decontaminate, near_duplicates, quality, secrets
from fitlens.llm.registry import table
from fitlens.session import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Rows are judged by their text alone, null as empty."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by shingles of five words, the one with the smallest id. Documents without
    words or with a null id stay."""
    return near_duplicates.distinct_documents(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words, and no whole shorter item, with the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact(docs)


def token_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with the digests of the ids and of the text decoded from them."""
    import public_tokenizers

    return bpe.bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality classifier", good_documents),
    ("near duplicates", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("secret scan", redacted_documents),
    ("byte-level BPE", token_documents),
]
# Boosted trees, a random forest, MinHash and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each works on everything that its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
