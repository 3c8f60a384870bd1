"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. Ids may be null or repeat: rows are told apart by a number of their own, never by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridtide.llm import bpe, exact_dedup, mixing, quality, simhash
from gridtide.llm.common import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled ones of these, does not reject."""
    network = quality.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs.select(*COLUMNS), network)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the largest id."""
    return exact_dedup.keep_one(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and digests of the ids and of the text that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, decoded="decoded")
    return bpe.digests(ids, "ids")


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("SimHash near-dedup", dissimilar),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

#: a trained network cannot be stated in SQL; the stages are tested against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{number}")
    return docs
