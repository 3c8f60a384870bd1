"""The text operators as named queries, with production parameters, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import bpe, exact_dedup, html_text, licenses, lines, mixing, periodic, phrases, piecewise, pseudonyms, quality, simhash, substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op4_exact_dedup": exact_dedup.SQL, "op7_source_mixing": mixing.SQL, "op11_phrase_mining": phrases.SQL, "op12_line_dedup": lines.SQL}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op1_simhash_near_dedup(spark, d):
    return simhash.near_duplicates(_table(spark, d, "documents"))


@query
def op2_license_scan(spark, d):
    return licenses.scan(licenses.shelved(_table(spark, d, "documents")))


@query
def op3_substring_dedup(spark, d):
    return substrings.passages(_table(spark, d, "documents"))


@query
def op4_exact_dedup(spark, d):
    return exact_dedup.exact_duplicates(_table(spark, d, "documents"))


@query
def op5_document_fingerprints(spark, d):
    return piecewise.with_edited(_table(spark, d, "documents"))


#: a key for the sample tables; real ones come from the caller and are kept secret
SAMPLE_KEY = b"sample key, not a secret"


@query
def op6_pii_pseudonyms(spark, d):
    return pseudonyms.with_pseudonyms(_table(spark, d, "documents"), SAMPLE_KEY)


@query
def op7_source_mixing(spark, d):
    return mixing.copies(_table(spark, d, "documents"))


@query
def op8_quality_classifier(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return quality.scored(docs, quality.train(docs, _table(spark, d, "labels")))


@query
def op9_html_main_text(spark, d):
    return html_text.main_text(_table(spark, d, "pages"))


@query
def op10_byte_bpe(spark, d):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded"))


@query
def op11_phrase_mining(spark, d):
    return phrases.collocations(_table(spark, d, "documents"))


@query
def op12_line_dedup(spark, d):
    left = lines.without_repeated(_table(spark, d, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_periodic_runs(spark, d):
    return periodic.digests(periodic.with_runs(periodic.with_planted(_table(spark, d, "documents"))))
