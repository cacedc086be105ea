"""From raw documents to token ids: quality, exact and near copies, the mix of sources, and byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next one's
docs. All but the last return the columns that docs came with. Each works on all rows that the stage before it kept:

    quality    documents that the classifier scores below its threshold go; it is fitted on the labelled ones among docs
    exact      of documents with equal texts (white space aside) the longest stays
    near       of documents linked by a similarity of 0.8 of their five-word shingles, the one with the smallest doc_id stays;
               candidates come from the SimHash search, and each is verified on its whole shingle sets
    mix        rows are dropped or repeated, once at most, so that each source's words come near its target
    tokens     doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left

Missing columns aside, the stages take what their operators take: nulls, empty tables, repeated rows and extra columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm import bpe, exact_dedup, mixing, quality, simhash
from sedimenta.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each_group(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.Mix().mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trips(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mix", mix_stage),
    ("tokens", token_stage),
]

#: SQL can't train the classifier, hash with XXH64 or encode; the tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
