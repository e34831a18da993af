"""Documents to training tokens in five stages, each written as Parquet and read again.

Null texts and texts that are in no known language leave in the first stage; of equal and of nearly
equal texts one stays; the rest is mixed by source; the last stage adds the tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from replenish.llm import bpe, exact_dedup, language, mixing, near_dedup
from replenish.llm.common import documents
from replenish.operators.scale import materialise

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# Five words and a similarity of 0.8 or more.
NEAR = near_dedup.Rule(words=5, percent=80)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: no null text, none without letters, none far from every
    language. The model is learned from the documents themselves; without a label there is no
    distance to judge by."""
    return language.keep_known(docs, language.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.deduplicate(docs, NEAR)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0 to 3 rows each."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their tokens, and digests of tokens and of the text decoded from them."""
    return bpe.encoded_documents(docs, TOKENIZER)


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", source_mix),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs


# SQL can express neither the language model nor the signatures; tests hold the stages against
# brute force.
ORACLE_SQL = None
