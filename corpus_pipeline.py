"""A corpus pipeline of five stages, each calling one operator of ``subledger.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared checkpoint folder and reread as the next stage's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subledger.llm import decontaminate, exact_dedup, language_id, simhash
from subledger.llm.common import stored
from subledger.llm.queries import bpe_digests, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, or no letter) go."""
    return language_id.known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one stays."""
    return exact_dedup.distinct_texts(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest doc_id stays."""
    return simhash.one_per_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages over the contract's share go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as byte-level BPE ids, round trip included."""
    return bpe_digests(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]

#: SQL cannot express language ID, XXH64 fingerprints or BPE; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
