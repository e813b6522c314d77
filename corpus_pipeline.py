"""A training-data pipeline over ``documents``: toxicity, near duplicates,
personal data, mixing, byte-level BPE.

Each stage is a function of (spark, docs, sf_dir) that works on all its
predecessor kept; its result is written as Parquet to the shared folder and
read again as the next one's input, so that a lost executor costs a stage at
most.  All stages but the last return the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deidlake.llm import bpe, mixing, pii, simhash, toxicity
from deidlake.llm.common import scratch, table
from deidlake.llm.queries import RANKS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: The models, hashes and token ids of the stages are beyond SQL; the tests
#: compare each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
