"""A corpus made ready for training: each stage is one operator of ``litscreen.llm`` on what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from litscreen.llm import automaton, mixing, rules, secrets, vantage
from litscreen.llm.queries import WEIGHTS
from litscreen.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the list learned from the labels keep."""
    return rules.kept_rows(docs, rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest ID."""
    return vantage.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secrets.redact(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for, in random order."""
    return mixing.replicate(docs, WEIGHTS).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their tokens."""
    return automaton.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_to_weights),
    ("BPE encoding and decoding", bpe_encoding),
]
#: Learned rules, fingerprints and tokens have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
