"""A training corpus from ``documents``: five stages, each on all rows that the
one before kept, with Parquet between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import decontam, language_crf, mixing, ngram_join, sharding
from gaugeflow.llm.common import prepare, stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the known languages (no letters, other scripts or languages and random letters: out; mixed texts stay),
    their ``lang`` the one recognised in the text."""
    prepare(spark)
    model = language_crf.train(docs)
    return language_crf.with_language(language_crf.keep_known(docs, model), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word n-gram similarity of 0.8 or more."""
    prepare(spark)
    return ngram_join.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (0 to 2 times)."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot."""
    prepare(spark)
    return sharding.assign_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# The language model and the similarity search cannot be written in SQL; the
# tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written as Parquet
    in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
