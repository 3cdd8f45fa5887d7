"""Registered queries of the training-data operators."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (bloom_lm, decontam, fingerprints, language_crf, mixing, ngram_join, sharding, suffix_dedup,
                           token_cache, url_rules, warc, whitening, word_runs)
from gaugeflow.llm.common import prepare, table
from gaugeflow.session import staging_path

TOKENIZER = "byte_bpe_50k.json"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document in 200-byte strings that start more than once."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by a mix of 150% of all words."""
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk fingerprints of every document, its edit and its successor."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives with an index and read back through it."""
    folder = staging_path(spark, f"warc-{uuid.uuid4().hex}")
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return (warc.read_records(index, folder)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents within their edit budget."""
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by listed and mined rules."""
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document through a digest cache (a new one per run)."""
    return token_cache.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                    staging_path(spark, "token-cache"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a CRF fitted on documents not held out."""
    docs = table(spark, sf_dir, "documents")
    return language_crf.predict_language(docs, language_crf.train(docs))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity class and number of links of every document."""
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near equal bytes."""
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document and its text without repeats."""
    return word_runs.run_report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components 1 to 32 of every embedding."""
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by a Bloom-filter bigram model."""
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


_QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_mix_sources, op3_fingerprints, op4_warc, op5_decontaminate, op6_url_rules,
    op7_token_counts, op8_language, op9_ngram_join, op10_shards, op11_word_runs, op12_whitening, op13_lm_score)}

# Token counts need the tokenizer, the other queries hashes, models or searches
# that SQL on whole tables cannot express in reasonable time.
_ORACLE: dict[str, str] = {
    "op4_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM q""",
}


def queries():
    def prepared(f):
        def run(spark, sf_dir):
            prepare(spark)
            return f(spark, sf_dir)
        run.__name__, run.__doc__ = f.__name__, f.__doc__
        return run
    return {name: prepared(f) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
