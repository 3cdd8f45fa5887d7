"""Token counts with a digest cache.

A stored count is found by (content digest, tokenizer-version digest). Only
one text per missing digest is encoded; the new counts are appended to the
cache, a Parquet folder shared by all runs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage, text_or_empty

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
# Encoding rules that a stored count depends on besides the vocabulary file.
RULES = "no added special tokens, no truncation, no padding"


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer version: its file's content and the encoding rules."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + RULES.encode()).hexdigest()


# White space, what follows up to the next white space, and characters that
# Python takes for white space but tokenizers do not.
SEGMENT = re.compile(r"\s*\S+(?:[\x1c-\x1f]\S*)*|\s+")
MEMO_SEGMENTS, MEMO_CHARS, OFTEN = 400_000, 64, 2


def _splits_at_spaces(path: str) -> bool:
    """Whether the tokens of a text are those of its segments one by one: true
    for byte-level splitting by the usual pattern, which never joins a
    non-space with a following space, without normalisation or special tokens
    that reach over white space."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    split = rules.get("pre_tokenizer") or {}
    return (rules.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in rules.get("added_tokens", ())))


def _by_segment(count):
    """Counts per text as sums over its segments. Segments that come often are
    encoded once and remembered; the others of a text are encoded together,
    in their order (they still part at the same places)."""
    memo: dict[str, int] = {}

    def run(texts):
        if len(memo) > MEMO_SEGMENTS:
            memo.clear()
        parts = [SEGMENT.findall(t) for t in texts]
        new = Counter(s for part in parts for s in part if s not in memo)
        often = [s for s, n in new.items() if n >= OFTEN and len(s) <= MEMO_CHARS]
        memo.update(zip(often, count(often)))
        get = memo.get
        known = [[get(s) for s in part] for part in parts]
        rest = count(["".join([s for s, n in zip(part, ns) if n is None]) for part, ns in zip(parts, known)])
        return [sum(n for n in ns if n is not None) + r for ns, r in zip(known, rest)]
    return run


def _counter(path: str):
    """A function from texts to token counts by the library for ``path``."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def count(texts):
            return [len(e) for i in range(0, len(texts), 64)  # few encodings are held at a time
                    for e in tokenizer.encode_batch_fast(texts[i:i + 64], add_special_tokens=False)]
        return _by_segment(count) if _splits_at_spaces(path) else count
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(e) for e in model.encode(texts, num_threads=1)]
    raise ValueError(f"no tokenizer library for {path}")


def _encode(path: str):
    def run(batches):
        count = _counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts: list[int] = []
            for i in range(0, len(texts), 500):
                counts += count(texts[i:i + 500])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def cached_counts(spark: SparkSession, cache_dir: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for a tokenizer version; none if there is no cache."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache_dir)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).filter(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, tokenizer: str, cache_dir: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``
    (doc_id, text; other columns unused); ``over_limit`` is n_tokens > limit.

    A null text counts as the empty one (0 tokens); repeated rows and ids give
    a row each. ``cache_dir`` is a folder all executors reach; runs that append
    the same digest at once leave equal rows, which a read folds.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    body = text_or_empty()
    keyed = docs.select("doc_id", body.alias("text"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"))
    narrow = stage(keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "token-digests")
    known = cached_counts(spark, cache_dir, version)
    # one row per missing digest; only narrow rows are grouped, the text moves once
    missing = stage(narrow.groupBy("digest").agg(F.min("doc_id").alias("__id"))
                    .join(known, "digest", "left_anti").withColumnRenamed("digest", "__digest"), "token-missing")
    texts = (keyed.join(missing.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id"))
                        & (F.col("digest") == F.col("__digest")))
             .select("digest", "text"))
    counted = (texts.mapInArrow(_encode(tokenizer), "digest binary, n_tokens long")
               .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))  # rows repeated with one id
    (counted.select("digest", "n_tokens", F.lit(version).alias("tokenizer"))
     .write.mode("append").parquet(cache_dir))
    counts = stage(cached_counts(spark, cache_dir, version), "token-counts")
    return (narrow.join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
