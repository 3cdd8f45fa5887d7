"""The pipeline on a small table: every stage does its work on what it gets."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from gaugeflow.llm import decontam, language_crf
from gaugeflow.llm.common import prepare, table

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    prepare(spark)
    docs = table(spark, SF, "documents")
    at, frames = docs, []
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF).cache()
        frames.append({name: at})
        if name != "shards":
            assert at.columns == docs.columns, name
    texts = {n: [(r.doc_id, r.text) for r in f.select("doc_id", "text").collect()] for x in frames for n, f in x.items()}
    assert set(texts["language_id"]) <= {(r.doc_id, r.text) for r in docs.collect()}
    assert len(texts["language_id"]) >= 0.99 * docs.filter("text rlike '[a-z]'").count()
    # brute force: one text of each 5-word Jaccard class of 0.8 or more
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts["language_id"] if (w := t.lower().split())}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert sorted(i for i, _ in texts["near_duplicates"]) == sorted({find(i) for i in ids} | {i for i, t in texts["language_id"] if i not in sets})
    items = [decontam.normalised(r.text) for r in table(spark, SF, "benchmark").collect()]
    held = {i for i, t in texts["near_duplicates"] if any(x in decontam.normalised(t) for x in items)}
    assert held and {i for i, _ in texts["decontamination"]} == {i for i, _ in texts["near_duplicates"]} - held
    assert set(Counter(texts["source_mix"]).values()) <= {1, 2} and set(texts["source_mix"]) <= set(texts["decontamination"])
    assert Counter(texts["shards"]) == Counter(texts["source_mix"])
    again = corpus_pipeline.run(spark, SF)
    assert again.columns == at.columns
    assert Counter((r.doc_id, r.shard) for r in again.collect()) == Counter((r.doc_id, r.shard) for r in at.collect())
    assert language_crf.UNKNOWN == "und"


def test_the_recognised_language_reaches_the_shards(spark):
    """Wrong and missing labels: every later stage hands on what the text says."""
    prepare(spark)
    docs = table(spark, SF, "documents")
    asked = {r.doc_id: r.lang_pred for r in language_crf.predict_language(docs, language_crf.train(docs)).collect()}
    mislabelled = docs.withColumn("lang", F.when(~language_crf.held_out(F.col("doc_id")), F.col("lang")))
    at = mislabelled
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
    got = at.select("doc_id", "lang").collect()
    assert got and any(r.doc_id in asked for r in got) and all(r.lang == asked[r.doc_id] for r in got)
