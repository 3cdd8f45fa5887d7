import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gaugeflow.llm import bloom_lm as B

EDGE = [(1, None), (2, ""), (3, "  \n"), (4, "The the THE tHe"), (5, "Äpfel äpfel a b"), (6, "word " * 30000),
        (7, "only here once"), (7, "only here once"), (None, "no id"), (9, "a\x0bb\x0ca \x1c x")]


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


def _small(spark):
    from tests.conftest import SF_SMALL

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    return EDGE + [r for r in rows if r[0] > 9]


def test_contract_columns_against_counting(spark):
    rows = _small(spark)
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, out) if not h for w in words_of(t))
    total = sum(counts.values())
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    got = B.score_documents(docs.repartition(5)).collect()
    want = []
    for (i, t), h in zip(rows, out):
        w = words_of(t)
        want.append((str(i), h, len(w), sum(counts[x] > 0 for x in w), total,
                     round(sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in w), 5)))
    have = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5))
            for r in got]
    assert sorted(have) == sorted(want)
    assert all(r["score"] <= 0 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_joined_are_those_not_sent(spark, monkeypatch):
    """With almost no word at the workers, the join gives the same sums."""
    docs = spark.createDataFrame(_small(spark), "doc_id long, text string")
    model = B.fit(docs)
    a = {(r["doc_id"], r["n_tokens"]): r for r in B.score_texts(docs, model).collect()}
    monkeypatch.setattr(B, "HEAVY", 4)
    for r in B.score_texts(docs, model).collect():
        b = a[r["doc_id"], r["n_tokens"]]
        assert (r["n_known"], r["score"]) == (b["n_known"], b["score"])
        assert math.isclose(r["base_score"], b["base_score"], rel_tol=1e-12)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_routed_probes_give_the_broadcast_scores(spark, order, monkeypatch):
    monkeypatch.setattr(B, "BUCKET_BYTES", 40_000)
    docs = spark.createDataFrame(_small(spark), "doc_id long, text string").repartition(3)
    model = B.fit(docs, order=order)
    assert model.buckets > 3
    rows = [sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["score"], 9))
                   for r in B.score_texts(docs, model, broadcast_bytes=limit).collect()) for limit in (None, 0)]
    assert rows[0] == rows[1]


def _exact_score(tokens, counts, contexts, order, total, distinct, mean):
    """The model with exact levels (no false positives)."""
    s = 0.0
    for i in range(len(tokens)):
        def at(j):
            return tokens[j] if j >= 0 else b""
        p = (mean(1, counts[1][(at(i),)]) + 1) / (total + distinct + 1)
        for n in range(2, order + 1):
            before = tuple(at(j) for j in range(i - n + 1, i))
            gram = (*before, at(i))
            c = mean(1, counts[1][before]) if n == 2 else mean(-n, contexts[n][before])
            p = (min(mean(n, counts[n][gram]), c) + B.PRIOR * p) / (c + B.PRIOR)
        s += math.log10(p)
    return s


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_the_quantised_model_up_to_false_positives(spark, order):
    rows = _small(spark)[6:]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = B.fit(docs, order=order)
    counts = {n: Counter() for n in range(1, order + 1)}
    contexts = {n: Counter() for n in range(3, order + 1)}
    for _, t in rows:
        w = [b""] * (order - 1) + words_of(t)
        for i in range(order - 1, len(w)):
            for n in counts:
                counts[n][tuple(w[i - n + 1:i + 1])] += 1
            for n in contexts:
                contexts[n][tuple(w[i - n + 1:i])] += 1
    means = {}
    for f, c in [*counts.items(), *((-n, c) for n, c in contexts.items())]:
        number, mass = Counter(), Counter()
        for v in c.values():
            q = int(B.level(np.array([v]))[0])
            number[q] += 1
            mass[q] += v
        means[f] = {q: mass[q] / number[q] for q in number}

    def mean(f, c):
        return means[f][int(B.level(np.array([c]))[0])] if c else 0.0

    total, distinct = sum(counts[1].values()), len(counts[1])
    got = {(r["doc_id"], r["n_tokens"]): r["score"] for r in B.score_texts(docs, model).collect()}
    for i, t in rows:
        w = words_of(t)
        want = _exact_score(w, counts, contexts, order, total, distinct, mean)
        assert abs(got[i, len(w)] - want) <= 0.02 * abs(want) + 0.1  # levels raised by false positives


def test_filter_never_loses_a_level_and_rarely_adds_one():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 1 << 63, 40_000).astype(np.uint64))
    counts = (rng.pareto(0.8, len(h)) + 1).astype(np.int64)
    for family, most in ((1, 0.002), (2, 0.03)):
        size, bits = B.build_filter(h, counts, family)
        found = B.read_levels(h, family, size, bits)
        assert (found >= B.level(counts)).all()
        assert (found > B.level(counts)).mean() < most
    absent = np.unique(rng.integers(1 << 63, 1 << 64, 40_000, dtype=np.uint64))
    assert (B.read_levels(absent, 2, size, bits) > 0).mean() < 0.03


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert B.score_documents(empty).count() == 0
    model = B.fit(empty)
    docs = spark.createDataFrame([("k", "a b", 1)], "`my key` string, text string, n_known int")
    (row,) = B.score_texts(docs, model).collect()
    assert row["my key"] == "k" and row["n_tokens"] == 3 and row["n_known"] == 0 and row["score"] == 0.0
    assert B.score_texts(docs, model, broadcast_bytes=-1).collect() == [row]


@pytest.mark.parametrize("order", [1, 3])
def test_tally_holds_the_tokens_of_a_part_only(order, monkeypatch):
    """The counts of a chunk, gone through in parts, are those of the whole; no part exceeds the bound."""
    texts = [f"a{i % 7} b{i % 11} the c{i % 3}".encode() * (1 + i % 4) for i in range(400)] + [b"", b"x " * 3000]
    whole = B.Tokens(texts)
    want = dict(zip(whole.words, np.bincount(whole.ids).tolist()))
    grams = {f: np.unique(whole.grams(f), return_counts=True) for f in B.families(order)}
    held, make = [], B.Tokens

    def tokens(part):
        held.append((len(part), sum(map(len, part))))
        return make(part)

    monkeypatch.setattr(B, "Tokens", tokens)
    monkeypatch.setattr(B, "SCORE_BYTES", 500)
    monkeypatch.setattr(B, "MERGE_ENTRIES", 16)
    words, found = B.tally(texts, order)
    assert list(words.items()) == list(want.items())
    assert len(held) > 10 and all(n == 1 or size <= 500 for n, size in held)
    for f, (h, n) in grams.items():
        assert found[f][0].tolist() == h.tolist() and found[f][1].tolist() == n.tolist()
    assert [len(x) for x in B._merged([])] == [0, 0]
