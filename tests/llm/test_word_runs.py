import hashlib
import random
import zlib

import numpy as np
import pytest

from gaugeflow.llm.word_runs import find_runs, run_report, runs_of_texts, word_runs


def brute_runs(ids):
    """Every lag's maximal stretches one by one; the smallest period of equal ones."""
    n, out = len(ids), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if ids[i] != ids[i - q]:
                i += 1
                continue
            a = i
            while i < n and ids[i] == ids[i - q]:
                i += 1
            if i - a + q >= max(12, 2 * q):
                out.setdefault((a - q, i - a + q), q)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def sequences(count, seed):
    rnd = random.Random(seed)
    for t in range(count):
        n, kind = rnd.randrange(150), t % 5
        if kind < 2:
            yield [rnd.randrange(2 + 2 * kind) for _ in range(n)]
        elif kind == 2:  # periods after each other
            ids = []
            while len(ids) < n:
                ids += [rnd.randrange(3) for _ in range(rnd.randrange(1, 20))] * rnd.randrange(1, 6)
            yield ids
        elif kind == 3:  # runs inside runs
            yield (([0] * rnd.randrange(1, 30) + [1]) * rnd.randrange(1, 5) + [2]) * rnd.randrange(1, 4)
        else:  # Fibonacci words hold the most runs
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            b = b[:n]
            if b and rnd.random() < 0.5:
                b[rnd.randrange(len(b))] = 5
            yield b


def test_runs_equal_brute_force():
    for ids in sequences(3000, 7):
        assert [tuple(map(int, r)) for r in find_runs(np.array(ids, np.int64))] == brute_runs(ids)


def test_blocks_do_not_change_runs(monkeypatch):
    monkeypatch.setattr("gaugeflow.llm.word_runs.PAIRS", 7)
    for ids in sequences(400, 8):
        assert [tuple(map(int, r)) for r in find_runs(np.array(ids, np.int64))] == brute_runs(ids)


def test_texts_are_kept_apart():
    one, two = runs_of_texts([b"a " * 11, b"a " * 12])[0]
    assert len(one) == 0
    assert two.tolist() == [[0, 12, 1]]


def brute_report(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


EDGE = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (None, "no id " * 6), (None, None),
    (5, "x " * 40000), (6, "a b c " * 7 + "a"), (6, "a b c " * 7 + "a"), (7, "a b " * 12),  # no-break space: one word
    (8, "\x1ca \x1fa " * 9), (9, "ä ö　ü " * 8), (10, "a\x0bb\x0ca\rb " * 6),
    (11, ("x " * 13 + "y ") * 3), (12, ("p q " * 6 + "r ") + "p q " * 6),
]


def test_report_on_edge_rows_and_real_texts(spark):
    from tests.conftest import SF_SMALL

    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    looped = [(i, "w%d x y z " % i * 9) for i in range(5000, 5060)]  # some ids repeat words by the rule
    rows = EDGE + looped + [(i, t) for i, t in real if len((t or "").split()) < 1500]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in looped)
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, runs string, `a.b` int")
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = sorted((tuple(r[c] for c in names) for r in run_report(docs).collect()), key=str)
    assert got == sorted((brute_report(*r) for r in rows), key=str)


def test_other_columns_pass_and_clashing_ones_are_replaced(spark):
    docs = spark.createDataFrame([("k", "a b " * 8, "old")], "`my key` string, text string, collapsed string")
    (row,) = word_runs(docs).collect()
    assert row.asDict(recursive=True) == {
        "my key": "k", "runs": [{"start": 0, "length": 16, "period": 2}], "collapsed": "a b"}


def test_empty_table(spark):
    assert run_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("ids", [[0] * 30000, ([0] * 700 + [1]) * 20, list(range(10)) * 3000])
def test_long_texts_of_one_word_or_line(ids):
    """Occurrences inside a known run are not paired: no quadratic work."""
    assert len(find_runs(np.array(ids, np.int64))) in (1, 21)
