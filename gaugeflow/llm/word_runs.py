"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and a length of at least ``max(12, 2q)`` that no neighbouring word
extends. On the diagonal of lag q the DP holds how many consecutive words so
far equal the word q before them; a word's earlier occurrences lengthen the
diagonals of their lags, and a diagonal that its next word breaks emits its run
at once when it is long enough.

It is sparse in two exact ways. A run's diagonal matches for at least six words
and for at least q, so lags ``[6 * 2^k, 12 * 2^k)`` only look at occurrences
with the same last ``6 * 2^k`` words (the first level takes all lags below 12).
And two occurrences inside one known run lie a multiple of its period apart:
their diagonal can make no run of its own, so they are not paired. Words go
through in blocks of a bounded number of pairs; what is held across blocks is
the open diagonals.

Every text is worked on by itself, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LENGTH = 12
GRAM = MIN_LENGTH // 2  # the fewest matches that a run's diagonal has
PAIRS = 1 << 20  # pairs of occurrences held at a time
WORDS = 1 << 18  # words of short texts worked on together

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Equal numbers for equal tuples of keys."""
    out = keys[0]
    for key in keys[1:]:
        out = np.unique(out * (int(key.max(initial=0)) + 1) + key, return_inverse=True)[1]
    return out.astype(np.int64)


def _join(q, a, b):
    """Stretches [a, b] of diagonals q, those that follow each other joined."""
    order = np.lexsort((a, q))
    q, a, b = q[order], a[order], b[order]
    first = np.ones(len(q), bool)
    first[1:] = (q[1:] != q[:-1]) | (a[1:] != b[:-1] + 1)
    last = np.append(first[1:], True)
    return q[first], a[first], b[last]


def _diagonals(ends, grams, cluster, low, high, n) -> Iterator[tuple[np.ndarray, ...]]:
    """Closed stretches (lag, first, last word) of gram matches with ``low <= lag < high``.

    ``ends``: the last word of every gram, ascending; ``grams``: its number;
    ``cluster``: the known run that holds it, or -1."""
    order = np.argsort(grams, kind="stable")
    key, pos = grams[order] * (n + 1), ends[order]
    sort_key = key + pos
    # the part of its group that is at least low and less than high before a word
    lo = np.searchsorted(sort_key, np.maximum(key, sort_key - high + 1))
    hi = np.searchsorted(sort_key, np.maximum(key, sort_key - low + 1))
    held = cluster[order]
    own = np.ones(len(pos), bool)  # where a group's stretch inside one run begins
    own[1:] = (key[1:] != key[:-1]) | (held[1:] != held[:-1]) | (held[1:] < 0)
    begin = np.maximum.accumulate(np.where(own, np.arange(len(pos)), 0))
    count = np.maximum(np.minimum(hi, begin) - lo, 0)
    by_word = np.argsort(pos, kind="stable")
    by_word = by_word[count[by_word] > 0]
    total = np.cumsum(count[by_word])
    open_ = tuple(np.empty(0, np.int64) for _ in range(3))
    at = 0
    while at < len(by_word):
        done = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        block = by_word[at:upto]
        size = count[block]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        word = np.repeat(pos[block], size)
        lag = word - pos[np.repeat(lo[block], size) + within]
        q, a, b = _join(*(np.concatenate(x) for x in zip(open_, (lag, word, word))))
        going = b == pos[block[-1]]
        yield q[~going], a[~going], b[~going]
        open_ = q[going], a[going], b[going]
        at = upto
    yield open_


def find_runs(ids: np.ndarray) -> np.ndarray:
    """All runs of a sequence of word numbers (not negative), as rows (start,
    length, period) ordered by start, then period. A number that occurs once
    separates texts: no run crosses it."""
    ids = np.asarray(ids, np.int64)
    n = len(ids)
    runs = np.empty((0, 3), np.int64)
    gram, low, high = 1, 1, MIN_LENGTH
    ends, grams = np.arange(n), ids
    while True:
        wanted = GRAM if gram < GRAM else 2 * gram
        if gram < GRAM:
            if n < GRAM:
                break
            pair = _ranks(ids[:-1], ids[1:])
            four = _ranks(pair[:-2], pair[2:])
            grams, ends = _ranks(four[:-2], pair[4:]), np.arange(GRAM - 1, n)
        else:  # the gram that ends here after the one that ends where it begins
            number = np.full(n, -1, np.int64)
            number[ends] = grams
            before = number[np.maximum(ends - gram, 0)]
            fits = (ends >= gram) & (before >= 0)
            grams, ends = _ranks(before[fits], grams[fits]), ends[fits]
            low, high = wanted, 2 * wanted
        gram = wanted
        many = np.bincount(grams)[grams] > 1 if len(grams) else np.empty(0, bool)
        grams, ends = grams[many], ends[many]
        if not len(ends):
            break
        inside = np.full(n, -1, np.int64)
        for i, (s, length, period) in enumerate(runs):
            if 2 * period <= gram <= length:
                inside[s + gram - 1:s + length] = i
        found = [runs]
        for q, a, b in _diagonals(ends, grams, inside[ends], low, high, n):
            matches = b - a + gram
            ok = matches >= np.maximum(q, MIN_LENGTH - q)
            q, start, stop = q[ok], a[ok] - gram + 1 - q[ok], b[ok] + 1
            # a diagonal cut by an unpaired occurrence goes on beyond an end: no run of its own
            left = (start > 0) & (ids[np.maximum(start - 1, 0)] == ids[np.maximum(start - 1, 0) + q])
            right = (stop < n) & (ids[np.minimum(stop, n - 1)] == ids[np.minimum(stop, n - 1) - q])
            whole = ~left & ~right
            found.append(np.stack([start, stop - start, q], 1)[whole])
        runs = np.concatenate(found)
        # multiples of a run's period have its start and length; the smallest period stays
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """The words that no run repeats (in no run after its first period)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def runs_of_texts(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs and collapsed text of every text."""
    words = [t.split() for t in texts]  # bytes split at [\x20\x09-\x0D]+ exactly
    seen: dict[bytes, int] = {}
    parts, at, size = [], [0], 0
    for w in words:
        parts.append(np.fromiter((seen.setdefault(x, len(seen)) for x in w), np.int64, len(w)))
        size += len(w) + 1
        at.append(size)
    ids = np.empty(size, np.int64)
    for i, part in enumerate(parts):
        ids[at[i]:at[i + 1] - 1] = part
        ids[at[i + 1] - 1] = len(seen) + i  # a separator that occurs once
    runs = find_runs(ids)
    cut = np.searchsorted(runs[:, 0], at)
    out, collapsed = [], []
    for i, w in enumerate(words):
        mine = runs[cut[i]:cut[i + 1]] - [at[i], 0, 0]
        out.append(mine)
        if len(mine):
            w = [x for x, keep in zip(w, _kept(len(w), mine).tolist()) if keep]
        collapsed.append(b" ".join(w))
    return out, collapsed


def word_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with two columns in place of ``text``: ``runs`` (array of
    start, length, period, by start, then period) and ``collapsed`` (the words
    that no run repeats, joined by a space).

    A null text is empty: no runs, an empty collapsed text. Texts of any length
    go whole; rows are independent, so repeated rows and ids give equal rows.
    Other columns pass through (the two new names must not be among them: such
    columns are replaced).
    """
    keep = [c for c in docs.columns if c not in (text, runs, collapsed)]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias(text))
    schema = T.StructType([rows.schema[c] for c in keep]
                          + [T.StructField(runs, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())])

    def answer(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        lists, short, part, size = [], [], [], 0
        for t in texts + [None]:
            if part and (t is None or size + len(t) > 6 * WORDS):
                a, b = runs_of_texts(part)
                lists, short, part, size = lists + a, short + b, [], 0
            if t is not None:
                part.append(t)
                size += len(t)
        flat = np.concatenate(lists) if lists else np.empty((0, 3), np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        entries = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)],
                                             names=["start", "length", "period"])
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        columns += [pa.ListArray.from_arrays(pa.array(offsets), entries), pa.array(short, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*keep, runs, collapsed])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield answer(batch)

    return rows.mapInArrow(each, schema)


def looped(doc_id, text, words_pattern: str = r"([^\x20\x09-\x0D]+)"):
    """The query's text: where h = crc32(decimal doc_id) is divisible by ten,
    word i >= a becomes word a + (i - a) % p, with g = floor(h / 10),
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null id leaves it."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(words_pattern), 1)

    def repeat(w):
        n = F.size(w)
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")).otherwise(F.lit(""))

    # one evaluation of the words: they are bound as the element of an array
    changed = F.get(F.transform(F.array(words), repeat), 0)
    return F.when(F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False)), changed).otherwise(text)


def run_report(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text; the text of :func:`looped`) the number of
    runs, the longest one (ties: smallest start, then period; four nulls
    without a run) and digests of all runs and of the collapsed text."""
    texts = docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = word_runs(texts)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))
    found = found.select("doc_id", "runs", "collapsed", best.alias("b"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("b.back")).alias("start"),
        F.col("b.length").alias("length"),
        (-F.col("b.small")).alias("period"),
        F.expr("1000 * b.length div -b.small").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
