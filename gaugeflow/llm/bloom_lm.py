"""Language-model scoring from a log-frequency Bloom filter.

Training counts n-grams exactly (per task first, then per hash bucket) and
stores of every count only its level 1 + floor(log_1.5 c): an n-gram of level q
is entered with each of 1..q. Scoring asks the filter for (n-gram, 1),
(n-gram, 2), ... until a probe fails; the mean count of the level reached is
the n-gram's count. A false positive can only raise a level, and by one more
with the false-positive rate again. Probabilities are smoothed towards the
shorter n-gram: P(w | v) = (c(v w) + M P(w)) / (c(v) + M).

The filter grows with the corpus and is held in segments, one per bucket of the
n-gram hash. It is broadcast while its measured size is within
``BROADCAST_BYTES``; beyond that every chunk of texts sends its distinct n-grams
to the segments and gets a byte for each back, with the same result. The model
is a Parquet table in the shared folder.

Word counts are also kept exactly. Words that make up at least 2^-18 of the
training tokens (so at most 2^18 words) go to the workers; the others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import stage

END = b""  # the token after the last word; also what precedes the first
ORDER = 2
PRIOR = 1000.0  # M, the weight of the shorter n-gram's probability in counts (best on held-out texts)
BASE = 1.5  # of the levels
HASHES, WORD_HASHES = 6, 12  # probes per level: false positives about 1.6 % and, for single words, 0.02 %
BITS = 1.5  # per entry and probe
LEVELS = 120  # more than 1.5 ** 120 counts do not occur
BUCKET_BYTES = 32 << 20  # text per bucket of n-grams
CHUNK_BYTES = 12 << 20  # text worked on at a time
SCORE_BYTES = 2 << 20  # the same where nothing is sent elsewhere per chunk, and the tokens held at once
MERGE_ENTRIES = 1 << 19  # counts merged at a time
BROADCAST_BYTES = 96 << 20
HEAVY = 1 << 18

_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _MUL[1]
    h = (h ^ (h >> _U(27))) * _MUL[2]
    return h ^ (h >> _U(31))


def _scaled(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes as numbers below ``size`` (ascending hashes, ascending numbers)."""
    return ((h >> _U(32)) * _U(size)) >> _U(32)


def families(order: int) -> list[int]:
    """What is counted: n-grams of 1..order words (n) and, from three words on,
    their contexts (-n); a word counts as the context of two itself."""
    return [*range(1, order + 1), *(-n for n in range(3, order + 1))]


class Tokens:
    """The tokens of a chunk of texts: A-Z in lower case, words cut at
    [\\x20\\x09-\\x0D]+, one END after each text."""

    def __init__(self, texts: list[bytes]):
        seen = {END: 0}
        parts = []
        for t in texts:
            w = t.lower().split()
            parts.append(np.fromiter((seen.setdefault(x, len(seen)) for x in w), np.int64, len(w)))
            parts.append(np.zeros(1, np.int64))
        self.words = list(seen)
        self.ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.sizes = np.array([len(x) + 1 for x in parts[::2]], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        self._h = hashes[self.ids]
        self._end = hashes[0]
        self._at = np.arange(len(self.ids)) - np.repeat(self.starts, self.sizes)

    def _before(self, k: int) -> np.ndarray:
        """The hash of the token k places before, END before a text."""
        if k == 0:
            return self._h
        moved = np.concatenate([np.full(min(k, len(self._h)), self._end, np.uint64), self._h[:-k]])
        return np.where(self._at >= k, moved, self._end)

    def grams(self, family: int) -> np.ndarray:
        """The hash of every token's n-gram (or context) of a family."""
        places = range(family) if family > 0 else range(1, -family)
        h = np.full(len(self._h), (abs(family) * 2 + (family < 0)) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
        for k in places:
            h = _mix(h * _MUL[0] + self._before(k))
        return h


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def _probes(h: np.ndarray, at: int, size: int, family: int) -> Iterator[np.ndarray]:
    key = _mix(h + _U(at * int(_MUL[0]) % (1 << 64)))
    step = _mix(key ^ _MUL[1]) | _U(1)
    for _ in range(WORD_HASHES if family == 1 else HASHES):
        yield _scaled(key, size).astype(np.int64)
        key = key + step


def build_filter(hashes: np.ndarray, counts: np.ndarray, family: int) -> tuple[int, bytes]:
    """Bits (number and packed) holding every distinct hash at levels 1..its own."""
    levels = level(counts)
    size = max(64, int(levels.sum() * BITS * (WORD_HASHES if family == 1 else HASHES)))
    bits = np.zeros(size, bool)
    for a in range(0, len(hashes), MERGE_ENTRIES):
        h, top = hashes[a:a + MERGE_ENTRIES], levels[a:a + MERGE_ENTRIES]
        for q in range(1, int(top.max(initial=0)) + 1):
            for at in _probes(h[top >= q], q, size, family):
                bits[at] = True
    return size, np.packbits(bits, bitorder="little").tobytes()


def read_levels(hashes: np.ndarray, family: int, size: int, bits: bytes) -> np.ndarray:
    """The level of every hash: how many probes succeed before the first that fails."""
    packed = np.frombuffer(bits, np.uint8)
    found = np.zeros(len(hashes), np.uint8)
    alive = np.arange(len(hashes))
    for q in range(1, LEVELS):
        held = np.ones(len(alive), bool)
        for at in _probes(hashes[alive], q, size, family):
            held &= (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive = alive[held]
        found[alive] = q
        if not len(alive):
            break
    return found


def _chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int | None = None) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """The rows of a partition, ``limit`` bytes (CHUNK_BYTES) of text, or one text, at a time."""
    limit = CHUNK_BYTES if limit is None else limit
    held, texts, size = [], [], 0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).to_pylist()
        begin = 0
        for i, t in enumerate(column):
            if texts and size + len(t) > limit:
                yield pa.Table.from_batches([*held, batch.slice(begin, i - begin)]), texts
                held, texts, size, begin = [], [], 0, i
            texts.append(t)
            size += len(t)
        held.append(batch.slice(begin))
    if texts:
        yield pa.Table.from_batches(held), texts


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts, SCORE_BYTES or one at a time."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > SCORE_BYTES:
            yield texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield texts[begin:]


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct hashes and their summed counts, from blocks of ascending
    distinct hashes with counts. Ranges of hashes are merged one after the other."""
    found = [x for x in found if len(x[0])]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low, high = min(int(h[0]) for h, _ in found), max(int(h[-1]) for h, _ in found)
    steps = -(-sum(len(h) for h, _ in found) // MERGE_ENTRIES)
    edges = np.array([low + (high - low) * i // steps for i in range(1, steps)], np.uint64)
    cuts = [[0, *np.searchsorted(h, edges).tolist(), len(h)] for h, _ in found]
    hashes, counts = [], []
    for i in range(steps):
        h = np.concatenate([x[c[i]:c[i + 1]] for (x, _), c in zip(found, cuts)])
        n = np.concatenate([x[c[i]:c[i + 1]] for (_, x), c in zip(found, cuts)])
        if len(h):
            by = np.argsort(h)
            h = h[by]
            first = np.append(True, h[1:] != h[:-1]).nonzero()[0]
            hashes.append(h[first])
            counts.append(np.add.reduceat(n[by], first, dtype=np.int64))
    return np.concatenate(hashes), np.concatenate(counts)


def tally(texts: list[bytes], order: int) -> tuple[dict[bytes, int], dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The count of every word (and END), and of every n-gram by family, as
    ascending hashes and counts; the tokens of SCORE_BYTES of text are held at once."""
    words: dict[bytes, int] = {}
    found: dict[int, list] = {f: [] for f in families(order)}
    for part in _parts(texts):
        tokens = Tokens(part)
        for w, n in zip(tokens.words, np.bincount(tokens.ids, minlength=len(tokens.words)).tolist()):
            words[w] = words.get(w, 0) + n
        for f, blocks in found.items():
            blocks.append(np.unique(tokens.grams(f), return_counts=True))
    return words, {f: _merged(blocks) for f, blocks in found.items()}


# -- training ---------------------------------------------------------------------

BLOCKS = "kind string, family int, bucket int, data binary, counts binary"
MODEL = "kind string, family int, bucket int, word binary, n long, total long, bits binary"


@dataclass
class Model:
    """A fitted model: its table (kind ``word``: word and its count in ``total``;
    ``filter``: a segment of n bits; ``level``: n n-grams of level ``bucket``
    with ``total`` occurrences), its number of buckets and its totals."""

    table: DataFrame
    buckets: int
    order: int
    tokens: int
    words: int
    means: dict[int, np.ndarray]


def fit(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count the n-grams of all texts (null: empty) of ``docs``; other columns are not read."""
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("t"))
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _chunks(batches, "t"):
            counted, grams = tally(part, order)
            words, each = list(counted), np.fromiter(counted.values(), np.uint32, len(counted))
            word_hash = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in words), np.uint64, len(words))
            place = _scaled(word_hash, buckets).astype(np.int64)
            by = np.argsort(place, kind="stable")
            rows = []
            for b, members in _split(place[by], by):
                rows.append(("word", 0, b, b" ".join([words[i] for i in members.tolist()]), each[members].tobytes()))
            for f, (h, n) in grams.items():
                for b, members in _split(_scaled(h, buckets).astype(np.int64), np.arange(len(h))):
                    rows.append(("gram", f, b, h[members].tobytes(), n[members].astype(np.uint32).tobytes()))
            for kind, f, b, data, counts in rows:
                yield pa.RecordBatch.from_pydict(
                    {"kind": [kind], "family": pa.array([f], pa.int32()), "bucket": pa.array([b], pa.int32()),
                     "data": pa.array([data], pa.binary()), "counts": pa.array([counts], pa.binary())})

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        kind, f, b = (k.as_py() for k in key)
        blocks = [(d.as_buffer(), np.frombuffer(c.as_buffer(), np.uint32)) for d, c in zip(table.column("data"), table.column("counts"))]
        if kind == "word":
            total: dict[bytes, int] = {}
            for data, counts in blocks:
                for w, c in zip(data.to_pybytes().split(b" "), counts.tolist()):
                    total[w] = total.get(w, 0) + c
            return _rows("word", f, b, list(total), [None] * len(total), list(total.values()), [None] * len(total))
        h, counts = _merged([(np.frombuffer(data, np.uint64), counts) for data, counts in blocks])
        bits_n, bits = build_filter(h, counts, f)
        levels = level(counts)
        number, mass = np.bincount(levels), np.bincount(levels, weights=counts.astype(float))
        at = number.nonzero()[0]
        segment = _rows("filter", f, b, [None], [bits_n], [int(levels.sum())], [bits])
        stats = pa.concat_tables([_rows("level", f, int(q), [None], [int(number[q])], [int(mass[q])], [None]) for q in at])
        return pa.concat_tables([segment, stats])

    blocks = texts.mapInArrow(count, BLOCKS)
    table = stage(blocks.groupBy("kind", "family", "bucket").applyInArrow(merge, MODEL), "bloom-lm")
    row = table.where("kind = 'word'").agg(F.sum("total"), F.count("*")).first()
    means: dict[int, np.ndarray] = {f: np.arange(LEVELS) * 0.0 for f in families(order)}
    stats = (table.where("kind = 'level'").groupBy("family", "bucket")
             .agg((F.sum("total") / F.sum("n")).alias("mean")).collect())  # levels x families
    for r in stats:
        means[r["family"]][r["bucket"]] = r["mean"]
    for f, m in means.items():  # a level reached by false positives alone
        for q in range(1, LEVELS):
            m[q] = m[q] or BASE ** (q - 1)
    return Model(table, buckets, order, row[0] or 0, row[1], means)


def _split(place: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.append(True, place[1:] != place[:-1]).nonzero()[0] if len(place) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(place))):
        yield int(place[a]), members[a:b]


def _rows(kind, family, bucket, word, n, total, bits) -> pa.Table:
    size = len(word)
    return pa.table({"kind": pa.array([kind] * size, pa.string()), "family": pa.array([family] * size, pa.int32()),
                     "bucket": pa.array([bucket] * size, pa.int32()), "word": pa.array(word, pa.binary()),
                     "n": pa.array(n, pa.int64()), "total": pa.array(total, pa.int64()), "bits": pa.array(bits, pa.binary())})


# -- scoring ----------------------------------------------------------------------

SCORED = [T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType()),
          T.StructField("_known", T.LongType()), T.StructField("_log", T.DoubleType()),
          T.StructField("_rare", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()),
                                                           T.StructField("tf", T.LongType())])))]


def _log_probability(tokens: Tokens, model: Model, lookup: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """log10 of every token's smoothed probability; ``lookup`` gives the levels
    of ascending distinct hashes of a family."""
    def counts(family: int) -> np.ndarray:
        h, back = np.unique(tokens.grams(family), return_inverse=True)
        return model.means[family][lookup(family, h)][back]

    one = counts(1)
    p = (one + 1) / (model.tokens + model.words + 1)
    for n in range(2, model.order + 1):
        if n == 2:  # what a word is preceded by; END before a text
            context = np.concatenate([one[-1:], one[:-1]])
        else:
            context = counts(-n)
        p = (np.minimum(counts(n), context) + PRIOR * p) / (context + PRIOR)
    return np.log10(p)


def _score_chunk(texts: list[bytes], model: Model, lookup, heavy: dict[bytes, int]) -> list[pa.Array]:
    tokens = Tokens(texts)
    p = _log_probability(tokens, model, lookup)
    known = np.fromiter((heavy.get(w, -1) for w in tokens.words), np.int64, len(tokens.words))[tokens.ids]
    log = np.where(known > 0, np.log10(np.maximum(known, 0) + 1.0), 0.0)
    rare = np.flatnonzero(known < 0)
    doc = np.repeat(np.arange(len(texts)), tokens.sizes)[rare]
    pair, times = np.unique(doc * len(tokens.words) + tokens.ids[rare], return_counts=True)
    per_doc = np.bincount(pair // len(tokens.words), minlength=len(texts))
    offsets = np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)
    words = pa.array(tokens.words, pa.binary()).take(pa.array(pair % len(tokens.words)))
    entries = pa.StructArray.from_arrays([words, pa.array(times.astype(np.int64))], names=["word", "tf"])
    return [pa.array(tokens.sizes), pa.array(np.add.reduceat(p, tokens.starts)),
            pa.array(np.add.reduceat((known > 0).astype(np.int64), tokens.starts)),
            pa.array(np.add.reduceat(log, tokens.starts)), pa.ListArray.from_arrays(pa.array(offsets), entries)]


def _segmented(segments: dict[tuple[int, int], tuple[int, bytes]], buckets: int):
    """Lookup in filter segments held here."""
    def lookup(family: int, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.uint8)
        for b, members in _split(_scaled(h, buckets).astype(np.int64), np.arange(len(h))):
            if (family, b) in segments:
                out[members] = read_levels(h[members], family, *segments[family, b])
        return out
    return lookup


def _score_broadcast(rows: DataFrame, keep: list[str], model: Model, heavy) -> DataFrame:
    """Scores with the whole filter at every worker."""
    context = rows.sparkSession.sparkContext
    held = {}
    for r in model.table.where("kind = 'filter'").select("family", "bucket", "n", "bits").toLocalIterator():
        held[r["family"], r["bucket"]] = (r["n"], bytes(r["bits"]))
    segments, words = context.broadcast(held), context.broadcast(heavy)
    plan = Model(None, model.buckets, model.order, model.tokens, model.words, model.means)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _segmented(segments.value, plan.buckets)
        for table, texts in _chunks(batches, "_t", SCORE_BYTES):
            columns = [table.column(c).combine_chunks() for c in keep] + _score_chunk(texts, plan, lookup, words.value)
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(f.name for f in SCORED)])

    return rows.mapInArrow(score, T.StructType([rows.schema[c] for c in keep] + SCORED))


def _score_routed(rows: DataFrame, keep: list[str], model: Model, heavy) -> DataFrame:
    """The same scores with every n-gram looked up where its segment is: chunks
    of texts send their distinct n-grams, a byte for each comes back."""
    words = rows.sparkSession.sparkContext.broadcast(heavy)
    plan = Model(None, model.buckets, model.order, model.tokens, model.words, model.means)
    one = T.StructType([rows.schema[c] for c in keep] + [T.StructField("_t", T.BinaryType())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in _chunks(batches, "_t"):
            columns = [table.column(c).combine_chunks() for c in one.fieldNames()]
            entries = pa.StructArray.from_arrays(columns, names=one.fieldNames())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), entries)],
                                             names=["rows"])

    chunks = rows.select(*one.fieldNames()).mapInArrow(gather, T.StructType([T.StructField("rows", T.ArrayType(one))]))
    chunks = stage(chunks.withColumn("chunk", F.monotonically_increasing_id()), "bloom-lm-chunks")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f, (h, _) in tally(texts, plan.order)[1].items():
                    for b, members in _split(_scaled(h, plan.buckets).astype(np.int64), np.arange(len(h))):
                        yield pa.RecordBatch.from_pydict(
                            {"chunk": [chunk], "family": pa.array([f], pa.int32()), "bucket": pa.array([b], pa.int32()),
                             "data": pa.array([h[members].tobytes()], pa.binary())})

    asked = chunks.select("chunk", F.col("rows._t").alias("t")).mapInArrow(
        ask, "chunk long, family int, bucket int, data binary")

    def reply(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        f = key[0].as_py()
        n, bits = (right.column("n")[0].as_py(), right.column("bits")[0].as_py()) if len(right) else (0, b"")
        found = []
        for data in left.column("data"):
            h = np.frombuffer(data.as_py(), np.uint64)
            found.append((read_levels(h, f, n, bits) if n else np.zeros(len(h), np.uint8)).tobytes())
        return pa.table({"chunk": left.column("chunk"), "family": left.column("family"),
                         "bucket": left.column("bucket"), "levels": pa.array(found, pa.binary())})

    filters = model.table.where("kind = 'filter'").select("family", "bucket", "n", "bits")
    answers = (asked.groupBy("family", "bucket").cogroup(filters.groupBy("family", "bucket"))
               .applyInArrow(reply, "chunk long, family int, bucket int, levels binary"))

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        levels: dict[int, list] = {}
        for f, b, v in zip(*(right.column(c).to_pylist() for c in ("family", "bucket", "levels"))):
            levels.setdefault(f, []).append((b, v))
        joined = {f: np.frombuffer(b"".join(v for _, v in sorted(found)), np.uint8) for f, found in levels.items()}
        held = left.column("rows").combine_chunks().flatten()
        texts = held.field("_t").to_pylist()
        asked = {f: h for f, (h, _) in tally(texts, plan.order)[1].items()}
        scored = [_score_chunk(part, plan, lambda f, h: joined[f][np.searchsorted(asked[f], h)], words.value) for part in _parts(texts)]
        columns = [held.field(c) for c in keep] + [pa.concat_arrays(c) for c in zip(*scored)]
        return pa.table(columns, names=[*keep, *(f.name for f in SCORED)])

    return (chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(score, T.StructType([rows.schema[c] for c in keep] + SCORED)))


def score_texts(docs: DataFrame, model: Model, text: str = "text", broadcast_bytes: int | None = None) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (add-one unigrams, exact counts) and
    score (the model's log10 probability of the text), per row.

    Null texts are empty (one token: the end). Rows are independent: repeated
    ids and rows each get theirs. Columns with the names of the results are
    replaced. An empty training table gives every text the probabilities of an
    empty model, 1 for each token."""
    spark: SparkSession = docs.sparkSession
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "_known", "_log", "_rare", "_t", "_row")
    keep = [c for c in docs.columns if c != text and c not in results]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("_t"))
    vocabulary = model.table.where("kind = 'word'").select("word", "total")
    is_heavy = F.col("total") * HEAVY >= model.tokens
    heavy = {bytes(r["word"]): r["total"] for r in vocabulary.where(is_heavy).collect()}  # at most HEAVY words
    size = model.table.where("kind = 'filter'").agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    scored = (_score_broadcast if size <= limit else _score_routed)(rows, keep, model, heavy)
    scored = stage(scored.withColumn("_row", F.monotonically_increasing_id()), "bloom-lm-scored")
    rare = (scored.select("_row", F.explode("_rare").alias("r")).select("_row", "r.word", "r.tf")
            .join(vocabulary.where(~is_heavy), "word")
            .groupBy("_row").agg(F.sum("tf").alias("_more"), F.sum(F.col("tf") * F.log10(F.col("total") + 1)).alias("_more_log")))
    whole = F.log10(F.lit(float(model.tokens + model.words + 1)))
    zero = F.lit(0)
    return scored.join(rare, "_row", "left").select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens",
        (F.col("_known") + F.coalesce("_more", zero)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("_log") + F.coalesce("_more_log", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"), "score")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the decimal id leaves 2 modulo 7 (a null id: no)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those not held out."""
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_texts(docs, fit(docs.where(~F.col("held_out"))))
