"""Language identification with a linear-chain conditional random field.

Every word has hashed affix, character n-gram, word and lexicon features;
learned transitions tie neighbouring words, and forward-backward gives each
word's language probabilities, so code-switched text gets word labels. A
document's language is the one with the largest mean probability over all its
words, which is its score.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import uniform

# The model is fitted on a bounded sample of the labelled rows: this many
# documents at most, and one passage of at most this many characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 2048, 900
BUCKETS, LEXICON = 1 << 17, 1 << 20
PIECE_BYTES = 1 << 20  # of text recognised at a time
PIECE = 24  # longer runs of letters go as pieces of at most this many
SPAN, EPOCHS, BATCH, RATE, SEED = 24, 4, 128, 0.3, 5
CHUNK = 64
UNKNOWN = "und"
SHORT = 10.0  # a text of n letters may fall SHORT / sqrt(n) below the bound (natural log units a letter)
WORDS = re.compile(r"[^\W\d_]+")

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. A run of more than PIECE letters (scripts
    without spaces) gives consecutive pieces of near equal length, as few as
    that bound allows, so that it is seen whole and weighs by its length."""
    words = WORDS.findall((text or "").lower())
    if max(map(len, words), default=0) <= PIECE:
        return words
    out = []
    for w in words:
        n = -(-len(w) // PIECE)
        cuts = [len(w) * i // n for i in range(n + 1)]
        out.extend(w[a:b] for a, b in zip(cuts, cuts[1:]))
    return out


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id (the empty text) is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words (PIECE letters at most) between boundary marks
    (1), zero-padded; lengths."""
    x = np.array(words, dtype=f"U{PIECE}").view(np.uint32).reshape(len(words), PIECE).astype(np.uint64)
    n = (x > 0).sum(axis=1)
    out = np.zeros((len(words), PIECE + 2), dtype=np.uint64)
    out[:, 0] = 1
    out[:, 1:-1] = x
    out[np.arange(len(words)), n + 1] = 1
    return out, n


def _fold(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


_STEP = np.uint64(0x100000001B3)


def word_hashes(x: np.ndarray) -> np.ndarray:
    h = np.zeros(len(x), dtype=np.uint64)
    for column in x.T:
        h = np.where(column > 0, h * _STEP + column, h)
    return _fold(h)


def features(words: list[str], lexicon: np.ndarray, langs: int) -> np.ndarray:
    """Feature ids per word (rows padded with the last id, BUCKETS + langs + 1,
    which has no weight): prefixes and suffixes of 1 to 4, n-grams of 1 to 3 characters with
    boundary marks, the word itself, and its lexicon entry."""
    x, n = _code_points(words)
    none = BUCKETS + langs + 1
    out = []

    def put(h, kind, valid):
        out.append(np.where(valid, (_fold(h * np.uint64(31) + np.uint64(kind)) & np.uint64(BUCKETS - 1)).astype(np.int64), none))

    h = np.zeros(len(x), dtype=np.uint64)
    for k in range(1, 5):  # prefixes
        h = h * _STEP + x[:, k]
        put(h, k, n >= k)
    rows = np.arange(len(x))
    h = np.zeros(len(x), dtype=np.uint64)
    for k in range(1, 5):  # suffixes
        h = h * _STEP + x[rows, np.maximum(n + 1 - k, 0)]
        put(h, 8 + k, n >= k)
    most = int(n.max(initial=0)) + 2
    for size in (1, 2, 3):
        for at in range(1 if size == 1 else 0, most - size + 1):
            h = np.zeros(len(x), dtype=np.uint64)
            for k in range(size):
                h = h * _STEP + x[:, at + k]
            put(h, 16 + size, at + size <= n + (1 if size == 1 else 2))
    whole = word_hashes(x)
    put(whole, 24, n > 0)
    entry = lexicon[(whole & np.uint64(LEXICON - 1)).astype(np.int64)].astype(np.int64)
    out.append(np.where(entry > 0, BUCKETS + entry, none))
    return np.stack(out, axis=1)


def build_lexicon(texts: list[list[str]], labels: np.ndarray, langs: int) -> np.ndarray:
    """Hashed lexicon: words seen three times or more and nine times in ten in
    one language point to it (1-based), others to 0."""
    counts = [Counter() for _ in range(langs)]
    for ws, y in zip(texts, labels):
        counts[y].update(ws)
    total = sum(counts, Counter())
    kept = [(w, y + 1) for y, c in enumerate(counts) for w, k in c.items() if k >= 3 and k >= 0.9 * total[w]]
    table = np.zeros(LEXICON, dtype=np.min_scalar_type(langs))
    if kept:
        x, _ = _code_points([w for w, _ in kept])
        table[(word_hashes(x) & np.uint64(LEXICON - 1)).astype(np.int64)] = [y for _, y in kept]
    return table


def marginals(scores: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over sequences of one length: label probabilities per
    position and expected transition counts (summed). scores: [n, t, labels]."""
    n, t, k = scores.shape
    e, m = np.exp(scores - scores.max(axis=2, keepdims=True)), np.exp(trans)
    fwd, bwd = np.empty_like(e), np.empty_like(e)
    a = np.full((n, k), 1.0 / k)
    for i in range(t):
        a = (a @ m) * e[:, i]
        a /= a.sum(axis=1, keepdims=True)
        fwd[:, i] = a
    b = np.ones((n, k))
    pairs = np.zeros((k, k))
    for i in range(t - 1, -1, -1):
        bwd[:, i] = b
        back = b * e[:, i]
        prev = fwd[:, i - 1] if i else np.full((n, k), 1.0 / k)
        joint = prev[:, :, None] * m[None] * back[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = back @ m.T
        b /= b.sum(axis=1, keepdims=True)
    p = fwd * bwd
    return p / p.sum(axis=2, keepdims=True), pairs


class Letters:
    """How likely words are, letter by letter, in the languages of a sample: a
    character trigram model of all of them, smoothed by shorter contexts."""

    SIZE, PRIOR = 1 << 20, 4.0

    def __init__(self, texts: list[list[str]]):
        self.counts = [np.zeros(self.SIZE, dtype=np.float32) for _ in range(4)]  # of contexts and letters, by length
        for i in range(0, len(texts), 64):
            words = [w for ws in texts[i:i + 64] for w in ws]
            for size, at, _ in self._grams(words):
                np.add.at(self.counts[size], at, 1)
        self.total = float(self.counts[1].sum())
        self.least = 0.0  # of a text's mean, set from the sample

    def _grams(self, words: list[str]):
        """(length, hashed places, valid) of the letters' n-grams; the letters
        are those of the words and the mark after each."""
        if not words:
            return
        x, n = _code_points(words)
        x = np.concatenate([np.ones((len(x), 1), dtype=np.uint64), x], axis=1)
        valid = np.arange(PIECE + 1)[None, :] <= n[:, None]
        for size in (1, 2, 3):
            h = np.full((len(x), PIECE + 1), size, dtype=np.uint64)
            for k in range(size):
                h = h * _STEP + x[:, 3 - size + k:3 - size + k + PIECE + 1]
            yield size, (_fold(h) & np.uint64(self.SIZE - 1)).astype(np.int64)[valid], valid

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Per word the sum of its letters' log probabilities and their number."""
        if not words:
            return np.zeros((0, 2))
        p = before = None
        for size, at, valid in self._grams(words):
            c = self.counts[size][at]
            if p is None:
                p = (c + 0.5) / (self.total + 0.5 * 4096)
            else:
                p = (np.minimum(c, before) + self.PRIOR * p) / (before + self.PRIOR)
            # what precedes the next letter, by the same n-gram: a mark precedes the first
            grid = np.zeros(valid.shape, dtype=np.float32)
            grid[valid] = c
            before = np.concatenate([np.full((len(valid), 1), self.starts(size)), grid[:, :-1]], axis=1)[valid]
        out = np.zeros(valid.shape)
        out[valid] = np.log(p)
        return np.stack([out.sum(axis=1), valid.sum(axis=1)], axis=1)

    def starts(self, size: int) -> float:
        """How often a context of marks alone occurs: before every word."""
        h = np.full(1, 1, dtype=np.uint64) * _STEP + np.uint64(1)
        return float(self.counts[1][int(_fold(h)[0] & np.uint64(self.SIZE - 1))])


def fit_letters(texts: list[list[str]]) -> Letters:
    """The letter model of a sample's texts and its bound: each half of the
    sample, and the same words with their letters shuffled, are scored by a
    model of the other half; the bound is midway between the lowest hundredth of
    the texts and the median of the shuffled ones."""
    letters = Letters(texts)
    rng = random.Random(SEED)
    real, shuffled = [], []
    for half in (0, 1):
        model = Letters(texts[half::2])
        for ws in texts[1 - half::2]:
            for scores, words in ((real, ws), (shuffled, ["".join(rng.sample(w, len(w))) for w in ws])):
                s = model.word_scores(words).sum(axis=0)
                scores.append(s[0] / s[1])
    if real:
        letters.least = float((np.quantile(real, 0.01) + np.median(shuffled)) / 2)
    return letters


class Crf:
    """langs, feature weights [features, langs], transition weights, lexicon,
    and the letter model that tells words of no known language."""

    def __init__(self, langs, weights, trans, lexicon, letters=None):
        self.langs, self.weights, self.trans, self.lexicon = langs, weights, trans, lexicon
        self.letters = letters or Letters([])

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.langs)))
        for i in range(0, len(words), 4096):
            out[i:i + 4096] = self.weights[features(words[i:i + 4096], self.lexicon, len(self.langs))].sum(axis=1)
        return out

    def tag(self, words: list[str]) -> np.ndarray:
        """Language probabilities of each word of one text."""
        return marginals(self.word_scores(words)[None], self.trans)[0][0] if words else np.zeros((0, len(self.langs)))


def fit(rows: list[tuple[str, str]]) -> Crf:
    """Fit on (text, lang) pairs. Training sequences join two spans of the
    sample, half of them from different documents, so that transitions are
    learned where languages change; weights follow the log-likelihood's
    gradient with per-weight rates (Adagrad). Reruns agree."""
    texts = [words_of(t) for t, _ in rows]
    rows = [(ws, lang) for ws, (_, lang) in zip(texts, rows) if ws]
    langs = sorted({lang for _, lang in rows})
    k = len(langs)
    if not k:
        return Crf([], np.zeros((BUCKETS + 2, 0)), np.zeros((0, 0)), np.zeros(LEXICON, dtype=np.uint8))
    labels = np.array([langs.index(lang) for _, lang in rows])
    lexicon = build_lexicon([ws for ws, _ in rows], labels, k)
    rng = np.random.default_rng(SEED)
    vocabulary: dict[str, int] = {}
    spans, ys = [], []
    for (ws, _), y in zip(rows, labels):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in ws]
        for i in range(0, max(1, len(ids) - SPAN + 1), SPAN):
            part = ids[i:i + SPAN]
            spans.append((part * (SPAN // len(part) + 1))[:SPAN])
            ys.append(y)
    spans, ys = np.array(spans), np.array(ys)
    known = features(list(vocabulary), lexicon, k)
    weights, trans = np.zeros((BUCKETS + k + 2, k)), np.zeros((k, k))
    sw, st = np.full_like(weights, 1e-6), np.full_like(trans, 1e-6)
    for _ in range(EPOCHS):
        first, second = rng.permutation(len(spans)), rng.permutation(len(spans))
        second = np.where(rng.random(len(spans)) < 0.5, first, second)
        for i in range(0, len(first), BATCH):
            a, b = first[i:i + BATCH], second[i:i + BATCH]
            seq = np.concatenate([spans[a], spans[b]], axis=1)
            y = np.repeat(np.stack([ys[a], ys[b]], axis=1), SPAN, axis=1)
            ids, at = np.unique(seq, return_inverse=True)
            at = at.reshape(seq.shape)
            feats = known[ids]
            p, pairs = marginals(weights[feats].sum(axis=1)[at], trans)
            g = -p
            np.put_along_axis(g, y[..., None], np.take_along_axis(g, y[..., None], 2) + 1, 2)
            per_word = np.stack([np.bincount(at.ravel(), g[..., c].ravel(), len(ids)) for c in range(k)], axis=1)
            flat = feats.ravel()
            grad = np.stack([np.bincount(flat, np.repeat(per_word[:, c], feats.shape[1]), len(weights))
                             for c in range(k)], axis=1) / len(a)
            grad[-1] = 0
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            pairs -= np.bincount(y[:, 0], minlength=k)[None, :] / k  # the step into a text has no label before it
            tg = (seen - pairs) / len(a)
            sw += grad ** 2
            st += tg ** 2
            weights += RATE * grad / np.sqrt(sw)
            trans += RATE * tg / np.sqrt(st)
    return Crf(langs, weights.astype(np.float32), trans, lexicon, fit_letters([ws for ws, _ in rows]))


def document_shares(scores: np.ndarray, doc: np.ndarray, docs: int, trans: np.ndarray) -> np.ndarray:
    """Mean label probabilities of each document (see document_means)."""
    return document_means(scores, doc, docs, trans)[0]


def document_means(scores: np.ndarray, doc: np.ndarray, docs: int, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means over each document's words: of the label probabilities, and of the
    word's largest one. scores: [words, labels], the documents' words in a row;
    doc: document of each word, ascending.

    Texts are cut into chunks of CHUNK words. The product of a chunk's
    transfer matrices carries the messages across it, so forward and backward
    run over all chunks at once and stay exact.
    """
    k = scores.shape[1]
    m = np.exp(trans - trans.max())
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    lengths = np.bincount(doc, minlength=docs)
    per = -(-lengths // CHUNK)
    starts = np.cumsum(lengths) - lengths
    first = np.cumsum(per) - per
    n = int(per.sum())
    owner = np.repeat(np.arange(docs), per)
    turn = np.arange(n) - first[owner]
    begin = starts[owner] + turn * CHUNK
    size = np.minimum(CHUNK, starts[owner] + lengths[owner] - begin)
    e = np.concatenate([e, np.ones((1, k))])
    at = begin[:, None] + np.arange(CHUNK)[None, :]
    valid = np.arange(CHUNK)[None, :] < size[:, None]
    grid = e[np.where(valid, at, len(e) - 1)]  # [chunks, CHUNK, labels]
    product = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(CHUNK):
        step = (product.reshape(n * k, k) @ m).reshape(n, k, k) * grid[:, t, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        product = np.where(valid[:, t, None, None], step, product)
    enter, leave = np.full((n, k), 1.0 / k), np.ones((n, k))
    order = np.argsort(turn, kind="stable")
    cuts = np.searchsorted(turn[order], np.arange(int(per.max(initial=0)) + 1))
    for c in range(1, len(cuts) - 1):
        ids = order[cuts[c]:cuts[c + 1]]
        a = np.einsum("ni,nij->nj", enter[ids - 1], product[ids - 1])
        enter[ids] = a / a.sum(axis=1, keepdims=True)
    for c in range(len(cuts) - 2, 0, -1):
        ids = order[cuts[c]:cuts[c + 1]]
        b = np.einsum("nij,nj->ni", product[ids], leave[ids])
        leave[ids - 1] = b / b.sum(axis=1, keepdims=True)
    fwd = np.empty((CHUNK, n, k))
    a = enter
    for t in range(CHUNK):
        step = (a @ m) * grid[:, t]
        step /= step.sum(axis=1, keepdims=True)
        a = np.where(valid[:, t, None], step, a)
        fwd[t] = a
    total, sure, b = np.zeros((n, k)), np.zeros(n), leave
    for t in range(CHUNK - 1, -1, -1):
        p = fwd[t] * b
        p = np.where(valid[:, t, None], p / p.sum(axis=1, keepdims=True), 0)
        total += p
        sure += p.max(axis=1)
        back = (b * grid[:, t]) @ m.T
        back /= back.sum(axis=1, keepdims=True)
        b = np.where(valid[:, t, None], back, b)
    shares = np.stack([np.bincount(owner, total[:, c], docs) for c in range(k)], axis=1)
    words = np.maximum(lengths, 1)
    return shares / words[:, None], np.bincount(owner, sure, docs) / words


class Predictor:
    """Applies a model to batches of texts; word scores are kept per worker."""

    def __init__(self, model: Crf):
        self.model, self.known, self.scores, self.n = model, {}, np.empty((1 << 16, len(model.langs)), dtype=np.float32), 0

    def _ids(self, texts: list[list[str]]) -> np.ndarray:
        if self.n > 500_000:
            self.known, self.n = {}, 0
        new = list({w for ws in texts for w in ws if w not in self.known})
        if new:
            while self.n + len(new) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
            self.scores[self.n:self.n + len(new)] = self.model.word_scores(new)
            self.known.update(zip(new, range(self.n, self.n + len(new))))
            self.n += len(new)
        known = self.known
        return np.array([known[w] for ws in texts for w in ws], dtype=np.int64)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        return [(lang, score) for lang, score, _ in self.recognise(texts)]

    def recognise(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, its mean probability, and how surely the words are
        recognised: the mean of each word's largest probability, whichever
        languages the text mixes."""
        words = [words_of(t) for t in texts]
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        full = [i for i, ws in enumerate(words) if ws]
        if not full or not self.model.langs:
            return out
        ids = self._ids([words[i] for i in full])
        doc = np.repeat(np.arange(len(full)), [len(words[i]) for i in full])
        shares, sure = document_means(self.scores[ids].astype(np.float64), doc, len(full), self.model.trans)
        for i, row, certainty in zip(full, shares, sure):
            best = int(row.argmax())
            out[i] = self.model.langs[best], min(1.0, max(0.0, float(row[best]))), float(certainty)
        return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Crf:
    """Fit on ``docs`` (doc_id, text, lang) that are labelled and not held out:
    the ``sample_docs`` with the smallest hash, of each a passage of at most
    ``sample_chars`` characters at a pseudorandom place."""
    known = (docs.select("doc_id", "text", "lang")
             .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))))
    draw = uniform(F.lit(SEED), F.col("doc_id"))
    # few more than wanted pass, so that what tasks send does not grow with their number
    share = min(1.0, 1.2 * sample_docs / max(1, known.drop("text").count()))
    place = uniform(F.lit(SEED + 1), F.col("doc_id"))
    start = F.floor(place * F.greatest(F.length("text") - F.lit(sample_chars) + 1, F.lit(1))).cast("int") + 1
    rows = (known.select(draw.alias("draw"), F.col("text").substr(start, F.lit(sample_chars)).alias("text"), "lang")
            .filter(F.col("draw") <= share).orderBy("draw", "lang", "text").limit(sample_docs).collect())  # bounded by the two parameters
    return fit([(r.text, r.lang) for r in rows])


def _pieces(batches, at: int):
    """The batches cut to PIECE_BYTES of text (column ``at``), or one row: what a
    worker holds of words and scores does not grow with the batch."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _predict(model):
    def run(batches):
        predictor = Predictor(model.value)
        for batch in batches:
            found = predictor.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict_language(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs`` (doc_id,
    text; nothing else is used). Null texts and texts without a letter are
    ``und`` with score 0, as is every text where no label was learned;
    repeated rows give a row each; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    return (docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(_predict(shared), SCHEMA))


def keep_known(docs: DataFrame, model: Crf) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in the known
    languages, one or several mixed: it has letters, and the mean log
    probability of its letters by the model of the sample's letters is not
    below that model's bound (less for few letters). Texts without letters, in scripts or languages
    that the sample does not hold, and random letters go. Null and empty texts
    go, texts of any length are read whole, repeated rows stay or go together.
    Every row stays where no language was learned."""
    if not model.langs:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model.letters)
    at = docs.columns.index("text")

    def run(batches):
        letters, known, scores = shared.value, {}, np.zeros((0, 2))
        for batch in _pieces(batches, at):
            texts = [words_of(t) for t in batch.column(at).to_pylist()]
            if len(known) > 500_000:
                known, scores = {}, np.zeros((0, 2))
            had = len(known)
            ids = np.fromiter((known.setdefault(w, len(known)) for ws in texts for w in ws), np.int64)
            new = list(known)[had:]
            scores = np.concatenate([scores, *(letters.word_scores(new[i:i + 4096]) for i in range(0, len(new), 4096))])
            doc = np.repeat(np.arange(len(texts)), [len(ws) for ws in texts])
            total, size = (np.bincount(doc, scores[ids, c], len(texts)) for c in (0, 1))
            mean = total / np.maximum(size, 1)
            keep = (size > 0) & (mean >= letters.least - SHORT / np.sqrt(np.maximum(size, 1)))
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def with_language(docs: DataFrame, model: Crf) -> DataFrame:
    """``docs``, all rows and columns, with the language the model reads in the
    text as ``lang``, whatever it was labelled (``und`` for null texts and
    texts without a letter). Labels stay where no language was learned."""
    if not model.langs or "lang" not in docs.columns:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    at, to = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        predictor = Predictor(shared.value)
        for batch in _pieces(batches, at):
            found = predictor.predict(batch.column(at).to_pylist())
            columns = list(batch.columns)
            columns[to] = pa.array([lang for lang, _ in found], batch.schema.field(to).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return docs.mapInArrow(run, docs.schema)
