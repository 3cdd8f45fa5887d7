"""N-gram Jaccard join by MinHash banding.

Each text's set of word n-grams gets MinHash values in bands; band and row
counts are chosen for a target recall at the threshold. Texts with equal sets
form one class before anything is compared. Classes that share a band hash are
candidates; candidate components are cut into blocks of bounded size, and two
blocks with a common band hash meet in one task, which compares the full
n-gram sets of all their classes and returns only link counts and a spanning
forest of the links found - never the pairs.

Membership alone needs no link counts (:func:`similarity_members`): every class
is first compared with one center of each of its buckets, and only buckets that
these links leave in several components are compared by blocks, where members
of one component are never compared with each other.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import maybe_among, stage
from gaugeflow.llm.components import components

NGRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 64
# A block holds about this many classes and n-grams.
BLOCK_DOCS, BLOCK_GRAMS = 48, 500_000
# Classes that one task compares with a common center.
STAR_DOCS = 1024
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, hence fewest false candidates,
    with which a pair at the threshold shares a band with probability
    ``recall`` using at most ``max_hashes`` values."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit))) if hit < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("the target recall needs more hashes")
    return best


class Shingler:
    """N-gram hash sets of texts; words are lower-cased, split at white space.
    A text of fewer than n words has one n-gram, all of it; one without words none."""

    def __init__(self, n: int = NGRAM):
        self.n, self.seen = n, {}

    def _word(self, word: str) -> int:
        if len(self.seen) > 500_000:
            self.seen.clear()
        h = self.seen[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def grams(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        get, new = self.seen.get, self._word
        w = np.fromiter((get(x) or new(x) for x in words), dtype=np.uint64, count=len(words))
        if not len(w):
            return w
        k = min(self.n, len(w))
        h = np.zeros(len(w) - k + 1, dtype=np.uint64)
        for i in range(k):
            h = h * _P1 + w[i:len(w) - k + 1 + i]
        h ^= h >> np.uint64(29)
        h *= _P2
        h ^= h >> np.uint64(32)
        return np.unique(h)


def class_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


class MinHasher:
    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.mult = rng.integers(1, 1 << 63, size=bands * rows, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64)[:, None]

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.mult), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(grams), 4096):
            low = np.minimum(low, ((grams[None, i:i + 4096] ^ self.add) * self.mult).min(axis=1))
        h = np.zeros(self.bands, dtype=np.uint64)
        for column in low.reshape(self.bands, self.rows).T:
            h = (h ^ column) * _P1
            h ^= h >> np.uint64(31)
        return h


_SIGNATURES = "doc_id long, cid binary, grams long, bands array<long>"


def _sign(n, bands, rows):
    def run(batches):
        shingler, hasher = Shingler(n), MinHasher(bands, rows)
        none = np.zeros(0, dtype=np.int64)
        for batch in batches:
            cids, sizes, hashes = [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingler.grams(text)
                cids.append(class_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                hashes.append(hasher.band_hashes(grams).view(np.int64) if len(grams) else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cids, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(hashes, pa.list_(pa.int64()))], names=["doc_id", "cid", "grams", "bands"])
    return run


def similar_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the sets' pairs with Jaccard similarity >= threshold."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(m), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((m, m), dtype=np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 8192
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, width):
        a, b = np.searchsorted(column, [start, start + width])
        dense = np.zeros((m, min(width, total - start)), dtype=np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        common += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - common
    out = common >= threshold * union - 1e-9
    np.fill_diagonal(out, False)
    return out


_FOUND = "a binary, b binary, links long"


def _compare(n, threshold):
    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("pid", "cid", "side", "copies", "text")))

    def run(batches):
        shingler = Shingler(n)
        a, b, links = [], [], []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            members: dict[bytes, tuple] = {}
            for _, cid, side, copies, text in group:
                if cid in members:
                    continue  # rows repeated with one id
                grams = shingler.grams(text)
                if class_key(grams) == cid:
                    members[cid] = (side, copies, grams)
            cids = list(members)
            if len(cids) < 2:
                continue
            side, copies = (np.array([members[c][i] for c in cids]) for i in (0, 1))
            near = similar_pairs([members[c][2] for c in cids], threshold)
            if side.any():  # two blocks meet: pairs inside one are counted where it meets itself
                near &= side[:, None] != side[None, :]
            degree = near @ copies
            root = list(range(len(cids)))
            for i, row in enumerate(near):
                if degree[i]:
                    a.append(cids[i]); b.append(None); links.append(int(degree[i]))
                for j in np.flatnonzero(row[:i]).tolist():
                    x, y = i, j
                    while root[x] != x:
                        x = root[x]
                    while root[y] != y:
                        y = root[y]
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        a.append(cids[i]); b.append(cids[j]); links.append(0)
            if len(a) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()),
                                                  pa.array(links, pa.int64())], names=["a", "b", "links"])
                a, b, links = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()),
                                          pa.array(links, pa.int64())], names=["a", "b", "links"])
    return run


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, hash, cid, center) of band hashes that several classes have."""
    entries = classes.select("cid", F.posexplode("bands").alias("band", "hash"))
    shared = stage(entries.groupBy("band", "hash").agg(F.min("cid").alias("center"), F.count("*").alias("n"))
                   .filter("n > 1").drop("n"), "join-buckets")
    return stage(entries.join(shared, ["band", "hash"]), "join-entries")


def _placed(classes: DataFrame, bucketed: DataFrame) -> DataFrame:
    """Classes with the ``root`` of their candidate component."""
    roots = components(bucketed.select(F.col("cid").alias("a"), F.col("center").alias("b")).distinct())
    return stage(roots.withColumnRenamed("node", "cid").join(classes.drop("bands"), "cid"), "join-roots")


def _block_count() -> Column:
    return F.ceil(F.greatest(F.count("*") / F.lit(BLOCK_DOCS), F.sum("grams") / F.lit(BLOCK_GRAMS))).cast("long")


def _meetings(classes: DataFrame) -> DataFrame:
    """(pid, cid, side, rep, copies): the classes each comparison task needs."""
    bucketed = _buckets(classes)
    placed = _placed(classes, bucketed)
    need = placed.groupBy("root").agg(_block_count().alias("blocks"))
    blocks = stage(placed.join(stage(need, "join-need"), "root")
                   .select("cid", "rep", "copies", "blocks",
                           F.xxhash64("root", F.pmod(F.xxhash64("cid"), F.col("blocks"))).alias("block")), "join-blocks")
    # blocks of one component that share a band hash meet, as does each with itself
    spots = stage(bucketed.join(blocks.filter("blocks > 1").select("cid", "block"), "cid")
                  .select("band", "hash", "block").distinct(), "join-spots")
    other = spots.withColumnRenamed("block", "other")
    pairs = spots.join(other, ["band", "hash"]).filter("block < other").select("block", "other").distinct()
    alone = blocks.select("block").distinct().select("block", F.col("block").alias("other"))
    meet = stage(pairs.unionByName(alone).withColumn("pid", F.xxhash64("block", "other")), "join-meetings")
    return _assigned(meet, blocks)


def _assigned(meet: DataFrame, blocks: DataFrame) -> DataFrame:
    """(pid, cid, side, rep, copies) of meetings (pid, block, other)."""
    ends = (meet.select("pid", "block", F.lit(0).alias("side"))
            .unionByName(meet.filter("block != other").select("pid", F.col("other").alias("block"), F.lit(1).alias("side"))))
    return stage(ends.join(blocks, "block").select("pid", "cid", "side", "rep", "copies"), "join-assign")


def _compare_center(n, threshold):
    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("pid", "cid", "side", "text")))

    def run(batches):
        shingler = Shingler(n)
        a, b = [], []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            center = None  # comes first
            for _, cid, side, text in group:
                if side and center is None:
                    break
                if center is not None and not side:
                    continue  # rows repeated with one id
                grams = shingler.grams(text)
                if class_key(grams) != cid:
                    continue
                if not side:
                    center = cid, grams
                    continue
                common = len(np.intersect1d(center[1], grams, assume_unique=True))
                if common >= threshold * (len(center[1]) + len(grams) - common) - 1e-9:
                    a.append(cid); b.append(center[0])
            if len(a) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return run


def _assigned_texts(texts: DataFrame, assign: DataFrame) -> DataFrame:
    """The columns of ``assign`` with the ``text`` of each row's ``rep``. Texts
    of no row's rep are left out before the shuffle."""
    held = maybe_among(texts, "__doc", assign.select("rep").distinct()).filter("__maybe").drop("__maybe")
    return held.join(assign, F.col("__doc").eqNullSafe(F.col("rep")))


def _star_links(texts: DataFrame, classes: DataFrame, bucketed: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b): classes at least ``threshold`` similar to the center of one of
    their buckets. A class's text is sent once per center, the center's once
    per STAR_DOCS members."""
    pairs = stage(bucketed.filter("cid != center").select("cid", "center").distinct(), "join-stars")
    chunks = pairs.groupBy("center").agg(F.ceil(F.count("*") / F.lit(STAR_DOCS)).cast("long").alias("chunks"))
    members = stage(pairs.join(stage(chunks, "join-chunks"), "center")
                    .withColumn("pid", F.xxhash64("center", F.pmod(F.xxhash64("cid"), F.col("chunks")))), "join-members")
    sides = (members.select("pid", F.col("center").alias("cid"), F.lit(0).alias("side")).distinct()
             .unionByName(members.select("pid", "cid", F.lit(1).alias("side"))))
    assign = stage(sides.join(classes.select("cid", "rep"), "cid"), "join-star-assign")
    return stage(_assigned_texts(texts, assign).select("pid", "cid", "side", "text")
                 .repartition("pid").sortWithinPartitions("pid", "side", "cid")
                 .mapInArrow(_compare_center(n, threshold), "a binary, b binary"), "join-star-links")


def _open_meetings(classes: DataFrame, bucketed: DataFrame, known: DataFrame) -> DataFrame:
    """(pid, cid, side, rep, copies) for the buckets that hold several of the
    components ``known`` (cid, comp) so far. A component with more than a block of
    classes there has blocks of its own, which do not meet each other; the other
    classes share blocks."""
    tied = stage(bucketed.join(known, "cid"), "join-tied")
    mixed = tied.groupBy("band", "hash").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least != most")
    left = stage(tied.join(mixed.select("band", "hash"), ["band", "hash"]), "join-open")
    placed = _placed(classes, left).join(known, "cid")
    large = placed.groupBy("root", "comp").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK_DOCS)
    placed = stage(placed.join(large.select("root", "comp", F.col("comp").alias("part")), ["root", "comp"], "left")
                   .withColumn("part", F.coalesce("part", F.expr("X''"))), "join-open-roots")
    need = stage(placed.groupBy("root", "part").agg(_block_count().alias("blocks")), "join-need")
    blocks = stage(placed.join(need, ["root", "part"])
                   .select("cid", "rep", "copies", "part",
                           F.xxhash64("root", "part", F.pmod(F.xxhash64("cid"), F.col("blocks"))).alias("block")), "join-blocks")
    spots = stage(left.join(blocks.select("cid", "block", "part"), "cid").select("band", "hash", "block", "part").distinct(), "join-spots")
    other = spots.select("band", "hash", F.col("block").alias("other"), F.col("part").alias("other_part"))
    pairs = (spots.join(other, ["band", "hash"]).filter("block < other and (part != other_part or part = X'')")
             .select("block", "other").distinct())
    alone = blocks.filter("part = X''").select("block").distinct().select("block", F.col("block").alias("other"))
    meet = stage(pairs.unionByName(alone).withColumn("pid", F.xxhash64("block", "other")), "join-meetings")
    return _assigned(meet, blocks)


def _signed_classes(docs: DataFrame, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their class (doc_id, cid), and the classes of equal n-gram sets."""
    bands, rows = choose_bands(threshold, recall)
    signed = stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign(n, bands, rows), _SIGNATURES), "join-signed")
    classes = stage(signed.filter("cid is not null").groupBy("cid")
                    .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                         F.first("grams").alias("grams"), F.first("bands").alias("bands")), "join-classes")
    return signed, classes


def similarity_classes(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD,
                       recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links) for each row of ``docs`` (doc_id, text):
    ``n_links`` is the number of other rows whose n-gram set is at least
    ``threshold`` similar (copies included), ``class_id`` the smallest doc_id
    reached over such links (its own without links).

    Null, empty and blank texts have no n-grams and no links; repeated rows
    link to each other; a null doc_id is allowed; other columns are unused; an
    empty table gives no rows. Every pair of different texts compared is
    verified on the full sets; a pair at the threshold is compared with
    probability ``recall`` at least.
    """
    signed, classes = _signed_classes(docs, n, threshold, recall)
    texts = docs.select(F.col("doc_id").cast("long").alias("__doc"), "text")
    assign = _meetings(classes)
    found = stage(texts.join(assign.hint("shuffle_hash"), F.col("__doc").eqNullSafe(F.col("rep")))
                  .select("pid", "cid", "side", "copies", "text")
                  .repartition("pid").sortWithinPartitions("pid", "side", "cid")
                  .mapInArrow(_compare(n, threshold), _FOUND), "join-found")
    degree = found.filter("links > 0").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    linked = stage(components(found.filter("b is not null").select("a", "b"))
                   .join(classes.select(F.col("cid").alias("node"), "rep"), "node"), "join-linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    result = stage(classes.select("cid", "copies", "rep")
                   .join(linked.join(least, "root").select(F.col("node").alias("cid"), "class_id"), "cid", "left")
                   .join(degree, "cid", "left")
                   .select("cid", F.coalesce("class_id", "rep").alias("class_id"),
                           (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "join-result")
    return (signed.select("doc_id", "cid").join(result, "cid", "left")
            .select("doc_id", F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def similarity_members(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD,
                       recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, linked) for each row of ``docs``: the classes of
    :func:`similarity_classes`, and whether the row has any link, without counting
    links. A group of n near copies sends each text a bounded number of times.

    Every pair of classes that share a bucket is compared unless links found
    before tie the two already, so no class is lost. Nulls, empty texts, repeated
    rows and empty tables are handled as there."""
    signed, classes = _signed_classes(docs, n, threshold, recall)
    texts = docs.select(F.col("doc_id").cast("long").alias("__doc"), "text")
    bucketed = _buckets(classes)
    links = _star_links(texts, classes, bucketed, n, threshold)
    tied = components(links)
    known = stage(classes.select("cid").join(tied.withColumnRenamed("node", "cid"), "cid", "left")
                  .select("cid", F.coalesce("root", "cid").alias("comp")), "join-known")
    assign = _open_meetings(classes, bucketed, known)
    found = stage(_assigned_texts(texts, assign).select("pid", "cid", "side", "copies", "text")
                  .repartition("pid").sortWithinPartitions("pid", "side", "cid")
                  .mapInArrow(_compare(n, threshold), _FOUND), "join-found")
    linked = stage(components(links.unionByName(found.filter("b is not null").select("a", "b")))
                   .join(classes.select(F.col("cid").alias("node"), "rep"), "node"), "join-linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    result = stage(classes.select("cid", "copies", "rep")
                   .join(linked.join(least, "root").select(F.col("node").alias("cid"), "class_id", F.lit(True).alias("linked")), "cid", "left")
                   .select("cid", F.coalesce("class_id", "rep").alias("class_id"),
                           (F.col("linked").isNotNull() | (F.col("copies") > 1)).alias("linked")), "join-result")
    return (signed.select("doc_id", "cid").join(result, "cid", "left")
            .select("doc_id", F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("linked", F.lit(False)).alias("linked")))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns as they are, with one document of each class: that
    with the class's smallest doc_id (of repeated rows with this id, one).
    Texts without n-grams stay, as do rows with a null doc_id."""
    found = similarity_members(docs, **options)
    gone = stage(found.filter("class_id is not null and doc_id != class_id").select(F.col("doc_id").alias("__gone")).distinct(), "join-gone")
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__doc"))
    rows = maybe_among(rows, "__doc", gone)
    # the filter's matches only are looked up exactly; most rows stay where they are
    kept = rows.filter("not __maybe").drop("__maybe").unionByName(
        rows.filter("__maybe").drop("__maybe").join(gone.hint("shuffle_hash"), F.col("__doc") == F.col("__gone"), "left_anti"))
    # ids that still stand on several linked rows: equal rows, one stays
    many = stage(found.filter("doc_id = class_id and linked").groupBy("doc_id").agg(F.count("*").alias("n"))
                 .filter("n > 1").select(F.col("doc_id").alias("__many")), "join-many")
    if many.isEmpty():
        return kept.select("__row.*")
    single = kept.join(many, F.col("__doc") == F.col("__many"), "left_anti").select("__row.*")
    repeated = kept.join(many, F.col("__doc") == F.col("__many")).groupBy("__doc").agg(F.first("__row").alias("__row"))
    return single.unionByName(repeated.select("__row.*"))
